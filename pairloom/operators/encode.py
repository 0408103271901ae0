"""Encoding text columns.

Encoding a document needs nothing from any other row, so it is one narrow stage: text -> pretokens
-> symbols -> ids, in the row. Splitting and the id arrays are Spark expressions. The merges
themselves run in an Arrow function that folds each distinct pretoken of a batch once.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from heapq import heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.symbols import (
    MAX_SYMBOLS,
    SEPARATOR,
    SymbolTable,
    delimited_hex,
    string_array,
    symbol_list,
    symbol_word,
)
from pairloom.functions.text import clean_specials, pretokens
from pairloom.operators.batches import list_offsets, list_slices

MEMO_BYTES = 24 << 20
SHORT_WORD = 24


def _fold_short(word: str, rules: Sequence[str], ranks: Mapping[str, Sequence[int]]) -> str:
    """`fold_word` for a few symbols: looking at all pairs again costs less than keeping a heap."""
    done = -1
    while True:
        listed = filter(None, map(ranks.get, map(add, word, word[1:])))
        rank = min([r for places in listed for r in places if r > done], default=None)
        if rank is None:
            return word
        rule, done = rules[rank], rank
        word = word.replace(rule[:2], rule[2])


def fold_word(word: str, rules: Sequence[str], ranks: Mapping[str, Sequence[int]]) -> str:
    """Apply every rule once in list order, going straight to the next rule that can apply.

    A heap holds (rank, place) of the pairs of neighbouring symbols; only ranks above the last one done
    count. Places of one rank come out from left to right, so a pair that an earlier merge of the same
    rule took a symbol from is found changed and skipped. The cost is that of the merges made.
    """
    if len(word) <= SHORT_WORD:
        return _fold_short(word, rules, ranks)
    symbols: list[str | None] = list(word)
    after = list(range(1, len(symbols) + 1))
    before = list(range(-1, len(symbols) - 1))
    heap: list[tuple[int, int]] = []

    def offer(at: int, done: int) -> None:
        if at >= 0 and after[at] < len(symbols):
            for rank in ranks.get(symbols[at] + symbols[after[at]], ()):
                if rank > done:
                    heappush(heap, (rank, at))
                    break

    for at in range(len(symbols) - 1):
        offer(at, -1)
    while heap:
        rank, at = heappop(heap)
        if symbols[at] is None:
            continue
        right = after[at]
        if right >= len(symbols) or symbols[at] + symbols[right] != rules[rank][:2]:
            continue
        symbols[at], symbols[right] = rules[rank][2], None
        after[at] = after[right]
        if after[at] < len(symbols):
            before[after[at]] = at
        offer(before[at], rank)
        offer(at, rank)
    return "".join(s for s in symbols if s is not None)


def rule_ranks(rules: Sequence[str]) -> dict[str, list[int]]:
    ranks: dict[str, list[int]] = {}
    for rank, rule in enumerate(rules):
        ranks.setdefault(rule[:2], []).append(rank)
    return ranks


def _arrow_fold(rules: Sequence[str]):
    @F.arrow_udf("string")
    def folded(words: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks = rule_ranks(rules)
        for batch in words:
            yield pa.array([fold_word(w, rules, ranks) for w in batch.to_pylist()], pa.string())

    return folded


def _arrow_ids(rules: Sequence[str], ids_of: Mapping[str, Sequence[int]], specials: Mapping[str, list[int]]):
    @F.arrow_udf("array<int>")
    def encoded(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks = rule_ranks(rules)
        memo: dict[str, list[int]] = {}
        held = 0

        def ids(pretoken: str) -> list[int]:
            nonlocal held
            if pretoken in specials:
                return specials[pretoken]
            if pretoken not in memo:
                word = fold_word(pretoken.encode("utf-8").decode("latin-1"), rules, ranks)
                found = [i for symbol in word for i in ids_of.get(symbol, ())]
                held += (size := 220 + 4 * len(pretoken) + 9 * len(found))  # bytes of text, list and entry, roughly
                if held > MEMO_BYTES:
                    memo.clear()
                    held = size
                memo[pretoken] = found
            return memo[pretoken]

        for part in list_slices(texts):
            found = part.flatten().dictionary_encode()
            rows = pa.array([ids(p) for p in found.dictionary.to_pylist()], pa.list_(pa.int32()))
            tokens = rows.take(found.indices)
            ends = list_offsets(tokens)
            offsets = ends[list_offsets(part)]
            if offsets[-1] >= 1 << 31:
                raise OverflowError("a text has more than 2^31 tokens")
            offsets = offsets.astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), tokens.flatten())

    return encoded


class Encoder:
    """Merges, ids and specials in the form the expressions need. All of it is vocabulary-sized."""

    def __init__(
        self,
        merges: Sequence[tuple[str, str]],
        token_ids: Mapping[str, int],
        specials: Sequence[str],
    ):
        self.symbols = SymbolTable(merges)
        self.rules = [self.symbols.rule(left, right) for left, right in merges]
        self.specials = {s: token_ids.get(s.encode("utf-8").hex().upper()) for s in clean_specials(specials)}
        # a symbol has an id, or it is spelled out as those of its bytes that have one
        self.id_of: dict[str, int] = {}
        self.spelling: dict[str, str] = {}
        for token_hex in filter(None, self.symbols.hex_list()):
            symbol = self.symbols.char(token_hex)
            if token_hex in token_ids:
                self.id_of[symbol] = token_ids[token_hex]
            else:
                parts = [token_hex[i : i + 2] for i in range(0, len(token_hex), 2)]
                self.spelling[symbol] = "".join(chr(int(p, 16)) for p in parts if p in token_ids)

    def ids(self, text: Column) -> Column:
        """ARRAY<INT> for a text column."""
        ids_of = {c: [i] for c, i in self.id_of.items()}
        ids_of.update((c, [self.id_of[b] for b in spelled]) for c, spelled in self.spelling.items())
        specials = {s: [] if i is None else [i] for s, i in self.specials.items()}
        return _arrow_ids(self.rules, ids_of, specials)(pretokens(text, list(self.specials)))

    @staticmethod
    def _lookup(word: Column, id_of: Mapping[str, int], spelling: Mapping[str, str]) -> Column:
        """Symbols without an id are spelled out or removed; the rest are looked up by code point."""
        spelled_out = [symbol + spelled for symbol, spelled in spelling.items() if spelled]
        if spelled_out:
            word = F.aggregate(
                string_array(spelled_out, SEPARATOR),
                word,
                lambda w, s: F.replace(w, F.substring(s, 1, 1), F.substring(s, 2, MAX_SYMBOLS)),
            )
        word = F.translate(word, "".join(c for c, spelled in spelling.items() if not spelled), "")
        ids = [0] * (max(map(ord, id_of), default=0) + 1)
        for symbol, token_id in id_of.items():
            ids[ord(symbol)] = token_id
        table = F.split(F.lit(",".join(map(str, ids))), ",").cast("array<int>")
        return F.transform(symbol_list(word), lambda symbol: F.get(table, F.ascii(symbol)))

    def words(self, counts: DataFrame) -> DataFrame:
        """(pretoken, n, symbols, ids) for distinct pretokens; the merges run once for each."""
        word = symbol_word(F.col("pretoken"))
        folded = _arrow_fold(self.rules)(word)
        return counts.select("pretoken", "n", folded.alias("folded")).select(
            "pretoken",
            "n",
            delimited_hex(F.col("folded"), self.symbols).alias("symbols"),
            self._lookup(F.col("folded"), self.id_of, self.spelling).alias("ids"),
        )


def special_counts(ids: str, special_id: int) -> Column:
    """How often one id occurs in an id array."""
    return F.size(F.filter(F.col(ids), lambda x: x == special_id))
