"""Words as symbol strings: one character per symbol.

A symbol is a byte string. The 256 single bytes are the characters U+0000 to U+00FF (so a word
starts as the Latin-1 reading of its UTF-8 bytes), and each byte string made by a merge gets the
next free character. Merging a pair is then `replace(word, 'xy', 'z')`: greedy, left to right and
non-overlapping, which are the rules of the merge step. Hex is used wherever symbols meet people,
files or SQL: upper-case hex sorts like the bytes themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SURROGATES = range(0xD800, 0xE000)
SEPARATOR = "\U0010ffff"  # never a symbol
MAX_SYMBOLS = ord(SEPARATOR) - len(SURROGATES)


def _character(index: int) -> str:
    if index >= MAX_SYMBOLS:
        raise ValueError(f"more than {MAX_SYMBOLS} different symbols")
    return chr(index if index < SURROGATES.start else index + len(SURROGATES))


class SymbolTable:
    """Character <-> hex for the symbols of a merge list. Equal bytes share one character."""

    def __init__(self, merges: Iterable[tuple[str, str]] = ()):
        self._char = {f"{b:02X}": chr(b) for b in range(256)}
        self._hex = {c: h for h, c in self._char.items()}
        for left, right in merges:
            self.add(left)
            self.add(right)
            self.add(left + right)

    def __contains__(self, token_hex: str) -> bool:
        return token_hex in self._char

    def __len__(self) -> int:
        return len(self._char)

    def add(self, token_hex: str) -> str:
        if token_hex not in self._char:
            char = _character(len(self._char))
            self._char[token_hex] = char
            self._hex[char] = token_hex
        return self._char[token_hex]

    def char(self, token_hex: str) -> str:
        return self._char[token_hex]

    def hex(self, char: str) -> str:
        return self._hex[char]

    def rule(self, left: str, right: str) -> str:
        """A merge as three characters: left, right, result."""
        return self.add(left) + self.add(right) + self.add(left + right)

    def items(self) -> list[tuple[str, str]]:
        """(character, hex) of every symbol."""
        return list(self._hex.items())

    def hex_list(self) -> list[str]:
        """Hex by code point (empty where no symbol is), for lookups by `ascii(symbol)`."""
        out = [""] * (ord(max(self._hex)) + 1)
        for char, token_hex in self._hex.items():
            out[ord(char)] = token_hex
        return out


def symbol_word(text: Column) -> Column:
    """Text to symbol string, one symbol per UTF-8 byte."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def byte_word_hex(word: Column) -> Column:
    """Hex of a word whose symbols are still single bytes."""
    return F.hex(F.encode(word, "ISO-8859-1"))


def symbol_list(word: Column) -> Column:
    """ARRAY<STRING> of single symbols."""
    return F.regexp_extract_all(word, F.lit("(?s)."), F.lit(0))


def pair_list(word: Column) -> Column:
    """ARRAY<STRING> of all adjacent pairs, overlapping ones too: `aaa` gives `aa`, `aa`."""
    return F.regexp_extract_all(word, F.lit("(?s)(?=(..))."), F.lit(1))


def string_array(values: Sequence[str], separator: str = ",") -> Column:
    """A constant ARRAY<STRING> from one literal (folded once by the optimizer)."""
    return F.split(F.lit(separator.join(values)), separator, -1)


def symbol_hex(symbol: Column, table: SymbolTable) -> Column:
    """Hex of one symbol by array lookup."""
    return F.get(string_array(table.hex_list()), F.ascii(symbol))


def apply_merges(word: Column, rules: Sequence[str]) -> Column:
    """Every merge once, in list order. A rule is `SymbolTable.rule(left, right)`.

    The rule array is one literal, so the plan keeps its shape whatever the merges are.
    """
    if not rules:
        return word
    steps = F.regexp_extract_all(F.lit("".join(rules)), F.lit("(?s)..."), F.lit(0))
    return F.aggregate(
        steps,
        word,
        lambda w, m: F.replace(w, F.substring(m, 1, 2), F.substring(m, 3, 1)),
    )


def _literal_sql(symbols: str) -> str:
    """Symbols as SQL text; hex keeps them clear of quoting."""
    return f"decode(X'{symbols.encode('utf-8').hex()}', 'UTF-8')"


def constant_sql(words: Sequence[str]) -> str:
    """An array of constant words as SQL text."""
    return f"array({', '.join(map(_literal_sql, words))})"


def fold_sql(word: str, rules: Sequence[str]) -> str:
    """`apply_merges` as SQL text for a few rules.

    The rules are one constant, so the code Spark generates is the same whatever they are and
    stays compiled from round to round.
    """
    if not rules:
        return word
    steps = ", ".join(
        f"named_struct('pair', {_literal_sql(rule[:2])}, 'symbol', {_literal_sql(rule[2])})" for rule in rules
    )
    return f"aggregate(array({steps}), {word}, (w, m) -> replace(w, m.pair, m.symbol))"


def delimited_hex(word: Column, table: SymbolTable) -> Column:
    """Readable form `|74|68|65|`: hex of each symbol between bars."""
    symbols = F.transform(symbol_list(word), lambda s: symbol_hex(s, table))
    return F.concat(F.lit("|"), F.array_join(symbols, "|"), F.lit("|"))
