"""Quality rules with cutoffs whose false rejections are bounded.

A rule rejects a document if a value of it passes a cutoff. Each stratum (language, say) gets its own
cutoffs, from labelled documents that pass the base rules, dealt into two halves by a checksum of the id:

1. The fitting half ranks all (rule, cutoff) pairs that reject bad documents more often than good ones, by
   the share of bad ones among the rejected. Taken in that order they make a ladder: step t rejects
   what any of the first t pairs rejects.
2. The holdout tests the ladder from its first step on. With n good documents, of which step t rejects
   k, the step stands if a false rejection rate of `alpha` or more would give k or fewer with a
   probability of at most `delta` / number of strata: an exact binomial tail. The first step that
   fails ends the ladder, so the order alone corrects for the many steps, and the division does for
   the strata. With probability 1 - delta, no stratum loses more than `alpha` of its good documents.

Values are whole numbers, so all engines agree on them. One pass over the texts makes one small row
for each; what reaches the driver is counts by stratum, rule and cutoff, and `MAX_STRATA` bounds them.

Nulls: a null or empty text has no words and fails the base rules; a null stratum is one of its own; a
null label, or a label without an id, is ignored. A document with several labels is good if all say
so; rows that repeat an id count once among the labelled, with the smallest values. A stratum with
too few labelled documents for any step keeps whatever passes the base rules. Very long texts are
read whole. Columns that are not named are not looked at. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import SPACES, WordHasher, by_bytes, gram_hashes, stored, text_bytes

SYMBOLS = b"#*$%&|<>"  # fixed value
WINDOW = 8
ALPHA = 0.02
DELTA = 0.05
MAX_STRATA = 10_000
VALUES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
BASE_FAILED = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"
HOLDOUT = "substr(md5(CAST(doc_id AS STRING)), 1, 1) < '8'"


@dataclass(frozen=True)
class Rule:
    """Rejects where `value` (SQL, a whole number) is over a cutoff; the cutoffs from loose to tight."""

    name: str
    value: str
    cutoffs: tuple[int, ...]


RULES = (
    Rule("few_words", "-n_words", tuple(-c for c in (25, 30, 40, 50, 60, 80, 100, 150, 200))),
    Rule("long_words", "100 * word_chars DIV nullif(n_words, 0)", (3000, 2000, 1500, 1200, 1000, 900, 850, 800, 750, 700, 650, 600)),
    Rule("short_words", "-(100 * word_chars DIV nullif(n_words, 0))", tuple(-c for c in (150, 200, 250, 300, 325, 350, 375, 400, 425, 450))),
    Rule("symbols", "10000 * n_symbols DIV nullif(n_words, 0)", (8000, 4000, 2000, 1500, 1000, 700, 500, 300, 200, 100, 50, 0)),
    Rule("dup_lines", "10000 * n_dup_lines DIV nullif(n_lines, 0)", (8000, 6000, 5000, 4000, 3000, 2000, 1500, 1000, 500, 200, 0)),
    Rule("repeats", "10000 * n_repeat_words DIV nullif(n_words, 0)", (2500, 2000, 1500, 1200, 1000, 800, 600, 400, 200, 100, 50, 0)),
)


def _repeated(words: np.ndarray) -> int:
    """Words in windows that occur twice or more."""
    windows = gram_hashes(words, WINDOW)
    if len(windows) < 2:
        return 0
    _, which, often = np.unique(windows, return_inverse=True, return_counts=True)
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(often[which] > 1)
    edges[at] += 1
    np.subtract.at(edges, at + WINDOW, 1)
    return int((np.cumsum(edges) > 0).sum())


def _values_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher()
    in_word, symbol = np.ones(256, bool), np.zeros(256, bool)
    in_word[list(SPACES)] = False
    in_word[0x80:0xC0] = False  # a code point counts by its first byte
    symbol[list(SYMBOLS)] = True
    for batch in by_bytes(batches, 2):
        rows = []
        for text, words in zip(texts := text_bytes(batch.column(2)), hasher.each(texts)):
            raw = np.frombuffer(text, np.uint8)
            lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
            dup_lines = len(lines) - len(set(lines))
            rows.append((len(words), in_word[raw].sum(), symbol[raw].sum(), len(lines), dup_lines, _repeated(words)))
        values = [pa.array(c, pa.int64()) for c in zip(*rows)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *values], names=["doc_id", "stratum", *VALUES])


def document_values(docs: DataFrame, stratum: str | None = "lang", *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, stratum and the counts named by `VALUES` for each document."""
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        (F.col(f"`{stratum}`").cast("string") if stratum else F.lit("")).alias("stratum"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    return rows.mapInArrow(_values_task, f"doc_id bigint, stratum string, {', '.join(f'{v} bigint' for v in VALUES)}")


def _places(rules: Sequence[Rule]) -> Column:
    """For each rule the place of the first cutoff that rejects; their number if none does."""
    return F.array(
        *[
            F.expr(f"size(filter(array({', '.join(f'{c}L' for c in r.cutoffs)}), c -> coalesce({r.value}, 0) <= c))")
            for r in rules
        ]
    )


def most_rejections(n: int, alpha: float, level: float) -> int:
    """The largest k with P(Binomial(n, alpha) <= k) <= level; -1 if there is none."""
    k, tail = -1, 0.0
    while k < n:
        i = k + 1
        tail += math.exp(
            math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(alpha) + (n - i) * math.log1p(-alpha)
        )
        if tail > level:
            break
        k = i
    return k


def _ladder(counts: dict[tuple[int, int, int], int], sizes: dict[int, int], rules: Sequence[Rule]) -> list[tuple[int, int]]:
    """The (rule, place) pairs in the order of the ladder, from counts by (good, rule, first place)."""
    ranked = []
    for r, rule in enumerate(rules):
        rejected = [0, 0]
        for place in range(len(rule.cutoffs)):
            for good in (0, 1):
                rejected[good] += counts.get((good, r, place), 0)
            bad, good = rejected
            if bad * sizes.get(1, 0) > good * sizes.get(0, 0):
                ranked.append((-(1_000_000 * bad // (bad + good)), -bad, r, place))
    return [(r, place) for _, _, r, place in sorted(ranked)]


class RiskControlledRules:
    """Cutoffs fitted for each stratum; `cutoffs` is {stratum: {rule name: cutoff}}."""

    def __init__(
        self, values: DataFrame, labels: DataFrame, *, rules: Sequence[Rule] = RULES, alpha: float = ALPHA, delta: float = DELTA
    ):
        """`values` as `document_values` gives them; `labels` is (doc_id, good 0/1)."""
        self.rules = tuple(rules)
        known = labels.where("doc_id IS NOT NULL AND good IS NOT NULL").groupBy("doc_id").agg(F.min("good").cast("int").alias("good"))
        labelled = (
            values.where(f"NOT ({BASE_FAILED})")
            .join(known, "doc_id")
            .groupBy("stratum", "doc_id", "good")
            .agg(F.min(F.struct(*VALUES)).alias("v"))
            .select("stratum", "good", F.expr(HOLDOUT).alias("holdout"), "v.*")
            .select("stratum", "good", "holdout", _places(self.rules).alias("places"))
        )
        labelled = stored(labelled, "quality-labelled")
        strata = labelled.groupBy("stratum").count().limit(MAX_STRATA + 1).collect()
        if len(strata) > MAX_STRATA:
            raise ValueError(f"more than {MAX_STRATA} strata have labels")

        fitting = labelled.where("NOT holdout")
        sizes, counts = defaultdict(dict), defaultdict(dict)
        for s, good, n in fitting.groupBy("stratum", "good").count().collect():
            sizes[s][good] = n
        by_place = fitting.select("stratum", "good", F.posexplode("places").alias("rule", "place"))
        for s, good, rule, place, n in by_place.groupBy("stratum", "good", "rule", "place").count().collect():
            counts[s][good, rule, place] = n
        ladders = {s: _ladder(counts[s], sizes[s], self.rules) for s in sizes}

        step = self._least(ladders, F.col("stratum"), F.col("places"))
        good = labelled.where("holdout AND good = 1").select("stratum", step.alias("step")).groupBy("stratum", "step").count()
        found = defaultdict(dict)
        for s, t, n in good.collect():
            found[s][t] = n
        self.cutoffs: dict[str | None, dict[str, int]] = {}
        self.tested: dict[str | None, tuple[int, int, int]] = {}  # good holdouts, rejections allowed, rejections found
        level = delta / max(len(found), 1)
        for s, steps in found.items():
            n = sum(steps.values())
            most, rejected, chosen = most_rejections(n, alpha, level), 0, {}
            for t, (rule, place) in enumerate(ladders.get(s, [])):
                if rejected + steps.get(t, 0) > most:
                    break
                rejected += steps.get(t, 0)
                chosen[rule] = max(chosen.get(rule, place), place)
            self.cutoffs[s] = {self.rules[r].name: self.rules[r].cutoffs[place] for r, place in chosen.items()}
            self.tested[s] = n, most, rejected

    def _least(self, ladders: dict, stratum: Column, places: Column) -> Column:
        """The first step of a stratum's ladder that rejects a document."""
        first = {}
        for s, ladder in ladders.items():
            table = [[None] * (len(r.cutoffs) + 1) for r in self.rules]
            for t in reversed(range(len(ladder))):
                rule, place = ladder[t]
                table[rule][: place + 1] = [t] * (place + 1)
            first[s] = table
        sql = lambda table: "array({})".format(", ".join(
            "array({})".format(", ".join("CAST(NULL AS INT)" if t is None else str(t) for t in row)) for row in table))
        keys = list(first)
        if not keys:
            return F.lit(None).cast("int")
        tables = F.expr(f"array({', '.join(sql(first[s]) for s in keys)})")
        at = F.array_position(F.array(*[F.lit(_key(s)) for s in keys]), _key_of(stratum)).cast("int")
        steps = F.zip_with(places, F.get(tables, at - 1), lambda place, row: F.get(row, place))
        return F.when(at > 0, F.array_min(steps))

    def rejects(self, stratum: Column | str) -> Column:
        """True where a rule rejects the row, whose columns are those of `document_values`."""
        s = _key_of(F.col(stratum) if isinstance(stratum, str) else stratum)
        keys = [k for k, chosen in self.cutoffs.items() if chosen]
        if not keys:
            return F.lit(False)
        at = F.array_position(F.array(*[F.lit(_key(k)) for k in keys]), s).cast("int")
        passed = F.lit(False)
        for rule in self.rules:
            limits = ", ".join("CAST(NULL AS BIGINT)" if (c := self.cutoffs[k].get(rule.name)) is None else f"{c}L" for k in keys)
            over = F.expr(f"coalesce({rule.value}, 0)") > F.get(F.expr(f"array({limits})"), at - 1)
            passed = passed | F.coalesce(over, F.lit(False))
        return F.when(at > 0, passed).otherwise(F.lit(False))


def _key(stratum: str | None) -> str:
    return "-" if stratum is None else "=" + stratum


def _key_of(stratum: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), stratum), F.lit("-"))


def judge(docs: DataFrame, labels: DataFrame, *, stratum: str | None = "lang", **options) -> DataFrame:
    """doc_id, the counts, stratum, base_failed and kept of each document; `labels` is (doc_id, good 0/1)."""
    values = stored(document_values(docs, stratum), "quality-values")
    fitted = RiskControlledRules(values, labels, **options)
    base_failed = F.expr(BASE_FAILED)
    return values.select(
        "doc_id", *VALUES, "stratum", base_failed.alias("base_failed"), (~base_failed & ~fitted.rejects("stratum")).alias("kept")
    )
