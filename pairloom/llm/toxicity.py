"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; the rest of the training text is unlabelled, whatever its
labels say. A linear model over the presence of words is trained with numpy to minimise the
non-negative risk estimate prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with logistic loss; where
the second term turns negative, its gradient is followed upwards instead. The prior is the share of
toxic documents among the labelled ones, counted over all labels of the training rows.

The classifier is fitted on a bounded sample (`MAX_POSITIVE`, `MAX_UNLABELLED` rows, chosen by a hash of
the id); all documents are scored, whole.

Nulls: a null or empty text has no words and is scored by the bias alone; labels that are null are
ignored; a row without an id is never learned from. Several labels of a document: toxic if one says
so. Without positives every score is 0. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import (
    PUNCTUATION,
    SPACES,
    WordHasher,
    by_bytes,
    discard,
    gram_hashes,
    list_array,
    mixed,
    stored,
    text_bytes,
)

MAX_POSITIVE = 12_000
MAX_UNLABELLED = 24_000
FOLDS = 5
SPACE = 1 << 22  # places for words
LEAST_POSITIVES = 3  # a word that fewer positives hold has no weight
CLEARLY = 4.0  # standard deviations above the unlabelled rate
COPY_KEY = 8  # smallest word hashes that two near copies share
STEPS = 200
RATE = 0.1
DECAY = 1e-3  # soft threshold on the weights


class Words:
    """Places of the different words of texts, lower-cased and without punctuation."""

    def __init__(self):
        self.hasher = WordHasher(SPACES + PUNCTUATION)

    def features(self, texts: pa.Array) -> list[np.ndarray]:
        lowered = [t.decode("utf-8").lower().encode("utf-8") for t in text_bytes(texts)]
        return [np.unique((w & np.uint64(SPACE - 1)).astype(np.int32)) for w in self.hasher.each(lowered)]


def fold(doc_id: str | Column) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS


def _features_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word places of each text, and a key that near copies share: a hash of the smallest word hashes."""
    words = Words()
    for batch in by_bytes(batches, 1):
        rows = words.features(batch.column(1))
        values = np.concatenate(rows) if rows else np.empty(0, np.int32)
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        least = (np.sort(mixed(r.astype(np.uint64)))[:COPY_KEY] for r in rows)
        keys = np.array([gram_hashes(k, len(k))[0] if len(k) else 0 for k in least], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), list_array(values, lengths, pa.int32()), pa.array(keys.view(np.int64))],
            names=["positive", "words", "key"],
        )


def _sample(positive: DataFrame, unlabelled: DataFrame) -> DataFrame:
    """(positive, key, words) of the training texts without near copies (texts whose smallest word hashes
    agree), which would make the words of one copied text look like a trait of all."""
    texts = positive.select(F.lit(True).alias("positive"), "text").unionAll(
        unlabelled.select(F.lit(False).alias("positive"), "text")
    )
    rows = texts.mapInArrow(_features_task, "positive boolean, words array<int>, key bigint")
    apart = rows.groupBy("positive", "key").agg(F.min_by("words", F.struct(F.size("words"), F.hash("words"))).alias("words"))
    return stored(apart, "toxicity-sample")


def _telling(sample: DataFrame, n_positive: int, n_unlabelled: int) -> np.ndarray:
    """Places of the words that positives hold clearly more often, counted in Spark."""
    usual = F.col("u") * (n_positive / max(n_unlabelled, 1))
    counts = (
        sample.select("positive", F.explode("words").alias("place"))
        .groupBy("place")
        .agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u"))
        .where((F.col("p") >= LEAST_POSITIVES) & (F.col("p") - usual >= CLEARLY * F.sqrt(usual + 0.5)))
    )
    return np.sort(counts.select("place").toArrow().column("place").to_numpy()).astype(np.int64)


def _columns_task(places: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(2)
            of = words.flatten().to_numpy()
            at = np.minimum(np.searchsorted(places, of), len(places) - 1)
            known = places[at] == of
            row = np.repeat(np.arange(batch.num_rows), np.diff(words.offsets.to_numpy()))[known]
            lengths = np.bincount(row, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], list_array(at[known].astype(np.int32), lengths, pa.int32())],
                names=["positive", "key", "words"],
            )

    return run


def _sparse(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """(column, row) of each word that tells, and the number of rows: what reaches the driver."""
    column = rows.select("key", "words").toArrow().sort_by("key").column("words").combine_chunks()
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(), np.repeat(np.arange(len(lengths), dtype=np.int32), lengths), len(lengths)


def fit(positive: DataFrame, unlabelled: DataFrame, prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(places, weights, bias). Words get a weight if positives hold them clearly more often; only
    their places come to the driver."""
    sample = _sample(positive, unlabelled)
    sizes = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    if not sizes.get(True):
        return np.empty(0, np.int64), np.empty(0), -np.inf
    places = _telling(sample, sizes[True], sizes.get(False, 0))
    if len(places) == 0:
        return places, np.empty(0), float(np.log(prior / (1 - prior)))
    known = sample.mapInArrow(_columns_task(places), "positive boolean, key bigint, words array<int>")
    p, u = (_sparse(known.where(side)) for side in ("positive", "not positive"))
    discard(sample)
    weights, bias = np.zeros(len(places)), float(np.log(prior / (1 - prior)))
    moment, spread = np.zeros(len(places) + 1), np.zeros(len(places) + 1)
    for step in range(1, STEPS + 1):
        score = [bias + np.bincount(row, weights[of], n) for of, row, n in (p, u)]
        up = [1 / (1 + np.exp(-np.clip(s, -30, 30))) for s in score]
        negative = np.logaddexp(0, score[1]).mean() - prior * np.logaddexp(0, score[0]).mean()
        sign = 1.0 if negative >= 0 else -1.0
        # derivatives of the losses by the scores
        slope_p = (prior * (up[0] - 1) if sign > 0 else 0 * up[0]) - sign * prior * up[0]
        slope_u = sign * up[1]
        grad = np.zeros(len(places) + 1)
        for (of, row, n), slope in ((p, slope_p), (u, slope_u)):
            if n:
                grad[:-1] += np.bincount(of, slope[row], len(places)) / n
                grad[-1] += slope.sum() / n
        moment = 0.9 * moment + 0.1 * grad
        spread = 0.99 * spread + 0.01 * grad * grad
        change = RATE * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        weights = weights - change[:-1]
        bias -= change[-1]
        weights = np.sign(weights) * np.maximum(np.abs(weights) - DECAY, 0)
    return places, weights, bias


class ToxicityModel:
    """A fitted classifier; `score` is a column expression for any text column."""

    def __init__(self, docs: DataFrame, labels: DataFrame, seed: int = 7):
        train = labels.where((fold("doc_id") != 0) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        known = train.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        counts = known.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("toxic") == 1).alias("toxic")).first()
        texts = docs.select("doc_id", "text").where(
            (fold("doc_id") != 0) & F.col("doc_id").isNotNull()
        )
        total = texts.count()
        places, weights, self.bias = np.empty(0, np.int64), np.empty(0), float("-inf")
        if counts["toxic"]:
            chosen = known.where("toxic = 1").where(self._part(counts["toxic"], MAX_POSITIVE, seed)).select("doc_id")
            positive = texts.join(F.broadcast(chosen), "doc_id").select("text")
            unlabelled = texts.where(self._part(total, MAX_UNLABELLED, seed + 1)).select("text")
            prior = min(max(counts["toxic"] / counts["n"], 1e-4), 0.5)
            places, weights, self.bias = fit(positive, unlabelled, prior)
        used = weights != 0
        self._model = places[used], weights[used]  # the words that tell; travels with the task

    @staticmethod
    def _part(n: int, most: int, seed: int) -> Column:
        """About `most` of `n` rows, by a hash of the id; all if there are no more."""
        bits = 1 << 30
        return F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(bits)) < int(bits * min(1.0, most / max(n, 1)))

    def score(self, text: Column | str) -> Column:
        model, bias = self._model, self.bias

        @F.arrow_udf("double")
        def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            # the last place is above all words'
            places, weights = np.append(model[0], SPACE), np.append(model[1], 0.0)
            words = Words()

            def margin(found: np.ndarray) -> float:
                at = np.searchsorted(places, found)
                return weights[at[places[at] == found]].sum() + bias

            for batch in texts:
                parts = by_bytes([pa.RecordBatch.from_arrays([batch], names=["text"])], 0)
                margins = np.array([margin(f) for p in parts for f in words.features(p.column(0))])
                yield pa.array(1 / (1 + np.exp(-np.clip(margins, -700, 700))), pa.float64())

        return scored(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model = ToxicityModel(docs, labels)
    scored = docs.select("doc_id", (fold("doc_id") == 0).alias("held_out"), model.score("text").alias("score"))
    return scored.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents not predicted toxic, with their own columns."""
    return docs.where(ToxicityModel(docs, labels).score("text") < 0.5)
