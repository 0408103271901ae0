"""Substring deduplication: remove words covered by windows that start in an earlier document too.

Every window of `SIZE` words is a Rabin-Karp hash (96 bits), counted in Spark (`windows`). The windows
of a document that occur in one with a smaller id are merged into maximal intervals, and the words in
these go. What is repeated is judged on the input, so the result does not depend on any order.

Nulls: a null or empty text has no words; a row without an id keeps all its words and removes none.
Rows that share an id are one document: they do not remove words from each other. A text with fewer
words than a window keeps all. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import WordHasher, by_bytes, join_counted, stored, text_bytes
from pairloom.llm.windows import Streams, repeated_windows

SIZE = 50
PART = 20
KEPT = "n_words bigint, n_removed bigint, kept string"


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[Streams]:
    hasher = WordHasher()
    for part in by_bytes(batches, 3):
        owners, rows, contents = (part.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        yield Streams(np.zeros(len(owners), np.int64), owners, rows, contents, hasher.each(text_bytes(part.column(3))))


def removal_intervals(at: list[int], size: int) -> list[tuple[int, int]]:
    """Maximal intervals [start, end) covered by the windows that start at `at`."""
    out: list[tuple[int, int]] = []
    for start in sorted(at):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], start + size)
        else:
            out.append((start, start + size))
    return out


def _without(size: int):
    @F.arrow_udf(f"struct<{KEPT.replace(' ', ': ').replace(',:', ',')}>")
    def kept(texts: pa.Array, places: pa.Array, copies: pa.Array) -> pa.Array:
        counts, removed, out = [], [], []
        for text, at, copied in zip(text_bytes(texts), places.to_pylist(), copies.to_pylist()):
            words = text.split()
            counts.append(len(words))
            if copied and len(words) >= size:
                words.clear()
            for start, end in reversed(removal_intervals(at or [], size) if words else []):
                del words[start:end]
            removed.append(counts[-1] - len(words))
            out.append(b" ".join(words))
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())],
            names=["n_words", "n_removed", "kept"],
        )

    return kept


def substring_dedup(docs: DataFrame, *, size: int = SIZE, part: int = PART) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each document's words that stay, one space between."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.hash("text").alias("row"),  # tells rows of one id apart; equal rows have equal results
        F.xxhash64("text").alias("content"),
        F.col("text").cast("string").alias("text"),
    )
    known = rows.where("doc_id is not null")
    places = stored(known.select("doc_id", "row", "content"), "text-places")
    firsts = places.groupBy("content", "row").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = (
        join_counted(places, stored(firsts.where("n > 1"), "text-copies"), ["content", "row"])
        .where("doc_id > first")
        .select("doc_id", "row", F.lit(None).cast("int").alias("at"), F.lit(True).alias("copied"))
    )
    windows = (
        repeated_windows(known, _streams, size=size, part=part)
        .where("first_owner < owner")
        .select(F.col("owner").alias("doc_id"), "row", "at", F.lit(False).alias("copied"))
    )
    gone = (
        windows.union(copies)
        .groupBy("doc_id", "row")
        .agg(F.collect_set("at").alias("at"), F.max("copied").alias("copied"))
    )
    result = rows.join(gone, ["doc_id", "row"], "left").select(
        "doc_id", _without(size)("text", "at", "copied").alias("out")
    )
    return result.select("doc_id", "out.n_words", "out.n_removed", "out.kept")
