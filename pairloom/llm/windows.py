"""Runs of a fixed number of tokens that occur in more than one document.

Rabin-Karp hashes of all windows would be as many rows as there are words. So candidates come first:
each window has a minimizer (its smallest hash of `PART` words in a row), equal windows have equal
minimizers, and neighbouring windows mostly share theirs. Minimizers that occur in several documents
go into a sketch of fixed size; only windows whose minimizer is in it are hashed, shuffled and counted.
What the sketch lets through by chance is sorted out by the exact count, so it costs time only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import BASE, BASE_INVERSE, collect_slots, dense, gram_hashes, join_counted, mixed, slot_of, stored

SLOTS = 1 << 24


@dataclass
class Streams:
    """Token hashes of some rows. Windows are compared within a scope; rows of one owner are one
    document; `row` tells the rows of an owner apart. Windows are of interest where they occur in
    different contents."""

    scopes: np.ndarray
    owners: np.ndarray
    rows: np.ndarray
    contents: np.ndarray
    tokens: list[np.ndarray]


StreamsOf = Callable[[Iterator[pa.RecordBatch]], Iterator[Streams]]


class Rolling:
    """Rabin-Karp hashes, modulo 2^64, of all windows of `size` tokens."""

    def __init__(self, size: int):
        self.size = size
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            with np.errstate(over="ignore"):
                self.powers, self.inverses = (
                    np.concatenate(([np.uint64(1)], np.cumprod(np.full(2 * n, b, np.uint64)))) for b in (BASE, BASE_INVERSE)
                )

    def of(self, tokens: np.ndarray, salt: int) -> np.ndarray:
        n = len(tokens)
        self._grow(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed(tokens ^ np.uint64(salt)) * self.powers[:n], out=sums[1:])
        return mixed((sums[self.size :] - sums[: -self.size]) * self.inverses[: n - self.size + 1])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` neighbours."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def minimizers(tokens: np.ndarray, size: int, part: int) -> np.ndarray:
    """The minimizer of each window of `size` tokens."""
    return window_minima(gram_hashes(tokens, part), size - part + 1)


def _minimizers_task(streams_of: StreamsOf, size: int, part: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in streams_of(batches):
            salts = mixed(s.scopes.view(np.uint64))
            found = [
                np.unique(minimizers(t, size, part)) ^ salt if len(t) >= size else t[:0] for t, salt in zip(s.tokens, salts)
            ]
            if found:
                contents = np.repeat(s.contents, [len(f) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), pa.array(contents)], names=["token", "content"]
                )

    return run


def _windows_task(streams_of: StreamsOf, size: int, part: int, sketch, slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dense(sketch.value, slots).astype(bool)
        rolling = Rolling(size)
        for s in streams_of(batches):
            salts = mixed(s.scopes.view(np.uint64))
            of, first, second, places = [], [], [], []
            for i, (tokens, salt) in enumerate(zip(s.tokens, salts)):
                if len(tokens) < size:
                    continue
                keys = (minimizers(tokens, size, part) ^ salt) & np.uint64(slots - 1)
                at = np.flatnonzero(known[keys.astype(np.int64)])
                if len(at):
                    of.append(np.full(len(at), i))
                    first.append(rolling.of(tokens, 0x1234567)[at] ^ salt)
                    second.append(rolling.of(tokens, 0x89ABCDE)[at] >> np.uint64(33))
                    places.append(at)
            if of:
                i = np.concatenate(of)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(first).view(np.int64)),
                        pa.array(np.concatenate(second).astype(np.int32)),
                        pa.array(s.owners[i]),
                        pa.array(s.rows[i].astype(np.int32)),
                        pa.array(np.concatenate(places).astype(np.int32)),
                    ],
                    names=["h1", "h2", "owner", "row", "at"],
                )

    return run


def shared_windows(rows: DataFrame, streams_of: StreamsOf, *, size: int, part: int, slots: int = SLOTS) -> DataFrame:
    """(h1, h2, owner, row, at), stored: the windows whose minimizer is in several contents."""
    parts = rows.mapInArrow(_minimizers_task(streams_of, size, part), "token bigint, content bigint")
    shared = (
        parts.groupBy("token")
        .agg(F.min("content").alias("lo"), F.max("content").alias("hi"))
        .where("lo <> hi")
        .select(slot_of(F.col("token"), slots).alias("slot"), F.lit(1).alias("level"))
    )
    sketch = rows.sparkSession.sparkContext.broadcast(collect_slots(shared, slots))
    return stored(
        rows.mapInArrow(
            _windows_task(streams_of, size, part, sketch, slots), "h1 bigint, h2 int, owner bigint, row int, at int"
        ),
        "windows",
    )


def repeated_windows(rows: DataFrame, streams_of: StreamsOf, *, size: int, part: int, slots: int = SLOTS) -> DataFrame:
    """(owner, row, at, first_owner): windows that also occur for another owner of their scope, with the
    smallest owner they occur for. All such windows are there whose minimizer is in several contents."""
    windows = shared_windows(rows, streams_of, size=size, part=part, slots=slots)
    known = (
        windows.groupBy("h1", "h2")
        .agg(F.min("owner").alias("first_owner"), F.max("owner").alias("hi"), F.count(F.lit(1)).alias("n"))
        .where("first_owner <> hi")
        .drop("hi")
    )
    found = join_counted(windows, stored(known, "repeated-windows"), ["h1", "h2"])
    return found.select("owner", "row", "at", "first_owner")
