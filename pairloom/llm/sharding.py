"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Row i of the matrix says how many rows of partition i go to each cell; a cell is a block of at most
`CELL_ROWS` places of one shard. The matrix is the one a uniform permutation of all rows would give: a
multivariate hypergeometric draw with the partitions' row counts and the cells' sizes as margins. It is
drawn by halving: of the rows of a span of partitions, how many of each cell's places lie in the first
half. Every draw is seeded by its span, so each task draws the path to its own partition alone, and a
task that runs again draws the same. Then a task deals its rows out in random order to its cells (the
local permutation), rows are exchanged by cell, and each cell is put in random order.

The law is `rows`: shard sizes differ by one at most. Only the partitions' row counts reach the driver.
The table must be read from stored files, whose partitions are the same in both passes; a task that
sees another number of rows than was counted fails the job.

Nulls and empty or long texts need no care, as rows are moved whole; repeated rows are rows of their
own. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL_ROWS = 4096
ROW_BITS = 33  # of monotonically_increasing_id, below the partition's number
EXACT = 10**9  # numpy draws up to this many


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of `draws` of good + bad things are good."""
    if good + bad < EXACT:
        return int(rng.hypergeometric(good, bad, draws)) if draws else 0
    # by inversion, outwards from the mode; probabilities beyond 12 deviations are below any double
    total = good + bad
    low, high = max(0, draws - bad), min(good, draws)
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    deviation = (draws * (good / total) * (bad / total) * ((total - draws) / max(total - 1, 1))) ** 0.5
    k = np.arange(max(low, mode - int(12 * deviation) - 2), min(high, mode + int(12 * deviation) + 2) + 1)
    ratio = np.log(good - k[:-1]) + np.log(draws - k[:-1]) - np.log(k[1:]) - np.log(bad - draws + k[1:])
    log_p = np.concatenate(([0.0], np.cumsum(ratio)))
    p = np.cumsum(np.exp(log_p - log_p.max()))
    return int(k[np.searchsorted(p, rng.random() * p[-1])])


def split(rng: np.random.Generator, cells: np.ndarray, draws: int) -> np.ndarray:
    """How many of each cell's places fall to the first `draws` of all rows."""
    taken = np.zeros(len(cells), np.int64)
    rest = int(cells.sum())
    for i in np.flatnonzero(cells):
        if not draws:
            break
        rest -= int(cells[i])
        taken[i] = hypergeometric(rng, int(cells[i]), rest, draws)
        draws -= int(taken[i])
    return taken


def matrix_row(counts: np.ndarray, cells: np.ndarray, at: int, seed: int) -> np.ndarray:
    """Row `at` of the matrix: rows of that partition for each cell."""
    ends = np.concatenate(([0], np.cumsum(counts)))
    low, high = 0, len(counts)
    while high - low > 1:
        middle = (low + high) // 2
        first = split(np.random.default_rng([seed, low, high]), cells, int(ends[middle] - ends[low]))
        if at < middle:
            cells, high = first, middle
        else:
            cells, low = cells - first, middle
    return cells


def cell_table(total: int, shards: int, cell_rows: int) -> np.ndarray:
    """(shard, first slot, size) of each cell."""
    rows = []
    for shard in range(shards):
        size = total // shards + (shard < total % shards)
        blocks = max(1, -(-size // cell_rows))
        cuts = [size * b // blocks for b in range(blocks + 1)]
        rows += [(shard, a, b - a) for a, b in zip(cuts, cuts[1:])]
    return np.array(rows, np.int64)


def _deal(partitions: np.ndarray, counts: np.ndarray, cells: np.ndarray, seed: int):
    @F.arrow_udf("struct<cell int, shard int, first bigint, luck bigint>")
    def dealt(numbers: Iterator[pa.Array]) -> Iterator[pa.Array]:
        part, seen, order, luck = -1, 0, None, None

        def finished() -> None:
            if part >= 0 and seen != len(order):
                raise RuntimeError(f"partition {part}: {seen} rows, but {len(order)} were counted")

        for batch in numbers:
            ids = batch.to_numpy(zero_copy_only=False)
            out = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
            for p in np.unique(ids >> ROW_BITS):
                if p != part:
                    finished()
                    at = int(np.searchsorted(partitions, p))
                    row = matrix_row(counts, cells[:, 2], at, seed)
                    rng = np.random.default_rng([seed, int(p)])
                    order = rng.permutation(np.repeat(np.arange(len(cells)), row))
                    luck = rng.integers(-(1 << 62), 1 << 62, len(order))
                    part, seen = int(p), 0
                mine = np.flatnonzero(ids >> ROW_BITS == p)
                places = ids[mine] & ((1 << ROW_BITS) - 1)
                if len(places) and places.max() >= len(order):
                    raise RuntimeError(f"partition {p}: more rows than the {len(order)} counted")
                out[0][mine], out[1][mine] = order[places], luck[places]
                seen += len(mine)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(out[0], pa.int32()),
                    pa.array(cells[out[0], 0], pa.int32()),
                    pa.array(cells[out[0], 1]),
                    pa.array(out[1]),
                ],
                names=["cell", "shard", "first", "luck"],
            )
        finished()

    return dealt


def shuffle_to_shards(df: DataFrame, shards: int, *, seed: int = 20240229, cell_rows: int = CELL_ROWS) -> DataFrame:
    """`df` plus shard and slot: a uniform random permutation cut into shards of equal size."""
    number = F.monotonically_increasing_id()
    counted = sorted(
        tuple(r)
        for r in df.select(F.shiftright(number, ROW_BITS).alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    partitions, counts = (np.array([r[k] for r in counted], np.int64) for k in (0, 1))
    cells = cell_table(int(counts.sum()), shards, cell_rows)
    placed = df.withColumn("__number", number).withColumn("__to", _deal(partitions, counts, cells, seed)("__number"))
    within = Window.partitionBy("__to.cell").orderBy("__to.luck", "__number")
    return placed.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in ("shard", "slot")],
        F.col("__to.shard").alias("shard"),
        (F.col("__to.first") + F.row_number().over(within) - 1).alias("slot"),
    )
