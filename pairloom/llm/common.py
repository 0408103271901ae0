"""Helpers shared by the operators: stored tables, word hashes, bounded sketches, components."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.session import remove_folder, work_dir

BATCH_BYTES = 1 << 19
HOT_KEYS = 1000
# The characters between words.
SPACES = b" \t\n\x0b\x0c\r"
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """`df` written once to the shared folder and read back: lineage ends there, so a lost executor
    costs a read, not a recomputation."""
    path = work_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def reclaim(spark: SparkSession) -> None:
    """Have the driver collect what finished jobs left behind; only so does Spark's cleaner delete their
    shuffle files and broadcasts before the driver's memory is full."""
    gc.collect()
    spark._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Delete tables that `stored` wrote and nothing reads any more, and what made them."""
    for table in tables:
        remove_folder(table.sparkSession, table.stored_at)
    if tables:
        reclaim(tables[0].sparkSession)


def join_counted(rows: DataFrame, keyed: DataFrame, on: list[str]) -> DataFrame:
    """`rows` joined with `keyed`, one row for each key with the number `n` of its rows. Keys that have more
    than one in `HOT_KEYS` of the rows, of which there are fewer than that, come by broadcast, so that
    none fills a task; all others by a shuffle. Both tables are read several times and should be stored."""
    total = rows.count()
    hot = F.broadcast(keyed.where(F.col("n") * HOT_KEYS > total).drop("n"))
    cold = keyed.where(F.col("n") * HOT_KEYS <= total).drop("n")
    return rows.join(hot, on).unionByName(rows.join(hot.select(*on), on, "left_anti").join(cold, on))


def same_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in like.columns])


def by_bytes(batches: Iterable[pa.RecordBatch], column: int, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each hold about `limit` bytes; a longer text is alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(sizes)]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


class WordHasher:
    """64-bit hashes of all words of many texts at once, by a running polynomial over the bytes.

    Words are the runs between separators. Each byte stands for a fixed random number, so different
    words share a hash with a chance of about 2^-64.
    """

    def __init__(self, separators: bytes = SPACES):
        self.values = np.random.default_rng(20240229).integers(0, 1 << 64, 256, np.uint64)
        self.is_separator = np.zeros(256, bool)
        self.is_separator[list(separators)] = True
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            with np.errstate(over="ignore"):
                self.powers, self.inverses = (
                    np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, b, np.uint64)))) for b in (BASE, BASE_INVERSE)
                )

    def _slice(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, starts) of the words in bytes that end with a separator."""
        raw = np.frombuffer(data, np.uint8)
        self._grow(len(raw))
        separator = self.is_separator[raw]
        edges = np.flatnonzero(separator[1:] != separator[:-1]) + 1
        if not separator[0]:
            edges = np.concatenate(([0], edges))
        starts, ends = edges[0::2], edges[1::2]
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.values[raw] * self.powers[: len(raw)], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * self.inverses[starts]
        return mixed(hashes + (ends - starts).astype(np.uint64)), starts

    def of(self, text: bytes) -> np.ndarray:
        """Hashes of one text's words; a long text goes through in slices cut at separators."""
        found, at = [], 0
        while at < len(text):
            end = at + BATCH_BYTES
            while end < len(text) and not self.is_separator[text[end]]:
                end += 1
            found.append(self._slice(text[at:end] + b" ")[0])
            at = end
        return np.concatenate(found) if found else np.empty(0, np.uint64)

    def each(self, texts: list[bytes]) -> list[np.ndarray]:
        """The word hashes of each text."""
        if sum(map(len, texts)) > 2 * BATCH_BYTES:
            return [self.of(t) for t in texts]
        if not texts:
            return []
        hashes, starts = self._slice(b" ".join(texts) + b" ")
        ends = np.cumsum([len(t) + 1 for t in texts])
        return np.split(hashes, np.searchsorted(starts, ends[:-1]))


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of `n` words."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - n + 1 + i]
    return mixed(total)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    if offsets[-1] >= 1 << 31:
        raise OverflowError("a batch holds more than 2^31 values")
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def slot_of(key: Column, slots: int) -> Column:
    """Place of a long in a sketch of `slots` (a power of two) places; numpy's `h & (slots - 1)`."""
    return key.bitwiseAND(F.lit(slots - 1)).cast("int")


def collect_slots(rows: DataFrame, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(slot, level) combined by place: at most `slots` rows reach the driver, whatever the input."""
    table = rows.groupBy("slot").agg(F.max("level").cast("tinyint").alias("level")).toArrow()
    return (
        table.column("slot").to_numpy().astype(np.int32),
        table.column("level").to_numpy().astype(np.uint8),
    )


def dense(sketch: tuple[np.ndarray, np.ndarray], slots: int) -> np.ndarray:
    out = np.zeros(slots, np.uint8)
    out[sketch[0]] = sketch[1]
    return out


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def components(links: DataFrame) -> DataFrame:
    """(node, label) of the nodes of `links(a, b)`, by contraction: each node is merged into the
    smallest node among itself and its neighbours, until no link is left. Nothing but the number of
    links left reaches the driver. Node numbers should be hashes; then few rounds suffice."""
    spark = links.sparkSession
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("b"))
        step = stored(least.select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "parents")
        steps.append(step)
        before, edges = edges, stored(
            edges.join(step.select(F.col("node").alias("a"), F.col("label").alias("x")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("label").alias("y")), "b")
            .where("x <> y")
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
            .distinct(),
            "links",
        )
        remove_folder(spark, before.stored_at)
    if not steps:
        return empty_like(spark, "node bigint, label bigint")
    labels = steps[0]
    for step in steps[1:]:
        up = step.select(F.col("node").alias("label"), F.col("label").alias("up"))
        labels = labels.join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label"))
    return labels
