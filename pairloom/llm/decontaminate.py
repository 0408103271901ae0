"""Benchmark decontamination by greedy string tiling.

Seeds are runs of `MIN_TILE` words of a benchmark item (an item with fewer words is one seed). A sketch of
fixed size keeps, of every document, only the words inside possible seeds. Documents and items that
share seeds are joined; of each item only as many of its rarest seeds take part as an item covered
enough must share. Each pair is then tiled: the longest common runs of words not yet marked are found
by running Karp-Rabin hashes, marked, and the search goes on with shorter ones, so passages in
another order are found too. A document is contaminated by an item if its tiles cover at least
`COVERAGE` of the item's words.

Words are the runs without white space and ASCII punctuation, lower-cased. Nulls: a null or empty text or item has no words and matches nothing;
rows without an id are kept and never reported. Repeated rows are reported once. Empty tables: nothing
is contaminated.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.common import (
    PUNCTUATION,
    SPACES,
    WordHasher,
    by_bytes,
    collect_slots,
    dense,
    gram_hashes,
    list_array,
    slot_of,
    stored,
    text_bytes,
)

MIN_TILE = 5
COVERAGE = 0.6
SLOTS = 1 << 22
GAP = 0  # stands between the runs kept of a document; no word has this hash
PRIME = (1 << 61) - 1
BASE = 0x5DEECE66D


def plain_words(hasher: WordHasher, texts: pa.Array) -> list[np.ndarray]:
    """Word hashes, lower-cased and without punctuation; none is GAP."""
    lowered = [t.decode("utf-8").lower().encode("utf-8") for t in text_bytes(texts)]
    return [np.maximum(w, np.uint64(1)) for w in hasher.each(lowered)]


def _items_task(min_tile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACES + PUNCTUATION)
        for part in by_bytes(batches, 1):
            words = plain_words(hasher, part.column(1))
            seeds = [gram_hashes(w, min(min_tile, len(w))) if len(w) else w for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([min(min_tile, len(w)) for w in words], pa.int32()),
                    *[
                        list_array(np.concatenate(x).view(np.int64), np.array([len(i) for i in x]), pa.int64())
                        for x in (words, seeds)
                    ],
                ],
                names=["item_id", "tile", "words", "seeds"],
            )

    return run


def _hits_task(tiles: list[int], sketch, slots: int):
    """Of each document with possible seeds: those seeds, and the words they cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACES + PUNCTUATION)
        known = dense(sketch.value, slots).astype(bool)
        for part in by_bytes(batches, 1):
            rows, seeds, runs = [], [], []
            for row, words in enumerate(plain_words(hasher, part.column(1))):
                covered = np.zeros(len(words) + 1, np.int64)
                found = []
                for tile in tiles:
                    grams = gram_hashes(words, tile)
                    at = np.flatnonzero(known[(grams & np.uint64(slots - 1)).astype(np.int64)])
                    np.add.at(covered, at, 1)
                    np.add.at(covered, at + tile, -1)
                    found.append(grams[at])
                inside = np.cumsum(covered)[:-1] > 0
                if inside.any():
                    rows.append(row)
                    seeds.append(np.unique(np.concatenate(found)))
                    kept = np.where(inside, words, np.uint64(GAP))
                    runs.append(kept[inside | np.concatenate(([False], inside[:-1]))])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows)),
                        *[
                            list_array(np.concatenate(x).view(np.int64), np.array([len(i) for i in x]), pa.int64())
                            for x in (seeds, runs)
                        ],
                    ],
                    names=["doc_id", "seeds", "runs"],
                )

    return run


def _windows(tokens: list[int], marked: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(start, running Karp-Rabin hash) of each run of `size` tokens without a marked one."""
    top = pow(BASE, size - 1, PRIME)
    value = held = 0
    for end, token in enumerate(tokens):
        if marked[end]:
            value = held = 0
            continue
        if held == size:
            value = (value - tokens[end - size] * top) % PRIME
            held -= 1
        value = (value * BASE + token) % PRIME
        held += 1
        if held == size:
            yield end - size + 1, value


def tile(item: list[int], text: list[int], least: int) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in text, length) of `least` tokens or more, longest first."""
    item_marked = [False] * len(item)
    text_marked = [t == GAP for t in text]
    tiles: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), 64))
    while True:
        places = defaultdict(list)
        for start, value in _windows(text, text_marked, size):
            places[value].append(start)
        matches = defaultdict(list)
        for i, value in _windows(item, item_marked, size):
            for t in places.get(value, ()):
                length = 0
                while (
                    i + length < len(item)
                    and t + length < len(text)
                    and item[i + length] == text[t + length]
                    and not item_marked[i + length]
                    and not text_marked[t + length]
                ):
                    length += 1
                if length >= size:
                    matches[length].append((i, t))
        longest = max(matches, default=0)
        if longest > 2 * size:
            size = longest
            continue
        while matches:
            length = max(matches)
            for i, t in matches.pop(length):
                free = 0
                while free < length and not item_marked[i + free] and not text_marked[t + free]:
                    free += 1
                if free == length:
                    item_marked[i : i + length] = [True] * length
                    text_marked[t : t + length] = [True] * length
                    tiles.append((i, t, length))
                elif free >= size:
                    matches[free].append((i, t))
        if size == least:
            return tiles
        size = max(least, size // 2)


@F.arrow_udf(T.StructType([T.StructField("covered", T.IntegerType()), T.StructField("tiles", T.IntegerType())]))
def _tiled(items: pa.Array, runs: pa.Array, least: pa.Array) -> pa.Array:
    out = []
    for item, run, n in zip(items.to_pylist(), runs.to_pylist(), least.to_pylist()):
        tiles = tile(item, run, n)
        out.append({"covered": sum(t[2] for t in tiles), "tiles": len(tiles)})
    return pa.array(out, pa.struct([("covered", pa.int32()), ("tiles", pa.int32())]))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, min_tile: int = MIN_TILE, coverage: float = COVERAGE
) -> DataFrame:
    """(doc_id, item_id, n_words, n_covered, n_tiles, coverage): every contaminated pair."""
    spark = docs.sparkSession
    items = stored(
        benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
            _items_task(min_tile), "item_id bigint, tile int, words array<bigint>, seeds array<bigint>"
        ).where("tile > 0 and item_id is not null"),
        "bench-items",
    )
    seeds = items.select("item_id", "tile", F.size("words").alias("n_words"), F.posexplode("seeds").alias("pos", "seed"))
    # At most min_tile - 1 lengths below min_tile exist, so this list is short.
    tiles = [r["tile"] for r in items.select("tile").distinct().collect()]
    sketch = spark.sparkContext.broadcast(
        collect_slots(seeds.select(slot_of(F.col("seed"), SLOTS).alias("slot"), F.lit(1).alias("level")), SLOTS)
    )
    hits = stored(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .where("doc_id is not null")
        .mapInArrow(_hits_task(tiles, sketch, SLOTS), "doc_id bigint, seeds array<bigint>, runs array<bigint>")
        .withColumn("hit", F.monotonically_increasing_id()),
        "bench-hits",
    )
    # An item covered enough shares at least `needed` of its seeds' places; its commonest
    # `needed` - 1 may be left out.
    needed = F.greatest(F.lit(1), F.ceil(F.col("n_words") * coverage / F.col("tile") - 1e-9))
    common = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("often"))
    by_commonness = Window.partitionBy("item_id").orderBy(F.desc("often"), "seed", "pos")
    rare = (
        seeds.join(common, "seed")
        .withColumn("nth", F.row_number().over(by_commonness))
        .where(F.col("nth") >= needed)
        .select("item_id", "seed")
        .distinct()
    )
    pairs = hits.select("hit", F.explode("seeds").alias("seed")).join(rare, "seed").select("hit", "item_id").distinct()
    tiled = (
        pairs.join(hits.select("hit", "doc_id", "runs"), "hit")
        .join(items.select("item_id", "tile", "words"), "item_id")
        .select("doc_id", "item_id", F.size("words").alias("n_words"), _tiled("words", "runs", "tile").alias("found"))
        .select(
            "doc_id",
            "item_id",
            "n_words",
            F.col("found.covered").alias("n_covered"),
            F.col("found.tiles").alias("n_tiles"),
            (F.col("found.covered") / F.col("n_words")).alias("coverage"),
        )
    )
    return tiled.where(F.col("coverage") >= coverage).distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no benchmark item contaminates, with their own columns."""
    bad = contaminated(docs, benchmark).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
