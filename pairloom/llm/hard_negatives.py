"""Hard negatives by bounds along a spanning tree of the anchors.

A row's score for an anchor is its inner product with it, in whole numbers. For a row c and anchors a
(parent) and b (child), <c, b> = <c, a> + <c, b - a>, so the score at b lies within |b - a| * |c| of the
one at a. Near anchors are put into one group, and each group gets a spanning tree of least total edge
length. A block of rows then walks down a group's tree: exact scores at the root, an interval for every
row at each further anchor, and exact scores only where the interval overlaps the window in question.

Two walks: the first looks for the best rows of the same label (window: from the worst of the best found so
far upwards), the second for rows of other labels between the least and the largest bound that the
anchor's positives set. Each returns a few rows for an anchor and block; `row_number` with a limit,
which Spark applies before and after the shuffle, keeps the best of all blocks.

Scale: the anchors are the stated query set, and every block of rows meets every group, as a join on
(group, block) whose sides are repeated once for each block or group. So the work is rows times
anchors, less what the bounds spare; a task holds one block and one group (`BLOCK`, `GROUP`), whatever
the label's share or the number of equal vectors. Where anchors are far apart, as random vectors are,
the bounds spare little.

Nulls: rows without a label, a vector or an id, or with a null or non-finite component, take no part.
Rows that repeat an id count once, with the smallest (label, vector). Vectors of different lengths are
compared as if the shorter ended in zeros; an empty one scores 0. Ties go to the smaller id. Scores
that could pass 2^62 raise an OverflowError. Other columns are not looked at. Empty tables, and
anchors without positives or negatives, give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairloom.llm.common import discard, stored

SCALE = 256
BLOCK = 8192  # rows that a task holds
GROUP = 512  # anchors that share a tree, about
MOST_PIVOTS = 1024  # anchors that groups form around; chosen by hash
POSITIVES = 5
NEGATIVES = 3
EXACT = float(1 << 53)  # whole numbers up to this are exact as doubles
ROWS = "vec_id bigint, label int, v array<bigint>"
TREE = f"grp int, place int, parent int, {ROWS}"
SCORES = "anchor_id bigint, vec_id bigint, score bigint"
NEGATIVE_SCORES = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"


def whole_vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, v): rows that take part, with whole components and the label as it counts."""
    x = F.col(f"`{vector}`")
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.lit(False)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        label.cast("int").alias("label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * SCALE)).alias("v"),
    )
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("x")).select("vec_id", "x.label", "x.v")


def _matrix(column: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Vectors as the rows of a matrix, ended with zeros."""
    lists = column.combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy()
    out = np.zeros((len(lengths), max(width, lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def _numbers(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with one width, as doubles if all inner products are exact in them."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    most = float(width) * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if most >= float(1 << 62):
        raise OverflowError("scores could pass 2^62")
    return (a.astype(float), b.astype(float)) if most < EXACT else (a, b)


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, parent): a tree of least total edge length from the vector nearest to the mean, and an
    order in which parents come first. `parent` holds places in the order; the root's is -1."""
    v = vectors.astype(float)
    root = int(np.argmin(((v - v.mean(axis=0)) ** 2).sum(axis=1)))
    n = len(v)
    order, place = [root], np.full(n, -1)
    place[root] = 0
    nearest = np.full(n, root)
    distance = ((v - v[root]) ** 2).sum(axis=1)
    parents = [-1]
    distance[root] = np.inf
    for i in range(1, n):
        new = int(np.argmin(distance))
        order.append(new)
        parents.append(int(place[nearest[new]]))
        place[new] = i
        d = ((v - v[new]) ** 2).sum(axis=1)
        closer = (d < distance) & (place < 0)
        nearest[closer] = new
        distance = np.where(closer, d, distance)
        distance[new] = np.inf
    return np.array(order), np.array(parents)


def _tree_of_group(key, table):
    table = table.sort_by("vec_id")
    order, parent = spanning_tree(_matrix(table.column("v")))
    rows = table.select(["vec_id", "label", "v"]).take(pa.array(order))
    columns = [pa.array(np.full(len(order), key[0].as_py()), pa.int32()), pa.array(np.arange(len(order)), pa.int32())]
    names = ["grp", "place", "parent", "vec_id", "label", "v"]
    return pa.Table.from_arrays([*columns, pa.array(parent, pa.int32()), *rows.columns], names=names)


def anchor_trees(anchors: DataFrame) -> DataFrame:
    """(grp, place, parent, vec_id, label, v): the anchors in groups of near ones, each with its tree.

    Groups form around a bounded number of anchors chosen by hash; one that is too large, such as one of equal
    vectors, is dealt out by hash into several.
    """
    n = anchors.count()
    n_pivots = min(MOST_PIVOTS, -(-n // GROUP))
    pivots = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).select("v").toArrow()
    centres = _matrix(pivots.column("v"))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                v = _matrix(pa.chunked_array([part.column(2)]), centres.shape[1]).astype(float)
                c = np.pad(centres, ((0, 0), (0, v.shape[1] - centres.shape[1]))).astype(float)
                far = (c * c).sum(axis=1) - 2 * (v @ c.T)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(far.argmin(axis=1).astype(np.int32)), *part.columns], names=["pivot", "vec_id", "label", "v"]
                )

    near = stored(anchors.mapInArrow(nearest, f"pivot int, {ROWS}"), "anchor-pivots")
    parts = near.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("parts"))  # MOST_PIVOTS rows at most
    first = F.sum("parts").over(Window.orderBy("pivot").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("pivot", "parts", F.coalesce(first, F.lit(0)).cast("int").alias("first"))
    dealt = near.join(F.broadcast(parts), "pivot").select(
        (F.col("first") + F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("parts"))).cast("int").alias("grp"), "vec_id", "label", "v"
    )
    trees = stored(dealt.groupBy("grp").applyInArrow(_tree_of_group, TREE), "anchor-trees")
    discard(near)
    return trees


def _slack(scores: np.ndarray) -> np.ndarray:
    """More than the rounding of doubles can move a bound."""
    return 1e-3 + np.abs(scores) * 1e-12


def walk(
    rows: np.ndarray, tree: np.ndarray, parent: np.ndarray, window: Callable[[int, np.ndarray, np.ndarray], np.ndarray]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place, at, scores) of each anchor: the rows that its window may hold, and their exact scores.

    `window(place, low, high)` tells which rows' intervals overlap the window of the anchor at `place`.
    """
    norms = np.sqrt((rows.astype(float) ** 2).sum(axis=1))
    steps = np.sqrt(((tree[1:].astype(float) - tree[parent[1:]].astype(float)) ** 2).sum(axis=1))
    children = np.bincount(parent[1:], minlength=len(tree))
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for place in range(len(tree)):
        if place == 0:
            exact = rows @ tree[0]
            low, high = exact - _slack(exact), exact + _slack(exact)
            at = np.flatnonzero(window(place, low, high))
            exact = exact[at]
        else:
            above = int(parent[place])
            low, high = bounds[above]
            spread = steps[place - 1] * (1 + 1e-9) * norms
            low, high = low - spread - _slack(low), high + spread + _slack(high)
            at = np.flatnonzero(window(place, low, high))
            exact = rows[at] @ tree[place]
            low[at], high[at] = exact - _slack(exact), exact + _slack(exact)
            children[above] -= 1
            if children[above] == 0:
                del bounds[above]
        if children[place]:
            bounds[place] = low, high
        yield place, at, exact.astype(np.int64)


def _cell(anchors, rows):
    anchors = anchors.sort_by("place")
    tree, block = _numbers(_matrix(anchors.column("v")), _matrix(rows.column("v")))
    ids = {"vec_id": rows.column("vec_id").to_numpy(), "label": rows.column("label").to_numpy()}
    return anchors, tree, anchors.column("parent").to_numpy(), block, ids["vec_id"], ids["label"]


def _best_of_label(anchors, rows):
    """The best POSITIVES rows of each anchor's label in one block."""
    if anchors.num_rows == 0 or rows.num_rows == 0:
        return pa.Table.from_arrays([pa.array([], pa.int64())] * 3, names=["anchor_id", "vec_id", "score"])
    anchors, tree, parent, block, ids, labels = _cell(anchors, rows)
    anchor_ids, anchor_labels = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy()

    def window(place, low, high):
        mine = (labels == anchor_labels[place]) & (ids != anchor_ids[place])
        sure = low[mine]
        if len(sure) > POSITIVES:
            mine &= high >= np.partition(sure, len(sure) - POSITIVES)[len(sure) - POSITIVES]
        return mine

    found = []
    for place, at, scores in walk(block, tree, parent, window):
        best = np.lexsort((ids[at], -scores))[:POSITIVES]
        found.append((np.full(len(best), anchor_ids[place]), ids[at][best], scores[best]))
    return pa.Table.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)], names=["anchor_id", "vec_id", "score"])


def _best_in_windows(anchors, rows):
    """For each anchor and positive, the best NEGATIVES rows of one block in its window."""
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    if anchors.num_rows == 0 or rows.num_rows == 0:
        return pa.Table.from_arrays([pa.array([], pa.int64())] * 5, names=names)
    anchors, tree, parent, block, ids, labels = _cell(anchors, rows)
    anchor_ids, anchor_labels = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy()
    positives = [[(p["vec_id"], p["score"]) for p in row or ()] for row in anchors.column("positives").to_pylist()]
    # whole scores s with 50 p <= 100 s <= 95 p
    windows = [[(i, p, -(-p // 2), 95 * p // 100) for i, p in row] for row in positives]
    lows, highs = ([f((w[k] for w in row), default=0) for row in windows] for f, k in ((min, 2), (max, 3)))

    def window(place, low, high):
        if not windows[place]:
            return np.zeros(len(ids), bool)
        return (labels != anchor_labels[place]) & (high >= lows[place]) & (low <= highs[place])

    found = []
    for place, at, scores in walk(block, tree, parent, window):
        order = np.lexsort((ids[at], -scores))
        sorted_scores, sorted_ids = -scores[order], ids[at][order]
        for positive, score, low, high in windows[place]:
            start, end = np.searchsorted(sorted_scores, -high, "left"), np.searchsorted(sorted_scores, -low, "right")
            for i in range(start, min(end, start + NEGATIVES)):
                found.append((anchor_ids[place], positive, score, sorted_ids[i], -sorted_scores[i]))
    columns = list(zip(*found)) or [()] * 5
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _in_cells(trees: DataFrame, rows: DataFrame, groups: int, blocks: int, of_cell, schema: str) -> DataFrame:
    """`of_cell(anchors, rows)` for each group of anchors and each block of rows."""
    left = trees.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = rows.select(
        "*",
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"),
    )
    return left.groupBy("grp", "block").cogroup(right.groupBy("grp", "block")).applyInArrow(of_cell, schema)


def _first(df: DataFrame, n: int, by: list[str], *order: Column) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def hard_negatives(table: DataFrame, *, vector: str = "embedding", every: int = 50) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors, the rows
    whose vec_id `every` divides."""
    rows = stored(whole_vectors(table, vector), "vectors")
    anchors = rows.where(F.col("vec_id") % every == 0)
    n = rows.count()
    blocks = max(1, -(-n // BLOCK))
    trees = anchor_trees(anchors)
    groups = (trees.agg(F.max("grp")).first()[0] or 0) + 1
    found = _in_cells(trees, rows, groups, blocks, _best_of_label, SCORES)
    positives = stored(_first(found, POSITIVES, ["anchor_id"], F.desc("score"), F.asc("vec_id")).drop("rank"), "positives")
    listed = positives.groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives"))
    asked = trees.join(listed.withColumnRenamed("anchor_id", "vec_id"), "vec_id", "left").select(*trees.columns, "positives")
    negatives = _in_cells(asked, rows, groups, blocks, _best_in_windows, NEGATIVE_SCORES)
    return _first(negatives, NEGATIVES, ["anchor_id", "positive_id"], F.desc("negative_score"), F.asc("negative_id")).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
