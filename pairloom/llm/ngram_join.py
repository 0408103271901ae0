"""N-gram Jaccard join by grouped prefixes, and the components it links.

Documents with equal shingle sets are one node. Shingles are put in one order for all documents, the
common ones last; two sets that are similar enough share a shingle in their prefixes. Nodes with the
same prefix and size form a group, and only groups meet: in the buckets of their prefix shingles,
filtered by size and position. Group pairs that pass are expanded to members, filtered once more by a
parity sketch, and verified on the whole sets.

A large cluster never emits all its pairs. First each group meets only one hub of each of its buckets,
and each member the first member of its group; then each node meets hubs among those that agree with
it in a part of its parity sketch. That links nearly all of a cluster in linear work. Last, in buckets
that still hold several components, every pair of nodes of different components is tried that the
sketches allow. Pairs left out are in one component already, so the components are exact.

The order: a shingle counted often among the hash-ordered prefixes has a high level in a sketch of
fixed size, and the order is (level, hash). Any fixed order is exact; this one keeps buckets small.

Nulls: a null or empty text has no shingles and is linked with nothing; a null doc_id keeps its row,
and is smaller than no other id. Repeated rows are equal sets. A text with fewer than n words is one
shingle. Empty tables give empty results. Shingles and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import (
    WordHasher,
    by_bytes,
    collect_slots,
    components,
    dense,
    discard,
    gram_hashes,
    list_array,
    mixed,
    reclaim,
    slot_of,
    stored,
    text_bytes,
)

SLOTS = 1 << 22
COMMON = 16  # a shingle in this many prefixes or more gets a level above 0
SKETCH_WORDS = 4  # longs in a parity sketch
# Parts of a long of the sketch in which nodes meet hubs, by turn; only the cost depends on them.
SKETCH_PARTS = ((0xFFFFFFFF, -1 << 32), (0x0000FFFF0000FFFF, ~0x0000FFFF0000FFFF))
KEYS = "doc_id bigint, node bigint, n bigint, prefix array<bigint>"
NODES = "node bigint, n bigint, prefix array<bigint>, sketch array<bigint>"
SETS = "node bigint, tokens array<bigint>"


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Different shingles in hash order; a shorter text is one shingle as a whole."""
    if len(words) == 0:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(words, min(size, len(words))))


def set_hash(tokens: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mixed(mixed(tokens).sum() ^ np.array([len(tokens)], np.uint64)).view(np.int64)[0])


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    hasher = WordHasher()
    for part in by_bytes(batches, 1):
        yield part, [shingle_set(w, size) for w in hasher.each([t.lower() for t in text_bytes(part.column(1))])]


def _longs(arrays: list[np.ndarray]) -> pa.Array:
    values = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return list_array(values.view(np.int64), np.fromiter(map(len, arrays), np.int64, len(arrays)), pa.int64())


def _keys_task(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, size):
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _longs([s[: prefix_length(len(s), percent)] if len(s) else s for s in sets]),
                ],
                names=["doc_id", "node", "n", "prefix"],
            )

    return run


def _parity(tokens: np.ndarray) -> np.ndarray:
    """Odd or even number of tokens at each of the sketch's bits; what two sketches differ in is at
    most what the sets differ in."""
    counts = np.bincount((tokens >> np.uint64(40)).astype(np.int64) % (64 * SKETCH_WORDS), minlength=64 * SKETCH_WORDS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.uint64)


def _nodes_task(size: int, percent: int, sketch, slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = dense(sketch.value, slots)
        for _, sets in _sets(batches, size):
            sets = [s for s in sets if len(s)]
            prefixes = []
            for s in sets:
                order = np.argsort(levels[(s & np.uint64(slots - 1)).astype(np.int64)], kind="stable")
                prefixes.append(s[order[: prefix_length(len(s), percent)]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_hash(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _longs(prefixes),
                    _longs([_parity(s) for s in sets]),
                ],
                names=["node", "n", "prefix", "sketch"],
            )

    return run


def _postings_task(sketch, slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = dense(sketch.value, slots).astype(bool)
        for batch in batches:
            prefixes = batch.column(1)
            tokens = prefixes.flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(prefixes.offsets.to_numpy())
            pos = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            keep = shared[((tokens.view(np.uint64) >> np.uint64(32)) & np.uint64(slots - 1)).astype(np.int64)]
            gids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array(gids[keep]), pa.array(pos[keep].astype(np.int32)), pa.array(tokens[keep])],
                names=["gid", "pos", "token"],
            )

    return run


def _tokens_task(size: int, wanted, slots: int, without_id: bool):
    """Whole sets of the documents whose id falls on a wanted place, and of those without an id if asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = dense(wanted.value, slots).astype(bool)

        def chosen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                mask = here[(mixed(ids.view(np.uint64)) & np.uint64(slots - 1)).astype(np.int64)]
                yield batch.filter(pa.array(np.where(batch.column(0).is_valid().to_numpy(zero_copy_only=False), mask, without_id)))

        for _, sets in _sets(chosen(), size):
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_hash(s) for s in sets], pa.int64()), _longs(sets)], names=["node", "tokens"]
            )

    return run


def _slots_task(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            place = np.unique((mixed(ids.view(np.uint64)) & np.uint64(slots - 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array(np.ones(len(place), np.int8))], names=["slot", "level"]
            )

    return run


class NgramJoin:
    """One join: links between nodes, and the component of every document."""

    def __init__(self, docs: DataFrame, *, size: int, percent: int, doc_id: str = "doc_id", text: str = "text"):
        self.spark = docs.sparkSession
        self.docs = docs.select(
            F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
        )
        self.size, self.percent = size, percent
        reclaim(self.spark)  # the shuffles of what came before
        with_prefix = stored(self.docs.mapInArrow(_keys_task(size, percent), KEYS), "ngram-keys")
        self.levels = self._levels(with_prefix)
        self.keys = stored(with_prefix.select("doc_id", "node", "n"), "ngram-ids")
        discard(with_prefix)
        self.sets = stored(
            self.keys.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id")), "ngram-sets"
        )

    # -- groups and buckets

    def _levels(self, keys: DataFrame):
        counts = keys.select(F.explode("prefix").alias("token")).groupBy("token").count()
        often = counts.where(F.col("count") >= COMMON).select(
            slot_of(F.col("token"), SLOTS).alias("slot"), F.floor(F.log2("count")).cast("tinyint").alias("level")
        )
        return self.spark.sparkContext.broadcast(collect_slots(often, SLOTS))

    def _members(self) -> DataFrame:
        """(node, n, prefix, sketch, gid), one row for each different set."""
        task = _nodes_task(self.size, self.percent, self.levels, SLOTS)
        nodes = self.docs.mapInArrow(task, NODES).groupBy("node").agg(
            *[F.first(c).alias(c) for c in ("n", "prefix", "sketch")]
        )
        return stored(nodes.withColumn("gid", F.xxhash64("n", "prefix")), "ngram-prefixes")

    def _shared_postings(self, groups: DataFrame) -> DataFrame:
        """(gid, pos, token) for the prefix shingles that several nodes have. Most have one only: a
        sketch drops nearly all of those in the scan, a join with the exact counts the rest."""
        shared = (
            groups.select("size", F.explode("prefix").alias("token")).groupBy("token").agg(F.sum("size").alias("nodes"))
            .where("nodes > 1")
            .select("token")
        )
        shared = stored(shared, "ngram-shared")
        slots = shared.select(slot_of(F.shiftrightunsigned("token", 32), SLOTS).alias("slot"), F.lit(1).alias("level"))
        sketch = self.spark.sparkContext.broadcast(collect_slots(slots, SLOTS))
        postings = groups.select("gid", "prefix").mapInArrow(
            _postings_task(sketch, SLOTS), "gid bigint, pos int, token bigint"
        )
        return postings.join(shared, "token", "left_semi")

    def _alpha(self, a: Column, b: Column) -> Column:
        """Least overlap of two sets of sizes a and b that are similar enough."""
        return F.ceil((a + b) * self.percent / (100 + self.percent) - 1e-9)

    def _may_link(self, a: str, b: str) -> Column:
        """Size and position filter for two rows that meet in a bucket: the bucket of the first
        shingle they share passes if they are similar enough."""
        na, nb, ia, ib = (F.col(f"{r}.{c}") for c in ("n", "pos") for r in (a, b))
        return (F.least(na, nb) * 100 >= F.greatest(na, nb) * self.percent) & (
            1 + F.least(na - ia - 1, nb - ib - 1) >= self._alpha(na, nb)
        )

    def _sketches_allow(self, na: Column, nb: Column, sa: Column, sb: Column) -> Column:
        """Not so if the sketches alone differ in more than similar enough sets can."""
        differ = sum((F.bit_count(sa[i].bitwiseXOR(sb[i])) for i in range(SKETCH_WORDS)), F.lit(0))
        return differ <= na + nb - 2 * self._alpha(na, nb)

    def _verified(self, pairs: DataFrame, members: DataFrame) -> DataFrame:
        """The pairs (a, b) of nodes that are similar enough."""
        side = lambda c: members.select(
            F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")
        )
        near = (
            pairs.distinct()
            .join(side("a"), "a")
            .join(side("b"), "b")
            .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent)
            .where(self._sketches_allow(*map(F.col, ("na", "nb", "sa", "sb"))))
            .select("a", "b", "na", "nb")
        )
        near = stored(near, "ngram-pairs")
        reclaim(self.spark)
        involved = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
        first = involved.join(self.sets, "node").select("first_id")
        ids = first.where("first_id is not null")
        without_id = not first.where("first_id is null").isEmpty()  # a set that only rows without an id have
        wanted = self.spark.sparkContext.broadcast(
            collect_slots(ids.mapInArrow(_slots_task(SLOTS), "slot int, level tinyint"), SLOTS)
        )
        tokens = self.docs.mapInArrow(_tokens_task(self.size, wanted, SLOTS, without_id), SETS)
        tokens = stored(
            tokens.join(involved, "node", "left_semi").groupBy("node").agg(F.first("tokens").alias("tokens")),
            "ngram-tokens",
        )
        reclaim(self.spark)
        shared = F.size(F.array_intersect("ta", "tb"))
        links = stored(
            near.join(tokens.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
            .join(tokens.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b")
            .where(shared * 100 >= (F.col("na") + F.col("nb") - shared) * self.percent)
            .select("a", "b"),
            "ngram-links",
        )
        discard(near, tokens)
        return links

    def _meet_hubs(self, rows: DataFrame, *keys: str) -> DataFrame:
        """The pairs (a, b) of nodes when each row (keys, label, head, n, pos) meets the hub of its
        bucket: one row by a hash that also depends on the bucket, so a node meets many hubs."""
        hubs = (
            rows.groupBy(*keys)
            .agg(
                F.max(F.struct(F.xxhash64(*keys, "head").alias("rank"), "head", "label", "n", "pos")).alias("hub"),
                F.min("label").alias("lo"),
                F.max("label").alias("hi"),
            )
            .where("lo <> hi")
            .select(*keys, "hub.head", "hub.label", "hub.n", "hub.pos")
        )
        return (
            rows.alias("x")
            .join(hubs.alias("h"), list(keys))
            .where((F.col("x.label") != F.col("h.label")) & self._may_link("x", "h"))
            .select(F.least("x.head", "h.head").alias("a"), F.greatest("x.head", "h.head").alias("b"))
        )

    def _pieces(self, nodes: DataFrame, masks: tuple[int, ...]) -> DataFrame:
        """Buckets of equal parts of the parity sketch: sets that differ in little have several."""
        pieces = [
            F.struct(F.lit(i * len(masks) + j).alias("place"), F.col("sketch")[i].bitwiseAND(F.lit(mask)).alias("piece"))
            for i in range(SKETCH_WORDS)
            for j, mask in enumerate(masks)
        ]
        return nodes.select(
            F.col("node").alias("head"), "label", "n", F.lit(0).alias("pos"), self._band().alias("band"), F.inline(F.array(*pieces))
        )

    def _band(self) -> Column:
        return F.floor(F.log("n") / float(np.log(100 / self.percent))).cast("int")

    @staticmethod
    def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
        label = F.coalesce("label", "node").alias("label")
        return members.join(labels, "node", "left").select("node", "gid", label, "n", "sketch")

    def labels(self) -> DataFrame:
        """(node, label) of all nodes that are linked with another."""
        # prefixes are the bulk of these tables, and go as soon as the next one is made of them
        with_prefix = self._members()
        reclaim(self.spark)
        members = stored(with_prefix.drop("prefix"), "ngram-members")
        groups = stored(
            with_prefix.groupBy("gid").agg(
                F.min("node").alias("head"), F.count(F.lit(1)).alias("size"), *[F.first(c).alias(c) for c in ("n", "prefix")]
            ),
            "ngram-groups",
        )
        discard(with_prefix)
        postings = stored(
            self._shared_postings(groups).join(groups.select("gid", "head", "n", self._band().alias("band")), "gid"),
            "ngram-postings",
        )
        heads = stored(groups.where("size > 1").select("gid", "head"), "ngram-heads")
        discard(groups)
        across = self._meet_hubs(postings.withColumn("label", F.col("head")), "token", "band")
        within = members.join(heads, "gid").where("node <> head").select(
            F.col("node").alias("a"), F.col("head").alias("b")
        )
        links = self._verified(across.union(within), members)
        labels = stored(components(links), "ngram-labels")

        # hubs among nodes whose sketches agree in part, for what the first ones left open
        for masks in SKETCH_PARTS:
            rows = self._pieces(self._labelled(members, labels), masks)
            found = self._verified(self._meet_hubs(rows, "band", "place", "piece"), members)
            if not found.isEmpty():
                links = links.union(found)
                labels = stored(components(links), "ngram-labels")

        # what the hubs left open: nodes of different components in one bucket
        labelled = self._labelled(members, labels)
        # members of one group and component have one row; a single one brings its sketch along
        single = F.when(F.count(F.lit(1)) == 1, F.first("sketch")).alias("sketch")
        rows = (
            labelled.groupBy("gid", "label")
            .agg(single)
            .join(postings.select("gid", "n", "pos", "token"), "gid")
        )
        open_buckets = (
            rows.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token")
        )
        rows = stored(rows.join(open_buckets, "token", "left_semi"), "ngram-open")
        major = (
            rows.groupBy("token", "label")
            .count()
            .groupBy("token")
            .agg(F.max(F.struct("count", "label")).getField("label").alias("major"))
        )
        minor = rows.join(major, "token").where("label <> major")
        met = (
            minor.alias("x")
            .join(rows.alias("y"), "token")
            .where(
                (F.col("x.label") != F.col("y.label"))
                & ((F.col("y.label") == F.col("x.major")) | (F.col("x.label") < F.col("y.label")))
                & self._may_link("x", "y")
                & F.coalesce(self._sketches_allow(*[F.col(f"{r}.{c}") for c in ("n", "sketch") for r in "xy"]), F.lit(True))
            )
            .select(*[F.col(f"{r}.{c}").alias(f"{c}_{r}") for r in "xy" for c in ("gid", "label")])
            .distinct()
        )
        side = lambda r, c: labelled.select(
            F.col("node").alias(c),
            F.col("n").alias(f"n{c}"),
            F.col("sketch").alias(f"s{c}"),
            F.col("gid").alias(f"gid_{r}"),
            F.col("label").alias(f"label_{r}"),
        )
        pairs = (
            met.join(side("x", "a"), ["gid_x", "label_x"])
            .join(side("y", "b"), ["gid_y", "label_y"])
            .where(self._sketches_allow(*map(F.col, ("na", "nb", "sa", "sb"))))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        )
        more = self._verified(pairs, members)
        if not more.isEmpty():
            labels = stored(components(links.union(more)), "ngram-labels")
        discard(members, heads, postings, rows)
        return labels

    def documents(self) -> DataFrame:
        """(doc_id, n_shingles, component_id, node) for every row of the table."""
        linked = self.sets.join(self.labels(), "node")
        smallest = linked.groupBy("label").agg(F.min("first_id").alias("component_id"))
        found = linked.select("node", "label").join(smallest, "label").select("node", "component_id")
        named = self.sets.join(found, "node", "left").select(
            "node", F.coalesce("component_id", "first_id").alias("component_id")
        )
        return self.keys.select("doc_id", F.col("n").alias("n_shingles"), "node").join(named, "node", "left").select(
            "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
        )


def ngram_components(docs: DataFrame, *, size: int = 5, percent: int = 80, **names: str) -> DataFrame:
    """(doc_id, n_shingles, component_id): documents are linked if 100 * |A ∩ B| >= percent * |A ∪ B|
    for their sets of `size`-word shingles."""
    return NgramJoin(docs, size=size, percent=percent, **names).documents()


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each component, with its own columns. Rows without an id
    stay, as do texts without words."""
    join = NgramJoin(docs.select("doc_id", "text"), size=5, percent=80)
    gone = stored(join.documents().where("doc_id <> component_id").select("doc_id").distinct(), "ngram-gone")
    discard(join.keys, join.sets)
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
