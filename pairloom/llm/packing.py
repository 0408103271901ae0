"""Best-fit packing of documents into sequences, by patterns and non-negative least squares.

Documents are tokenized once; the token ids are stored, and all that follows works on lengths. A
document longer than a sequence is cut: full pieces fill sequences of their own, and what is over (the
first piece) is packed. Patterns are the ways to fill a sequence exactly with one to three pieces. How
often each is used is fitted to the histogram of lengths by non-negative least squares, rounded down to
what the histogram holds, and the lengths left over are packed best fit, longest first. All of
that sees the histogram only, whose size is the sequence length, whatever the input.

The pieces of one length are numbered without gaps (in buckets, whose starts come from counts), and the
plan says which sequence and place the k-th piece of each length goes to. Pieces of one length are
alike for packing, so a hot length is split like any other.

Nulls: a null or empty text is the end token alone; a null doc_id is kept. Repeated rows are packed
each. Empty tables give no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import by_bytes, stored, text_bytes
from pairloom.sources.tokenizer_files import byte_characters

LENGTH = 1024
END = 2
STEPS = 400
BUCKET_ROWS = 1 << 16

# Fixed value: the pattern that splits text before the merges of this tokenizer file.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Fixed value: the characters that are \s in that pattern. Its engine keeps a state for each of them in
# a run and gives up on about a million, so long runs are cut out before.
LONG_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


# -- token ids


def read_ranks(tokenizer_path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """(ids by token, ids of special tokens) of a byte-level BPE tokenizer file. Its merges must be in
    the order of their ids: then merging by lowest id gives what the file's own library gives."""
    with open(tokenizer_path, encoding="utf-8") as f:
        parsed = json.load(f)
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    as_bytes = lambda token: bytes(byte_of[c] for c in token)
    specials = {t["content"]: t["id"] for t in parsed.get("added_tokens", ())}
    ranks = {as_bytes(t): i for t, i in parsed["model"]["vocab"].items() if t not in specials}
    merges = parsed["model"]["merges"]
    merged = [ranks[as_bytes("".join(m.split(" ") if isinstance(m, str) else m))] for m in merges]
    if merged != sorted(merged):
        raise ValueError("the merges are not in the order of their ids")
    return ranks, specials


class TextIds:
    """Texts to their ids as little-endian 32-bit bytes."""

    def __init__(self, ranks: dict[bytes, int], specials: dict[str, int]):
        self.encoding = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=specials)
        self.specials = set(specials)
        self.special = re.compile("|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True)) or r"(?!)")

    def _with_long_spaces(self, text: str) -> list[int]:
        """A run of spaces is one pretoken, but for its last character where the text goes on."""
        ids, at = [], 0
        for special in [*self.special.finditer(text), None]:
            end = special.start() if special else len(text)
            for run in LONG_SPACES.finditer(text, at, end):
                cut = run.end() if run.end() == end else run.end() - 1
                ids += self.encoding.encode_ordinary(text[at : run.start()])
                ids += self.encoding._encode_single_piece(text[run.start() : cut])
                at = cut
            ids += self.encoding.encode_ordinary(text[at:end])
            if special:
                ids.append(self.encoding.encode_single_token(special[0]))
                at = special.end()
        return ids

    def of(self, text: str) -> bytes:
        if LONG_SPACES.search(text):
            ids = self._with_long_spaces(text)
        elif any(s in text for s in self.specials):
            ids = self.encoding.encode(text, allowed_special=self.specials, disallowed_special=())
        else:
            ids = self.encoding.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


def _tokens_task(vocabulary, length: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, specials = vocabulary.value
        ids_of = TextIds(ranks, specials)
        last = np.array([end], "<u4").tobytes()
        for part in by_bytes(batches, 2):
            ids = [ids_of.of(t.decode("utf-8")) + last for t in text_bytes(part.column(2))]
            crcs = []
            for data in ids:
                first = (len(data) // 4 - 1) % length + 1
                cuts = [0, *range(first * 4, len(data) + 1, length * 4)]
                crcs.append([zlib.crc32(data[a:b]) for a, b in zip(cuts, cuts[1:])])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array([len(d) // 4 for d in ids], pa.int64()),
                    pa.array(crcs, pa.list_(pa.int64())),
                    pa.array(ids, pa.binary()),
                ],
                names=["uid", "doc_id", "n_ids", "crcs", "ids"],
            )

    return run


def tokenized(docs: DataFrame, tokenizer_path: str, *, length: int = LENGTH, end: int = END) -> DataFrame:
    """(uid, doc_id, n_ids, crcs, ids), stored: ids are little-endian unsigned 32-bit numbers, crcs
    those of the document's pieces. The tokenizer file is read on the driver and its vocabulary sent to the tasks."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_ranks(tokenizer_path))
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    schema = "uid bigint, doc_id bigint, n_ids bigint, crcs array<bigint>, ids binary"
    return stored(rows.mapInArrow(_tokens_task(vocabulary, length, end), schema), "packing-ids", compression="zstd")


# -- the plan, from the histogram alone


def patterns(lengths: np.ndarray, full: int) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c >= 0, of lengths that occur and fill a sequence exactly."""
    have = np.zeros(full + 1, bool)
    have[lengths] = True
    have[0] = True
    found = []
    for a in lengths:
        rest = full - a
        b = np.arange((rest + 1) // 2, min(a, rest) + 1)
        c = rest - b
        fits = have[b] & have[c]
        found.append(np.column_stack((np.full(fits.sum(), a), b[fits], c[fits])))
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def non_negative_least_squares(rows: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeats x >= 0 of the patterns minimising |A x - counts|^2, where A has the number of times
    each length is in each pattern; accelerated projected gradients."""
    used = rows > 0
    scale = np.sqrt(np.bincount(rows[used], minlength=len(counts)))  # rows of A weighted by their fill
    weight = np.zeros(len(counts))
    weight[scale > 0] = 1 / scale[scale > 0]
    target = counts * weight

    def forward(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(rows[:, k], np.where(used[:, k], x, 0), len(counts)) for k in range(3)) * weight

    def back(y: np.ndarray) -> np.ndarray:
        y = y * weight
        return sum(np.where(used[:, k], y[rows[:, k]], 0) for k in range(3))

    probe = np.ones(len(rows))
    for _ in range(20):
        probe = back(forward(probe / np.linalg.norm(probe)))
    rate = 1 / np.linalg.norm(probe) if np.linalg.norm(probe) else 1.0
    x = ahead = np.zeros(len(rows))
    speed = 1.0
    for _ in range(steps):
        new = np.maximum(ahead - rate * back(forward(ahead) - target), 0)
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        ahead = new + (speed - 1) / faster * (new - x)
        x, speed = new, faster
    return x


def best_fit(left: np.ndarray, full: int) -> dict[tuple[int, ...], int]:
    """Pack what is left, longest first, each into the fullest open sequence it fits in; equal
    pieces and equal sequences move together."""
    room: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    for size in range(full, 0, -1):
        todo = int(left[size])
        for space in range(size, full):
            if not todo:
                break
            for pattern in list(room[space]):
                n = min(todo, room[space][pattern])
                if not n:
                    break
                room[space][pattern] -= n
                if not room[space][pattern]:
                    del room[space][pattern]
                room[space - size][(*pattern, size)] += n
                todo -= n
        # new sequences take as many of these pieces as fit
        each = full // size
        if todo >= each:
            room[full - each * size][(size,) * each] += todo // each
        if todo % each:
            room[full - (todo % each) * size][(size,) * (todo % each)] += 1
    return {p: n for group in room.values() for p, n in group.items() if n}


def plan(counts: np.ndarray, full: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that use up the histogram `counts` (by length, 1 to full - 1) exactly."""
    left = counts.astype(np.int64).copy()
    chosen: dict[tuple[int, ...], int] = defaultdict(int)
    rows = patterns(np.flatnonzero(left), full)
    if len(rows):
        repeats = non_negative_least_squares(rows, left.astype(float))
        for k in np.argsort(-repeats, kind="stable"):
            n = int(repeats[k] + 0.5)
            if not n:
                break
            parts, times = np.unique(rows[k][rows[k] > 0], return_counts=True)
            n = min(n, int((left[parts] // times).min()))
            if n > 0:
                left[parts] -= times * n
                chosen[tuple(int(p) for p in rows[k] if p)] += n
    for pattern, n in best_fit(left, full).items():
        chosen[pattern] += n
    return sorted(chosen.items())


def places(chosen: list[tuple[tuple[int, ...], int]], full: int) -> tuple[np.ndarray, ...]:
    """For a lookup by (length, number within length): keys in order, and there the first number, the
    first sequence and the offset."""
    used = np.zeros(full + 1, np.int64)
    rows, base = [], 0
    for pattern, n in chosen:
        offset = 0
        for size in pattern:
            rows.append((size, used[size], base, offset))
            used[size] += n
            offset += size
        base += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return table[:, 0] * (1 << 44) + table[:, 1], table[:, 1], table[:, 2], table[:, 3]


def _lookup(table):
    @F.arrow_udf("struct<sequence_id bigint, offset bigint>")
    def found(sizes: pa.Array, numbers: pa.Array) -> pa.Array:
        keys, first, base, offset = table.value
        number = numbers.to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.searchsorted(keys, sizes.to_numpy(zero_copy_only=False).astype(np.int64) * (1 << 44) + number, "right") - 1
        return pa.StructArray.from_arrays(
            [pa.array(base[at] + number - first[at]), pa.array(offset[at])], names=["sequence_id", "offset"]
        )

    return found


# -- the job


def pack(tokens: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """(uid, doc_id, piece, start, length, ids_crc32, sequence_id, offset) for the rows of `tokenized`.

    Sequences of packed pieces are numbered from 0, those of full pieces from -1 down."""
    spark = tokens.sparkSession
    total = tokens.count()
    buckets = max(16, -(-total // BUCKET_ROWS))
    rows = tokens.select(
        "uid",
        "doc_id",
        "n_ids",
        "crcs",
        (F.col("n_ids") % length).cast("int").alias("rest"),
        F.floor(F.col("n_ids") / length).cast("bigint").alias("full"),
        F.pmod(F.xxhash64("uid"), F.lit(buckets)).cast("int").alias("bucket"),
    )
    per_bucket = stored(rows.groupBy("bucket", "rest").agg(F.count(F.lit(1)).alias("n"), F.sum("full").alias("full")), "packing-counts")
    counts = np.zeros(length + 1, np.int64)
    for r in per_bucket.groupBy("rest").agg(F.sum("n").alias("n")).collect():  # one row for each length
        counts[r["rest"]] = r["n"]
    counts[0] = 0
    table = spark.sparkContext.broadcast(places(plan(counts, length), length))

    before = lambda *by: Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select(
        "bucket", "rest", F.coalesce(F.sum("n").over(before("rest")), F.lit(0)).alias("first")
    )
    full_starts = (
        per_bucket.groupBy("bucket")
        .agg(F.sum("full").alias("full"))
        .select("bucket", F.coalesce(F.sum("full").over(before(F.lit(0))), F.lit(0)).alias("full_first"))
    )
    numbered = (
        rows.select(
            "*",
            (F.row_number().over(Window.partitionBy("bucket", "rest").orderBy("uid")) - 1).alias("nth"),
            (
                F.sum("full").over(Window.partitionBy("bucket").orderBy("uid").rowsBetween(Window.unboundedPreceding, 0))
                - F.col("full")
            ).alias("full_nth"),
        )
        .join(starts, ["bucket", "rest"])
        .join(full_starts, "bucket")
        .select(
            "uid",
            "doc_id",
            "rest",
            "crcs",
            (F.col("full_first") + F.col("full_nth")).alias("full_at"),
            _lookup(table)("rest", F.col("first") + F.col("nth")).alias("at"),
        )
    )
    pieces = numbered.select("*", F.posexplode("crcs").alias("piece", "ids_crc32"))
    packed = (F.col("piece") == 0) & (F.col("rest") > 0)
    cut = F.when(F.col("rest") > 0, F.col("piece") - 1).otherwise(F.col("piece"))  # which full piece
    return pieces.select(
        "uid",
        "doc_id",
        "piece",
        F.when(packed, 0).otherwise(F.col("rest") + cut * length).cast("bigint").alias("start"),
        F.when(packed, F.col("rest")).otherwise(length).cast("bigint").alias("length"),
        "ids_crc32",
        F.when(packed, F.col("at.sequence_id")).otherwise(-1 - F.col("full_at") - cut).cast("bigint").alias("sequence_id"),
        F.when(packed, F.col("at.offset")).otherwise(0).cast("bigint").alias("offset"),
    )


def sequences(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """(sequence_id, ids ARRAY<BIGINT as bytes>): the token bytes of each sequence, in order. A sequence
    is bounded by its length, and so is each group here."""
    cut = F.col("ids").substr(F.col("start").cast("int") * 4 + 1, F.col("length").cast("int") * 4)
    parts = pieces.join(tokens.select("uid", "ids"), "uid").select("sequence_id", F.struct("offset", cut.alias("ids")).alias("part"))
    joined = F.aggregate(F.sort_array(F.collect_list("part")), F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return parts.groupBy("sequence_id").agg(joined.alias("ids"))


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    return pack(tokenized(docs, tokenizer_path))
