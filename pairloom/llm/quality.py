"""Quality by perplexity under an interpolated modified Kneser-Ney model.

One model for each language is trained on four fifths of the trusted text. Its tokens are characters
(code points) of whatever script, in runs of `ORDER`, kept as strings, so what is gathered grows with the
text and no alphabet is fixed. Counts, continuation counts and discounts are tables sharded by
language and run. Below single characters lies an unknown class: the weight that the discounts of the
trusted text's characters leave is spread evenly over them and one more.

Scoring asks those shards. The documents are in blocks; the different runs of all blocks, each with the
blocks that ask for it, are joined with the counts of all orders, interpolated from the lowest order up,
and the probabilities go back to the blocks, where their documents are scored whole. A document is kept if its perplexity is at most the
`KEEP` quantile of the trusted documents of its language that the model has not seen (of all of them
where a language has none).

A block is up to `BLOCK_BYTES` of neighbouring rows of a stored table, a longer text alone; both passes
see the same blocks, and a run without a probability fails the job.

Nulls: a null or empty text has perplexity 1 and is kept, as has any text in a language without trusted
text; a null language is one of its own; a null doc_id is never trusted. Repeated labels: trusted if
one says so. Without unseen trusted documents everything is kept. U+0000 counts as U+FFFD. Very long
texts are read whole, in slices. Other columns are not looked at. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import by_bytes, discard, mixed, reclaim, stored, text_bytes

ORDER = 5
KEEP = 0.99
FOLDS = 5  # one of them sets the threshold, the others train
BLOCK_BYTES = 32 << 20
CHUNK_BYTES = 4 << 20
BROADCAST_LABELS = 2_000_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _hashes(windows: np.ndarray) -> np.ndarray:
    """One number for each row of ORDER code points."""
    total = np.zeros(len(windows), np.uint64)
    for k in range(ORDER):
        total = total * FACTOR + windows[:, k]
    return mixed(total)


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(the run of ORDER code points that ends at each one of all texts, how many each text has); before
    a text stand line ends."""
    pad = "\n" * (ORDER - 1)
    words = [t.decode("utf-8", "replace").replace("\0", "\ufffd") for t in texts]
    lengths = np.array([len(t) for t in words], np.int64)
    codes = np.frombuffer("".join([pad + t for t in words]).encode("utf-32-le"), np.uint32)
    if len(codes) < ORDER:
        return np.empty((0, ORDER), np.uint32), lengths
    runs = np.lib.stride_tricks.sliding_window_view(codes, ORDER)
    # runs that reach from one text into the padding of the next are not asked for
    real = np.ones(len(runs), bool)
    for start in (np.cumsum(lengths + ORDER - 1)[:-1] - (ORDER - 1)).tolist():
        real[max(start, 0) : start + ORDER - 1] = False
    return runs[real], lengths


def _strings(runs: np.ndarray) -> pa.Array:
    """Rows of ORDER code points as texts."""
    data = np.ascontiguousarray(runs, np.uint32)
    sizes = 1 + sum((data >= least).sum(axis=1, dtype=np.int32) for least in (0x80, 0x800, 0x10000)) + np.int32(ORDER - 1)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    text = data.tobytes().decode("utf-32-le").encode("utf-8")
    return pa.StringArray.from_buffers(len(data), pa.py_buffer(offsets), pa.py_buffer(text))


def _by_language(part: pa.RecordBatch, lang: int, text: int) -> Iterator[tuple[str | None, np.ndarray, np.ndarray, np.ndarray]]:
    """(language, hash, code points and number of its different runs) of a batch."""
    langs, texts = part.column(lang).to_pylist(), text_bytes(part.column(text))
    for name in dict.fromkeys(langs):
        runs, _ = _windows([t for t, x in zip(texts, langs) if x == name])
        keys, first, n = np.unique(_hashes(runs), return_index=True, return_counts=True)
        if len(keys):
            yield name, keys, runs[first], n


def _counts_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, run, n), counted by chunk."""
    for part in by_bytes(batches, 1, CHUNK_BYTES):
        for lang, _, runs, n in _by_language(part, 0, 1):
            columns = [pa.array([lang] * len(n), pa.string()), _strings(runs), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "run", "n"])


def _blocks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(block, rows): neighbouring rows of a task, cut by the bytes of their texts."""
    held, block = 0, TaskContext.get().partitionId() << 32
    for part in by_bytes(batches, text, CHUNK_BYTES):
        start = 0
        for i, size in enumerate(map(len, text_bytes(part.column(text)))):
            if held and held + size > BLOCK_BYTES:
                if i > start:
                    yield block, part.slice(start, i - start)
                start, held, block = i, 0, block + 1
            held += size
        yield block, part.slice(start)


def _asked_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, lang, run): the different runs of each block."""
    current, seen = None, {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, (_, runs) in seen.items():
            columns = [
                pa.array(np.full(len(runs), current, np.int64)),
                pa.array([lang] * len(runs), pa.string()),
                _strings(runs),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "lang", "run"])

    for block, part in _blocks(batches, 1):
        if block != current:
            yield from out()
            current, seen = block, {}
        for lang, keys, runs, _ in _by_language(part, 0, 1):
            if lang in seen:
                keys, first = np.unique(np.concatenate([seen[lang][0], keys]), return_index=True)
                runs = np.concatenate([seen[lang][1], runs])[first]
            seen[lang] = keys, runs
    yield from out()


def _blocked_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, lang, doc_ids, sizes, packed): the rows (lang, text, doc_id) of a chunk, their texts joined
    and compressed for the way."""
    packer = pa.Codec("zstd", compression_level=3)
    for block, part in _blocks(batches, 1):
        langs, texts = part.column(0).to_pylist(), text_bytes(part.column(1))
        for lang in dict.fromkeys(langs):
            at = [i for i, x in enumerate(langs) if x == lang]
            data = b"".join([texts[i] for i in at])
            columns = [
                pa.array([block], pa.int64()),
                pa.array([lang], pa.string()),
                pa.array([part.column(2).take(pa.array(at)).to_pylist()], pa.list_(pa.int64())),
                pa.array([[len(texts[i]) for i in at]], pa.list_(pa.int64())),
                pa.array([packer.compress(data, asbytes=True) if data else b""], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "lang", "doc_ids", "sizes", "packed"])


def _score_group(docs, answers):
    """Perplexity of each document of one block and language."""
    packer = pa.Codec("zstd")
    runs = "".join(["".join(chunk.to_pylist()) for chunk in answers.column("run").chunks])
    known = _hashes(np.frombuffer(runs.encode("utf-32-le"), np.uint32).reshape(-1, ORDER))
    order = np.argsort(known)
    known, log_p = known[order], answers.column("log_p").to_numpy()[order]
    n_tokens, perplexity = [], []
    for sizes, packed in zip(docs.column("sizes").to_pylist(), docs.column("packed").to_pylist()):
        data = packer.decompress(packed, sum(sizes), asbytes=True) if packed else b""
        ends = np.cumsum(sizes).tolist()
        asked, lengths = _windows([data[end - size : end] for size, end in zip(sizes, ends)])
        asked = _hashes(asked)
        at = np.minimum(np.searchsorted(known, asked), max(len(known) - 1, 0))
        if len(asked) and (len(known) == 0 or (known[at] != asked).any()):
            raise RuntimeError("a run of this block was not asked for")
        sums = np.concatenate(([0.0], np.cumsum(log_p[at], dtype=np.float64)))
        ends = np.cumsum(lengths)
        n_tokens.extend(lengths.tolist())
        perplexity.extend(np.exp((sums[ends - lengths] - sums[ends]) / np.maximum(lengths, 1)).tolist())
    ids = [i for chunk in docs.column("doc_ids").to_pylist() for i in chunk]
    return pa.table(
        {
            "doc_id": pa.array(ids, pa.int64()),
            "lang": pa.array(docs.column("lang").to_pylist()[:1] * len(ids), pa.string()),
            "n_tokens": pa.array(n_tokens, pa.int64()),
            "perplexity": pa.array(perplexity, pa.float64()),
        }
    )


def _suffix() -> Column:
    """A run without its first character."""
    return F.expr("substring(run, 2)")


def _context() -> Column:
    """A run without its last character."""
    return F.expr("substring(run, 1, length(run) - 1)")


class KneserNey:
    """Tables of all orders. `discounted[k]` is (lang, run, mass), `contexts[k]` (lang, context, total, held,
    different), where held is the weight left to the next lower order; discounts are three numbers for
    each language and order, from the counts of counts."""

    def __init__(self, trusted: DataFrame):
        raw = trusted.select("lang", "text").mapInArrow(_counts_task, "lang string, run string, n bigint")
        top = raw.groupBy("lang", "run").agg(F.sum("n").alias("n"))
        self.discounted, self.contexts, self.tables = {}, {}, []
        for order in range(ORDER, 0, -1):
            top = stored(top, f"runs-{order}")
            self.tables.append(top)
            self._order(order, top)
            # lower orders count in how many ways a run is continued to the left
            top = top.groupBy("lang", _suffix().alias("run")).agg(F.count(F.lit(1)).alias("n"))

    def _order(self, order: int, counts: DataFrame) -> None:
        number = [F.count_if(F.col("n") == k).alias(f"c{k}") for k in (1, 2, 3, 4)]
        of_counts = counts.groupBy("lang").agg(*number)  # one row for each language
        y = F.try_divide(F.col("c1"), F.col("c1") + 2 * F.col("c2"))

        def discount(k: int) -> Column:
            """Between 0 and k; a half where the counts of counts say nothing."""
            exact = k - (k + 1) * y * F.try_divide(F.col(f"c{k + 1}"), F.col(f"c{k}"))
            bounded = F.greatest(F.lit(0.0), F.least(F.lit(float(k)), exact))
            return F.when(exact.isNull(), 0.5).otherwise(bounded).alias(f"d{k}")

        discounts = of_counts.select(F.col("lang").alias("l"), *[discount(k) for k in (1, 2, 3)])
        less = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        table = counts.join(discounts, F.col("lang").eqNullSafe(F.col("l"))).select(
            "lang", "run", "n", F.least(less, F.col("n").cast("double")).alias("less")
        )
        self.discounted[order] = table.select("lang", "run", (F.col("n") - F.col("less")).alias("mass"))
        self.contexts[order] = stored(
            table.groupBy("lang", _context().alias("context")).agg(
                F.sum("n").alias("total"), F.sum("less").alias("held"), F.count(F.lit(1)).alias("different")
            ),
            f"contexts-{order}",
        )
        self.tables.append(self.contexts[order])

    def log_probabilities(self, asked: DataFrame) -> DataFrame:
        """(lang, run, log_p) for (lang, run): sharded joins with the counts, lowest order first."""
        wanted = {ORDER: asked}
        for order in range(ORDER, 1, -1):
            wanted[order - 1] = wanted[order].select("lang", _suffix().alias("run")).distinct()
        lower = None
        for order in range(1, ORDER + 1):
            rows = wanted[order]
            if lower is None:
                rows = rows.withColumn("below", F.lit(None).cast("double"))
            else:
                low = lower.select(F.col("lang").alias("l"), F.col("run").alias("s"), F.col("p").alias("below"))
                rows = rows.withColumn("s", _suffix())
                rows = rows.join(low, rows["lang"].eqNullSafe(low["l"]) & (rows["s"] == low["s"])).select("lang", "run", "below")
            seen = self.discounted[order].select(F.col("lang").alias("l"), F.col("run").alias("r"), "mass")
            rows = rows.join(seen, rows["lang"].eqNullSafe(seen["l"]) & (rows["run"] == seen["r"]), "left").drop("l", "r")
            rows = rows.withColumn("c", _context())
            context = self.contexts[order].select(F.col("lang").alias("l"), F.col("context").alias("k"), "total", "held", "different")
            rows = rows.join(context, rows["lang"].eqNullSafe(context["l"]) & (rows["c"] == context["k"]), "left")
            # below single characters: each of them, and the unknown one, alike; all alike without trusted text
            below = F.coalesce("below", 1 / (F.col("different") + 1), F.lit(1.0))
            p = F.when(F.col("total").isNull(), below).otherwise(
                (F.coalesce("mass", F.lit(0.0)) + F.col("held") * below) / F.col("total")
            )
            lower = rows.select("lang", "run", p.alias("p"))
        return lower.select("lang", "run", F.log(F.greatest("p", F.lit(1e-12))).cast("float").alias("log_p"))


def quality(docs: DataFrame, labels: DataFrame, *, keep: float = KEEP) -> DataFrame:
    """(doc_id, lang, trusted, n_tokens, perplexity, threshold, kept) of every document."""
    rows = docs.select(
        F.col("lang").cast("string").alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
    )
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    if labels.count() <= BROADCAST_LABELS:  # 16 bytes each; beyond that, the text moves to its label
        good = F.broadcast(good)
    unseen = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(FOLDS)) == 0
    model = KneserNey(rows.where(~unseen).join(good, "doc_id", "left_semi"))
    reclaim(docs.sparkSession)
    asked = rows.select("lang", "text").mapInArrow(_asked_task, "block bigint, lang string, run string")
    asked = asked.repartition("lang", "run")  # a task has nearly all of its runs once: nothing to combine before
    asked = stored(asked.groupBy("lang", "run").agg(F.collect_list("block").alias("blocks")), "asked-runs")
    reclaim(docs.sparkSession)
    known = stored(model.log_probabilities(asked.select("lang", "run")), "log-probabilities")
    discard(*model.tables)  # with the shuffle files of all that made them
    k = known.select(F.col("lang").alias("l"), F.col("run").alias("r"), "log_p")
    answers = stored(
        asked.join(k, asked["lang"].eqNullSafe(k["l"]) & (asked["run"] == k["r"])).select("lang", "run", "log_p", "blocks"),
        "answers",
    )
    discard(asked, known)
    asked_by = answers.select(F.explode("blocks").alias("block"), "lang", "run", "log_p")
    packed = rows.mapInArrow(
        _blocked_task, "block bigint, lang string, doc_ids array<bigint>, sizes array<bigint>, packed binary"
    )
    schema = "doc_id bigint, lang string, n_tokens bigint, perplexity double"
    found = packed.groupBy("block", "lang").cogroup(asked_by.groupBy("block", "lang")).applyInArrow(_score_group, schema)
    scored = stored(
        found.join(good.withColumn("is_good", F.lit(True)), "doc_id", "left").select(
            "doc_id", "lang", F.coalesce("is_good", F.lit(False)).alias("trusted"), "n_tokens", "perplexity"
        ),
        "perplexities",
    )
    discard(answers)
    quantile = F.percentile_approx("perplexity", F.lit(keep), F.lit(10000)).alias("threshold")
    held_out = scored.where(F.col("trusted") & unseen)
    by_language = held_out.groupBy(F.col("lang").alias("l")).agg(quantile)
    overall = held_out.agg(quantile).first()["threshold"]
    return (
        scored.join(F.broadcast(by_language), F.col("lang").eqNullSafe(F.col("l")), "left")
        .withColumn("threshold", F.coalesce("threshold", F.lit(overall).cast("double"), F.lit(float("inf"))))
        .select(*scored.columns, "threshold", (F.col("perplexity") <= F.col("threshold")).alias("kept"))
    )
