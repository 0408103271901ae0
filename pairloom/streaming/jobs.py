"""Encoding and counting text as it arrives. The row is the unit: nothing is carried between rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pairloom.operators.pretokenize import pretoken_counts
from pairloom.plans.tokenizer import Tokenizer
from pairloom.session import remove_folder


def encode_stream(
    docs: DataFrame, tokenizer: Tokenizer, path: str, text: str = "text", trigger: dict | None = None
) -> StreamingQuery:
    """Append every row of a stream with its `ids` to a Parquet table. Encoding is narrow, so the
    same plan as for a batch table runs on the stream, exactly once and without state."""
    return (
        tokenizer.encode(docs, text)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{path}/_progress")
        .trigger(**(trigger or {"availableNow": True}))
        .start(f"{path}/rows")
    )


def pretoken_counts_stream(
    docs: DataFrame,
    path: str,
    text: str = "text",
    specials: Sequence[str] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Count each micro-batch on its own and store its counts as one partition.

    A batch that is run again overwrites its own partition, so nothing is counted twice, and no
    state grows with the number of different pretokens. `merge_stream_counts` adds the parts up,
    `compact_stream_counts` keeps them few.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        pretoken_counts(batch, text, specials).write.mode("overwrite").parquet(
            f"{path}/parts/batch_id={batch_id}"
        )

    return (
        docs.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{path}/_progress")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def merge_stream_counts(spark: SparkSession, path: str) -> DataFrame:
    """(pretoken, n) over all batches so far: the last compacted table and the batches after it."""
    bases, parts = _whole(spark, path, "base/upto"), _whole(spark, path, "parts/batch_id")
    return _summed(spark, bases, parts, max(bases, default=-1))


def compact_stream_counts(spark: SparkSession, path: str) -> int | None:
    """Add up the finished batches in one table, so that reading does not slow down as they pile up.

    The last batch is left alone, as only it can be run again. The sum goes to a new folder and counts
    once it is whole; a compaction cut off is done again. What an earlier compaction covered is removed,
    so readers that started before this one keep their files. Run one compaction at a time.
    Returns the last batch covered, or None if there is nothing to do.
    """
    bases, parts = _whole(spark, path, "base/upto"), _whole(spark, path, "parts/batch_id")
    before = max(bases, default=-1)
    upto = max((b for b in parts if b != max(parts)), default=-1)
    if upto <= before:
        return None
    covered = {b: p for b, p in parts.items() if b <= upto}
    _summed(spark, bases, covered, before).write.mode("overwrite").parquet(f"{path}/base/upto={upto}")
    for place in [p for b, p in parts.items() if b <= before] + [p for b, p in bases.items() if b < before]:
        remove_folder(spark, place)
    return upto


def _whole(spark: SparkSession, path: str, kind: str) -> dict[int, str]:
    """Number and folder of each table of a kind that was written to its end."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    folders = [status.getPath().getParent() for status in found or ()]
    return {int(folder.getName().split("=")[1]): folder.toString() for folder in folders}


def _summed(spark: SparkSession, bases: dict[int, str], parts: dict[int, str], base: int) -> DataFrame:
    """The counts of table `base`, if there is one, and of the batches after it."""
    paths = [p for n, p in bases.items() if n == base] + [p for n, p in parts.items() if n > base]
    stored = spark.read.schema("pretoken string, n bigint").parquet(*paths) if paths else None
    if stored is None:
        return spark.createDataFrame([], "pretoken string, n bigint")
    return stored.groupBy("pretoken").agg(F.sum("n").alias("n"))
