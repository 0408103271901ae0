"""Exact deduplication by stateful streaming, with DataFrame operations only.

A small row for each document (digest, rank, locator of its content) is stored and streamed into an
aggregation whose state lies on disk (RocksDB) under the checkpoint folder and never expires. For each
digest it retains the best document so far, with the locator of its content, and the number of
documents. Later runs with the same folder go on from that state. The state is read back as a table.

Where a digest was hit more than once, the full bytes of all documents of the table that hit it are
compared; documents of one digest with different bytes are grouped by their bytes instead. Documents of
earlier runs are known by digest and locator; their content is not read again.

Nulls: a null text counts as empty; a null doc_id ranks after any other. Repeated rows are documents
of their own, told apart by their place in the table; one of them stays. Very long texts are compared
whole. Other columns may have any name. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import stored
from pairloom.session import work_dir

# The characters that do not count for equality.
WHITE_SPACE = " \t\n\x0b\x0c\r"
# State on disk; without reserving file space ahead, which is megabytes for every partition, with one
# bound on memory for all stores of an executor, and with a short time until those of a finished run
# are closed.
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
}
# Hits are looked up by a broadcast up to this many (about 100 bytes each), by a shuffle beyond.
BROADCAST_HITS = 200_000
BEST = ["n_points", "rev_id", "file", "row"]


def normalized(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


@contextmanager
def _disk_state(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in DISK_STATE}
    for key, value in DISK_STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def with_locator(docs: DataFrame) -> DataFrame:
    """Two columns added at the end: the file and the row where each row is stored, under names that the
    table does not have. A table that is not read from files is stored first."""
    taken, names = {c.lower() for c in docs.columns}, []
    for name in ("content_file", "content_row"):
        while name in taken:
            name = "_" + name
        names.append(name)
    for table in (lambda: docs, lambda: stored(docs, "content")):
        try:
            df = table()
            place = df.metadataColumn("_metadata")
            return df.select("*", place.getField("file_path").alias(names[0]), place.getField("row_index").alias(names[1]))
        except AnalysisException:
            continue
    raise ValueError("the stored table has no file metadata")


def stream_state(spark: SparkSession, keyed_path: str, schema, state_dir: str) -> DataFrame:
    """(digest, n_points, rev_id, file, row, group_size): run the stream over the rows stored in
    `keyed_path` that it has not seen, then read its state."""
    rows = spark.readStream.schema(schema).parquet(keyed_path)
    held = rows.groupBy("digest").agg(
        F.max(F.struct(*BEST)).alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    with _disk_state(spark):
        held.writeStream.format("noop").outputMode("update").option("checkpointLocation", state_dir).trigger(
            availableNow=True
        ).start().awaitTermination()
        state = spark.read.format("statestore").load(state_dir)
        value = state.schema["value"].dataType.names
        best, size = (f"value.`{name}`" for name in value)
        return stored(
            state.select("key.digest", *[f"{best}.{c}" for c in BEST], F.col(size).alias("group_size")), "state"
        )


def exact_dedup(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
    state_dir: str | None = None,
    placed: bool = False,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest, and the place (file, row) of
    its content. The document with the most code points stays, then the smallest id. `placed` says
    that `docs` comes from `with_locator`."""
    spark = docs.sparkSession
    content_of = docs if placed else with_locator(docs)
    file, row = content_of.columns[-2:]
    norm = normalized(F.col(f"`{text}`"))
    folder = work_dir(spark, "dedup")
    keyed = content_of.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        digest(norm).alias("digest"),
        F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("bigint").alias("n_points"),
        F.bitwise_not(F.col(f"`{doc_id}`")).alias("rev_id"),
        F.col(file).alias("file"),
        F.col(row).alias("row"),
    )
    keyed.write.parquet(f"{folder}/keyed")
    rows = spark.read.schema(keyed.schema).parquet(f"{folder}/keyed")
    state = stream_state(spark, f"{folder}/keyed", keyed.schema, state_dir or f"{folder}/state")

    groups = state.select(
        "digest", F.struct(*BEST).alias("best"), "group_size", F.lit(None).cast("string").alias("bytes")
    )
    hits = rows.join(state.where("group_size > 1").select("digest"), "digest", "left_semi").select(
        "digest", "file", "row", *BEST[:2]
    )
    n_hits = state.where("group_size > 1").agg(F.sum("group_size")).first()[0] or 0
    if n_hits <= BROADCAST_HITS:
        hits = F.broadcast(hits)
    content = content_of.select(F.col(file).alias("file"), F.col(row).alias("row"), norm.alias("bytes")).join(hits, ["file", "row"])
    uneven = stored(
        content.groupBy("digest").agg(F.min("bytes").alias("a"), F.max("bytes").alias("b")).where("a <> b").select("digest"),
        "uneven",
    )
    if uneven.isEmpty():
        decided = rows.join(groups.drop("bytes"), "digest")
    else:
        split = content.join(uneven, "digest").select(
            "digest", "bytes", F.struct(*BEST).alias("me")
        )
        exact = split.groupBy("digest", "bytes").agg(
            F.max("me").alias("best"), F.count(F.lit(1)).alias("group_size")
        )
        places = split.join(exact, ["digest", "bytes"]).select(
            F.col("me.file").alias("file"), F.col("me.row").alias("row"), "best", "group_size"
        )
        decided = rows.join(groups.drop("bytes").join(uneven, "digest", "left_anti"), "digest").unionByName(
            rows.join(places, ["file", "row"])
        )
    return decided.select(
        "doc_id",
        F.bitwise_not("best.rev_id").alias("keep_id"),
        "group_size",
        ((F.col("file") == F.col("best.file")) & (F.col("row") == F.col("best.row"))).alias("kept"),
        "digest",
        "file",
        "row",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns. Each is looked up by its place."""
    placed = with_locator(docs)
    file, row = placed.columns[-2:]
    keep = exact_dedup(placed, placed=True).where("kept").select(F.col("file").alias(file), F.col("row").alias(row))
    return placed.join(keep, [file, row], "left_semi").drop(file, row)
