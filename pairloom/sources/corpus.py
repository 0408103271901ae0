"""Corpora as tables of text."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.text import DELIMITER, lenient_decode, pretokens

PARTITIONS = "pairloom.read.partitions"
SPLIT_COMPRESSED = ".bz2"
COMPRESSED = (".gz", ".bz2", ".zst", ".zstd", ".lz4", ".snappy", ".deflate", ".xz")


def read_table(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The named columns of a Parquet table, in the splits of its scan.

    Where the setting `pairloom.read.partitions` is given, the rows are dealt out to so many
    partitions first. That shuffles the text, and is meant for one small file on many cores.
    """
    table = spark.read.parquet(path).select(*columns)
    partitions = spark.conf.get(PARTITIONS, None)
    return table.repartition(int(partitions)) if partitions else table


def scan_delimited(spark: SparkSession, path: str, delimiter: str = DELIMITER) -> DataFrame:
    """(path, text): the text between delimiters, lenient about bad UTF-8.

    Files are split by size among tasks; a record belongs to the task in whose range it starts.
    """
    return spark.read.option("lineSep", delimiter).text(path).select(
        F.col("_metadata.file_path").alias("path"),
        lenient_decode(F.col("value").cast("binary")).alias("text"),
    )


def _joined_task(joint: bytes, last: bytes):
    """Records cut at `joint`, the delimiter without its last character, put together again: a cut is a
    delimiter where the next record starts with `last`. Says of each record whether a delimiter ends it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, parts = None, []
        for batch in batches:
            rows = []
            for at, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at != path:
                    if parts and parts != [b""]:
                        rows.append((path, b"".join(parts), False))
                    path, parts = at, [value]
                elif value.startswith(last):
                    rows.append((path, b"".join(parts), True))
                    parts = [value[len(last) :]]
                else:
                    parts += [joint, value]
            yield pa.RecordBatch.from_pylist([dict(zip(FIELDS.names, r)) for r in rows], schema=FIELDS)
        if parts and parts != [b""]:
            yield pa.RecordBatch.from_pylist([dict(zip(FIELDS.names, (path, b"".join(parts), False)))], schema=FIELDS)

    return run


FIELDS = pa.schema([("path", pa.string()), ("value", pa.binary()), ("ended", pa.bool_())])


def _records(spark: SparkSession, path: str, delimiter: str) -> DataFrame:
    """(path, value, bytes, file_size, ended): records as bytes, with what tells how many delimiters their
    file has: its size, or, where it is compressed, whether a delimiter ends each record.

    A scan drops the delimiters, and a last record may or may not have one. Compressed files are not
    split, so a task reads each in order, and cuts it one character before the delimiter's end: what
    that character starts was preceded by a delimiter. A file that ends in a delimiter short of its last
    character reads as if it ended before it.
    """
    files = spark.read.text(path).inputFiles()
    packed = [f for f in files if f.endswith(COMPRESSED)]
    plain = [f for f in files if not f.endswith(COMPRESSED)]
    tables = []
    if plain or not packed:
        value = F.col("value").cast("binary")
        tables.append(
            spark.read.option("lineSep", delimiter).text(plain or path).select(
                F.col("_metadata.file_path").alias("path"),
                value.alias("value"),
                F.octet_length(value).cast("bigint").alias("bytes"),
                F.col("_metadata.file_size").alias("file_size"),
                F.lit(None).cast("boolean").alias("ended"),
            )
        )
    if packed:
        joint, last = delimiter[:-1], delimiter[-1]
        if split := [f for f in packed if f.endswith(SPLIT_COMPRESSED)]:
            raise ValueError(f"delimiters of compressed files that Spark splits cannot be counted: {split[0]}")
        if not joint or any(joint.startswith(joint[i:]) for i in range(1, len(joint))):
            raise ValueError(f"delimiters {delimiter!r} of compressed files cannot be counted")
        cut = spark.read.option("lineSep", joint).text(packed).select(
            F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("value")
        )
        whole = cut.mapInArrow(_joined_task(joint.encode("utf-8"), last.encode("utf-8")), "path string, value binary, ended boolean")
        none = F.lit(None).cast("bigint")
        tables.append(whole.select("path", "value", none.alias("bytes"), none.alias("file_size"), "ended"))
    return reduce(DataFrame.unionByName, tables)


def _n_delimiters(delimiter: str) -> Column:
    """Of a file, from sums over its records."""
    by_size = (F.max("file_size") - F.sum("bytes")) / len(delimiter.encode("utf-8"))
    return F.coalesce(F.count_if("ended") + F.sum(F.when(F.col("ended").isNotNull(), 0)), by_size.cast("bigint"))


def delimiter_counts(spark: SparkSession, path: str, delimiter: str = DELIMITER) -> DataFrame:
    """(path, n_records, n_delimiters) for each file."""
    return _records(spark, path, delimiter).groupBy("path").agg(
        F.count(F.lit(1)).alias("n_records"), _n_delimiters(delimiter).alias("n_delimiters")
    )


def corpus_pretoken_counts(
    spark: SparkSession, path: str, specials: list[str], delimiter: str = DELIMITER
) -> DataFrame:
    """(pretoken, n) of a delimited corpus; delimiters count as the special they are.

    One scan: each record gives its pretokens and one null, which carries its size to the sums of its
    file.
    """
    if delimiter not in specials:
        raise ValueError("the delimiter of a corpus must be one of its special tokens")
    found = _records(spark, path, delimiter).select(
        F.explode(F.array_append(pretokens(lenient_decode(F.col("value")), specials), F.lit(None))).alias("pretoken"),
        "path", "bytes", "file_size", "ended",
    )
    is_end = F.col("pretoken").isNull()
    counts = (
        found.groupBy("pretoken", F.when(is_end, F.col("path")).alias("path"))
        .agg(F.count(F.lit(1)).alias("n"), _n_delimiters(delimiter).alias("n_delimiters"))
        .select(
            F.coalesce("pretoken", F.lit(delimiter)).alias("pretoken"), F.when(is_end, F.col("n_delimiters")).otherwise(F.col("n")).alias("n")
        )
    )
    return counts.groupBy("pretoken").agg(F.sum("n").alias("n")).where("n > 0")


def decode_files(binary: DataFrame, content: str = "content", to: str = "text") -> DataFrame:
    """A table of raw bytes (such as `binaryFile` gives) with its bytes read leniently as text."""
    return binary.withColumn(to, lenient_decode(F.col(content))).drop(content)
