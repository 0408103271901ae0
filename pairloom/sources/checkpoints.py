"""Training checkpoints: one Parquet directory per table, in a version that a one-row JSON file names.

Words are symbol strings; the merges define their characters, so a checkpoint is complete in itself.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.vocab import SPECIAL_SCHEMA
from pairloom.session import list_folder, remove_folder, replace_file

META_SCHEMA = "merge_count int, vocab_size int, num_merges int"


@dataclass(frozen=True)
class Checkpoint:
    words: DataFrame
    merges: DataFrame
    vocab: DataFrame
    specials: tuple[str, ...]
    merge_count: int
    vocab_size: int


def write_checkpoint(
    path: str,
    words: DataFrame,
    merges: DataFrame,
    vocab: DataFrame,
    specials: Sequence[str],
    merge_count: int,
    vocab_size: int,
) -> None:
    """The tables go into a new version, then one pointer file is replaced in one step; older versions go
    last. So a rewrite that is cut off leaves the checkpoint as it was."""
    spark = words.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    words.write.parquet(f"{path}/{version}/words")
    write_tables(f"{path}/{version}", merges, vocab, specials)
    meta = {"merge_count": merge_count, "vocab_size": vocab_size, "num_merges": merge_count, "version": version}
    replace_file(spark, f"{path}/meta/current.json", json.dumps(meta) + "\n")
    for name in list_folder(spark, path):
        if name.startswith("v-") and name != version:
            remove_folder(spark, f"{path}/{name}")


def write_tables(path: str, merges: DataFrame, vocab: DataFrame, specials: Sequence[str]) -> None:
    """The tokenizer itself: merges, vocabulary and specials. Nothing is lost, unlike in JSON text."""
    merges.coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")
    vocab.coalesce(1).withColumn("token", F.unhex("token_hex")).write.mode("overwrite").parquet(f"{path}/vocab")
    rows = list(enumerate(specials))
    merges.sparkSession.createDataFrame(rows, SPECIAL_SCHEMA).coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/specials")


def read_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, tuple[str, ...]]:
    specials = spark.read.parquet(f"{path}/specials").orderBy("pos").collect()
    return (
        spark.read.parquet(f"{path}/vocab").drop("token"),
        spark.read.parquet(f"{path}/merges"),
        tuple(r["special"] for r in specials),
    )


def read_checkpoint(spark: SparkSession, path: str) -> Checkpoint:
    meta = spark.read.schema(f"{META_SCHEMA}, version string").json(f"{path}/meta").first()
    if meta["version"]:
        path = f"{path}/{meta['version']}"
    vocab, merges, specials = read_tables(spark, path)
    return Checkpoint(
        spark.read.parquet(f"{path}/words"),
        merges,
        vocab,
        specials,
        meta["merge_count"],
        meta["vocab_size"],
    )


def training_history(spark: SparkSession, checkpoint_dir: str) -> DataFrame:
    """(checkpoint, merge_count, vocab_size, num_merges) of all checkpoints in a directory."""
    return (
        spark.read.schema(META_SCHEMA)
        .json(f"{checkpoint_dir}/*/meta")
        .select(
            F.regexp_extract(F.input_file_name(), "([^/]+)/meta/[^/]+$", 1).alias("checkpoint"),
            "merge_count",
            "vocab_size",
            "num_merges",
        )
    )
