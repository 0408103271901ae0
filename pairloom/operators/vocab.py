"""Vocabulary tables: (token_id INT, token_hex STRING, ins_order INT).

`ins_order` is the order in which entries were put in; it decides which id wins when two entries
hold the same bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.functions.text import clean_specials, hex_to_text

SPECIAL_SCHEMA = "pos int, special string"


def special_table(spark: SparkSession, specials: Sequence[str]) -> DataFrame:
    """(pos, special, token_hex) in list order."""
    rows = list(enumerate(clean_specials(specials)))
    return spark.createDataFrame(rows, SPECIAL_SCHEMA).select(
        "pos", "special", F.hex(F.encode("special", "UTF-8")).alias("token_hex")
    )


def special_list(docs: DataFrame, text: str, specials: Sequence[str]) -> DataFrame:
    """(pos, special, n_texts): the special tokens in list order and how many texts hold each."""
    specials = clean_specials(specials)
    held = docs.agg(
        *[F.count_if(F.contains(F.col(text), F.lit(s))).alias(f"c{i}") for i, s in enumerate(specials)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("pos"), F.lit(s).alias("special"), F.col(f"c{i}").alias("n_texts"))
            for i, s in enumerate(specials)
        ]
    )
    return held.select(F.inline(rows))


def build_vocab(spark: SparkSession, merges: DataFrame, specials: Sequence[str]) -> DataFrame:
    """Specials from id 0, then the 256 bytes, then the merges by rank."""
    first = special_table(spark, specials)
    n = len(clean_specials(specials))
    parts = (
        first.select(F.col("pos").alias("token_id"), "token_hex")
        .unionByName(
            spark.range(256).select(
                (F.col("id") + n).cast("int").alias("token_id"),
                F.lpad(F.hex("id"), 2, "0").alias("token_hex"),
            )
        )
        .unionByName(
            merges.select(
                (F.col("rank") + n + 256).cast("int").alias("token_id"),
                F.concat("l", "r").alias("token_hex"),
            )
        )
    )
    return parts.withColumn("ins_order", F.col("token_id"))


def add_specials(vocab: DataFrame, specials: Sequence[str]) -> DataFrame:
    """The vocabulary plus the specials it lacks, at the ids after its largest.

    One row, the largest id, comes to the driver. The vocabulary is read more than once, so it
    should be a stored table.
    """
    if not specials:
        return vocab
    missing = (
        special_table(vocab.sparkSession, specials)
        .join(vocab.select("token_hex"), "token_hex", "left_anti")
        # the window sees the list of specials only, never the vocabulary
        .withColumn("nth", F.row_number().over(Window.orderBy("pos")))
    )
    top = vocab.agg(
        F.coalesce(F.max("token_id"), F.lit(-1)).alias("token_id"),
        F.coalesce(F.max("ins_order"), F.lit(-1)).alias("ins_order"),
    ).first()
    added = missing.select(
        (F.col("nth") + top["token_id"]).cast("int").alias("token_id"),
        "token_hex",
        (F.col("nth") + top["ins_order"]).cast("int").alias("ins_order"),
    )
    return vocab.select("token_id", "token_hex", "ins_order").unionByName(added)


def reverse_vocab(vocab: DataFrame) -> DataFrame:
    """(token_hex, token_id): one id for each byte string, the last one put in."""
    return vocab.groupBy("token_hex").agg(F.max_by("token_id", "ins_order").alias("token_id"))


def vocab_stats(vocab: DataFrame, merges: DataFrame) -> DataFrame:
    """One row: entries, different byte strings, merges and longest token."""
    entries = vocab.select("token_hex", F.lit(False).alias("is_merge")).unionByName(
        merges.select(F.concat("l", "r").alias("token_hex"), F.lit(True).alias("is_merge"))
    )
    token = F.when(~F.col("is_merge"), F.col("token_hex"))
    return entries.agg(
        F.count(token).alias("vocab_size"),
        F.count_distinct(token).alias("distinct_tokens"),
        F.max((F.length(token) / 2).cast("int")).alias("longest_token"),
        F.count_if("is_merge").alias("num_merges"),
    )


def token_pieces(vocab: DataFrame) -> DataFrame:
    """(token_id, piece): each token shown as text on its own."""
    return vocab.select("token_id", hex_to_text(F.col("token_hex")).alias("piece"))
