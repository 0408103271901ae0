"""One query for each operator, over its whole table, with the columns its contract names."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import (
    decontaminate,
    exact_dedup,
    hard_negatives,
    html_text,
    ngram_join,
    packing,
    quality,
    quality_rules,
    sharding,
    spelling,
    substring_dedup,
    toxicity,
    url_filter,
)
from pairloom.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 24
# The rules of the URL filter.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def _read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    return sharding.shuffle_to_shards(docs, SHARDS).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(
        _read(spark, sf_dir, "documents", "doc_id", "lang", "text"), _read(spark, sf_dir, "labels", "doc_id", "quality")
    )


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_read(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    return ngram_join.ngram_components(docs, size=3, percent=90)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        _read(spark, sf_dir, "documents", "doc_id", "text"), _read(spark, sf_dir, "benchmark", "item_id", "text")
    )


def exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER).drop("uid")


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(
        _read(spark, sf_dir, "documents", "doc_id", "text"), _read(spark, sf_dir, "labels", "doc_id", "toxic")
    )


def substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(_read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract_text(_read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("*", F.length("text").cast("bigint").alias("n_chars"))


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "lang", "text")
    labels = _read(spark, sf_dir, "labels", "doc_id", "quality").withColumnRenamed("quality", "good")
    return quality_rules.judge(docs, labels)


def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(_read(spark, sf_dir, "embeddings", "vec_id", "label", "embedding"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {
    "op1_sharding": shards,
    "op2_quality": quality_classifier,
    "op3_url_filter": url_verdicts,
    "op4_ngram_jaccard": ngram_jaccard,
    "op5_decontamination": decontamination,
    "op6_exact_dedup": exact,
    "op7_best_fit_packing": best_fit_packing,
    "op8_toxicity": toxic,
    "op9_substring_dedup": substrings,
    "op10_html_text": main_text,
    "op11_quality_rules": rules,
    "op12_hard_negatives": negatives,
    "op13_spelling_variants": spelling_variants,
}
