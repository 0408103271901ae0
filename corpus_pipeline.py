"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a table; it is written as Parquet and read again as
the next stage's docs. All but the last return the columns of documents, and each works on all rows
its predecessor kept. A stage with nothing to do returns its input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pairloom.llm.decontaminate import drop_contaminated
from pairloom.llm.exact_dedup import drop_copies
from pairloom.llm.ngram_join import keep_one_each
from pairloom.llm.packing import pack_documents
from pairloom.llm.toxicity import drop_toxic
from pairloom.session import work_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of equal documents stays."""
    return drop_copies(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays."""
    return keep_one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, placed in sequences."""
    return pack_documents(docs, TOKENIZER).drop("uid")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("packing", packing),
]

# A trained classifier and a packing plan have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
