"""From documents to segments, pretokens and weighted words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.symbols import symbol_word
from pairloom.functions.text import clean_specials, pretokens, segments


def split_specials(docs: DataFrame, key: str, text: str, specials: Sequence[str]) -> DataFrame:
    """(key, seg_pos, segment, is_special)"""
    parts = segments(F.col(text), specials)
    return docs.select(key, F.posexplode(parts).alias("seg_pos", "segment")).select(
        key, "seg_pos", "segment", F.col("segment").isin(clean_specials(specials)).alias("is_special")
    )


def pretoken_rows(
    docs: DataFrame, key: str, text: str, specials: Sequence[str] | None = None
) -> DataFrame:
    """(key, pos, pretoken): every pretoken occurrence. Narrow: no shuffle."""
    return docs.select(
        key, F.posexplode(pretokens(F.col(text), specials)).alias("pos", "pretoken")
    )


def pretoken_counts(
    docs: DataFrame, text: str = "text", specials: Sequence[str] | None = None
) -> DataFrame:
    """(pretoken, n). Counts are combined before the shuffle, so a hot pretoken is one row per task."""
    return (
        docs.select(F.explode(pretokens(F.col(text), specials)).alias("pretoken"))
        .groupBy("pretoken")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def word_counts(
    docs: DataFrame,
    text: str = "text",
    specials: Sequence[str] | None = None,
    exclude_specials: bool = False,
) -> DataFrame:
    """(word, cnt): training input, words as symbol strings.

    Specials count as words made of their bytes unless `exclude_specials`.
    """
    counts = pretoken_counts(docs, text, specials)
    if exclude_specials and specials:
        counts = counts.where(~F.col("pretoken").isin(clean_specials(specials)))
    return words_from_counts(counts)


def words_from_counts(counts: DataFrame) -> DataFrame:
    return counts.select(symbol_word(F.col("pretoken")).alias("word"), F.col("n").alias("cnt"))


def corpus_stats(counts: DataFrame) -> DataFrame:
    """One row of totals over (pretoken, n)."""
    size = F.octet_length("pretoken").cast("bigint")
    return counts.agg(
        F.count(F.lit(1)).alias("distinct_pretokens"),
        F.sum("n").alias("pretokens"),
        F.sum(F.col("n") * size).alias("bytes"),
        F.max(size).alias("longest_pretoken"),
    )
