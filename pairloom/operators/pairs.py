"""Adjacent pairs of symbols inside weighted words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.symbols import SymbolTable, apply_merges, pair_list, symbol_hex


def coded_pair_counts(words: DataFrame) -> DataFrame:
    """(pair, n) with the pair as two symbol characters. Words of one symbol give nothing."""
    return (
        words.select(F.explode(pair_list(F.col("word"))).alias("pair"), "cnt")
        .groupBy("pair")
        .agg(F.sum("cnt").alias("n"))
    )


def gram_changes(words: DataFrame) -> DataFrame:
    """(gram, n): what words (cnt, old, new) gain and lose in pairs and triples of neighbours, one row
    for each place.

    The new and the old form are read as one text, whose grams across the seam count for nothing. SQL
    text, because building it from columns takes longer than a small job.
    """
    return words.selectExpr(
        "cnt", "length(new) AS seam", "posexplode(regexp_extract_all(new || old, '(?s)(?=(...?)).', 1)) AS (pos, gram)"
    ).selectExpr(
        "if(pos < seam, cnt, -cnt) AS n",
        """explode(array_compact(array(
            if(pos = seam - 1, NULL, substring(gram, 1, 2)),
            if(length(gram) < 3 OR pos = seam - 1 OR pos = seam - 2, NULL, gram)))) AS gram""",
    ).select("gram", "n")


def pair_postings(words: DataFrame) -> DataFrame:
    """(pair, word, cnt) ordered by pair: the words that hold each pair, once. A scan for a few pairs
    skips the parts of the table that do not hold them."""
    rows = words.select(F.explode(F.array_distinct(pair_list(F.col("word")))).alias("pair"), "word", "cnt")
    return rows.repartitionByRange("pair", "word").sortWithinPartitions("pair")


def pair_sides(pair: Column, table: SymbolTable) -> list[Column]:
    return [
        symbol_hex(F.substring(pair, 1, 1), table).alias("l"),
        symbol_hex(F.substring(pair, 2, 1), table).alias("r"),
    ]


def pair_counts(words: DataFrame, table: SymbolTable | None = None) -> DataFrame:
    """(l, r, n): weighted adjacent pairs as hex; overlapping occurrences all count."""
    return coded_pair_counts(words).select(*pair_sides(F.col("pair"), table or SymbolTable()), "n")


def pair_index(words: DataFrame, table: SymbolTable | None = None) -> DataFrame:
    """(l, r, word, positions): where each pair sits in each word.

    A group is one pair inside one word, so it is never larger than that word.
    """
    return (
        words.select("word", F.posexplode(pair_list(F.col("word"))).alias("pos", "pair"))
        .groupBy("pair", "word")
        .agg(F.sort_array(F.collect_list("pos")).alias("positions"))
        .select(*pair_sides(F.col("pair"), table or SymbolTable()), "word", "positions")
    )


def best_pair(pairs: DataFrame) -> DataFrame:
    """One row (l, r, n): the highest count, ties to the byte-wise largest pair."""
    return pairs.agg(F.max(F.struct("n", "l", "r")).alias("best")).where("best is not null").select(
        "best.l", "best.r", "best.n"
    )


def merge_once(words: DataFrame, table: SymbolTable, left: str, right: str) -> DataFrame:
    """(word, merged, cnt) for the words that hold the pair; the others would not change."""
    rule = table.rule(left, right)
    return words.where(F.contains("word", F.lit(rule[:2]))).select(
        "word", apply_merges(F.col("word"), [rule]).alias("merged"), "cnt"
    )
