"""Tokenizer files in text form: Python-literal merges, JSON vocabularies, and GPT-2 style files.

These files hold a vocabulary, which is bounded (see `symbols.MAX_SYMBOLS`), so each is read as one
row: that keeps the order of its lines.
"""

from __future__ import annotations

import ast
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions.text import clean_specials, hex_to_text
from pairloom.operators.vocab import special_table

NUL = "\0"
PAIR_TYPE = T.StructType([T.StructField("l", T.StringType()), T.StructField("r", T.StringType())])


def byte_characters() -> str:
    """The printable character that stands for each byte in GPT-2 style files, in byte order."""
    # Bytes shown as themselves. The others get the characters from U+0100 on.
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256))
    return "".join(chr(b if b in shown else 256 + next(spare)) for b in range(256))


def shown_to_hex(token: Column) -> Column:
    """GPT-2 style characters to hex bytes. `translate` would delete for NUL, so that goes apart."""
    shown = byte_characters()
    latin = "".join(map(chr, range(256)))
    plain = F.translate(token, shown[1:], latin[1:])
    return F.hex(F.encode(F.replace(plain, F.lit(shown[0]), F.lit(NUL)), "ISO-8859-1"))


def hex_to_shown(token_hex: Column) -> Column:
    shown = byte_characters()
    latin = "".join(map(chr, range(256)))
    text = F.decode(F.unhex(token_hex), "ISO-8859-1")
    return F.translate(F.replace(text, F.lit(NUL), F.lit(shown[0])), latin[1:], shown[1:])


def _bytes_hex(value: object) -> str | None:
    return value.hex().upper() if isinstance(value, bytes) else None


@F.pandas_udf(PAIR_TYPE)
def parse_pair(lines: pd.Series) -> pd.DataFrame:
    """A line such as `(b't', b'h')` to two hex strings; nulls if it is anything else."""

    def parse(line: str) -> tuple[str | None, str | None]:
        try:
            pair = ast.literal_eval(line.strip())
        except (ValueError, SyntaxError):
            return None, None
        if not isinstance(pair, tuple) or len(pair) != 2:
            return None, None
        sides = _bytes_hex(pair[0]), _bytes_hex(pair[1])
        return sides if None not in sides else (None, None)

    return pd.DataFrame([parse(line) for line in lines], columns=["l", "r"])


@F.pandas_udf(T.StringType())
def parse_bytes(values: pd.Series) -> pd.Series:
    """A literal such as `b'th'` to hex; null if it does not parse."""

    def parse(value: str) -> str | None:
        try:
            return _bytes_hex(ast.literal_eval(value))
        except (ValueError, SyntaxError):
            return None

    return values.map(parse)


@F.pandas_udf(T.StringType())
def bytes_literal(token_hex: pd.Series) -> pd.Series:
    return token_hex.map(lambda h: repr(bytes.fromhex(h)))


def _one_file(spark: SparkSession, path: str) -> DataFrame:
    """(value) of one text file as one row; the order of entries is that within a file."""
    whole = spark.read.text(path, wholetext=True)
    if len(whole.inputFiles()) > 1:
        raise ValueError(f"{path} holds several files; their order is not known")
    return whole


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of a text file."""
    return _one_file(spark, path).select(
        F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("line_no", "line")
    )


def _ranked(rows: DataFrame) -> DataFrame:
    """Ranks close up over the kept lines; the window sees one merge file."""
    rank = F.row_number().over(Window.orderBy("line_no")) - 1
    return rows.select(rank.cast("int").alias("rank"), "l", "r")


def parsed_merges(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line, l, r) for the lines that are not blank; l is null where one is rejected."""
    return (
        _lines(spark, path)
        .where(F.trim("line") != "")
        .withColumn("pair", parse_pair("line"))
        .select("line_no", "line", "pair.l", "pair.r")
    )


def load_merges(spark: SparkSession, path: str) -> DataFrame:
    """(rank, l, r); rejected lines are left out (`parsed_merges` shows them)."""
    return _ranked(parsed_merges(spark, path).where("l is not null"))


def _json_entries(spark: SparkSession, path: str) -> DataFrame:
    """(pos, key, value) of a JSON object in file order."""
    parsed = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    return _one_file(spark, path).select(
        F.posexplode(F.map_entries(parsed)).alias("pos", "entry")
    ).select("pos", "entry.key", "entry.value")


def parsed_vocab(spark: SparkSession, path: str) -> DataFrame:
    """(pos, key, value, token_id, token_hex) from JSON id -> token; a null marks a rejected entry."""
    literal = F.col("value").startswith("b'") | F.col("value").startswith('b"')
    return _json_entries(spark, path).select(
        "pos",
        "key",
        "value",
        F.expr("try_cast(trim(key) as int)").alias("token_id"),
        F.when(literal, parse_bytes("value"))
        .otherwise(F.hex(F.encode("value", "UTF-8")))
        .alias("token_hex"),
    )


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    """(token_id, token_hex, ins_order); rejected entries are left out (`parsed_vocab` shows them)."""
    return (
        parsed_vocab(spark, path).where("token_id is not null and token_hex is not null")
        .groupBy("token_id")  # a repeated key keeps its first place and its last value
        .agg(F.max_by("token_hex", "pos").alias("token_hex"), F.min("pos").alias("ins_order"))
    )


def parsed_gpt2_merges(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line, l, r) for the lines that are not blank; l is null where one is rejected."""
    parts = F.split(F.rtrim("line"), " ")
    sides = [F.when(F.size(parts) == 2, shown_to_hex(F.get(parts, i))) for i in (0, 1)]
    return _lines(spark, path).where(F.trim("line") != "").select(
        "line_no", "line", sides[0].alias("l"), sides[1].alias("r")
    )


def load_gpt2_merges(spark: SparkSession, path: str) -> DataFrame:
    """(rank, l, r) from lines of two tokens; others are left out (`parsed_gpt2_merges` shows them)."""
    return _ranked(parsed_gpt2_merges(spark, path).where("l is not null"))


def load_gpt2_vocab(
    spark: SparkSession, path: str, specials: Sequence[str] | None = None
) -> DataFrame:
    """(token_id, token_hex, ins_order) from JSON token -> id; absent specials go at the end, counted
    from the number of entries."""
    vocab = _json_entries(spark, path).select(
        F.col("value").cast("int").alias("token_id"),
        shown_to_hex(F.col("key")).alias("token_hex"),
        F.col("pos").alias("ins_order"),
    )
    if not clean_specials(specials):
        return vocab
    missing = (
        special_table(spark, specials)
        .join(vocab.select("token_hex"), "token_hex", "left_anti")
        .withColumn("nth", F.row_number().over(Window.orderBy("pos")) - 1)
    )
    at = (F.col("nth") + vocab.count()).cast("int")
    return vocab.unionByName(
        missing.select(at.alias("token_id"), "token_hex", at.alias("ins_order"))
    )


def save_merges(merges: DataFrame, path: str) -> None:
    """Lines `(b'..', b'..')` in rank order."""
    line = F.concat(F.lit("("), bytes_literal("l"), F.lit(", "), bytes_literal("r"), F.lit(")"))
    _write_lines(merges.select(F.col("rank").alias("at"), line.alias("line")), path)


def save_gpt2_merges(merges: DataFrame, path: str) -> None:
    line = F.concat_ws(" ", hex_to_shown(F.col("l")), hex_to_shown(F.col("r")))
    _write_lines(merges.select(F.col("rank").alias("at"), line.alias("line")), path)


def save_vocab(vocab: DataFrame, path: str, lossless: bool = True) -> None:
    """JSON id -> token, as byte literals or (lossy) as text with U+FFFD for bad bytes."""
    token = bytes_literal("token_hex") if lossless else hex_to_text(F.col("token_hex"))
    _write_object(
        vocab.select(
            F.col("ins_order").alias("at"), F.col("token_id").cast("string").alias("key"), token.alias("value")
        ),
        path,
    )


def save_gpt2_vocab(vocab: DataFrame, path: str) -> None:
    """JSON token -> id. The format has one id for a token: that of the entry put in last."""
    last = vocab.groupBy("token_hex").agg(
        F.max_by("token_id", "ins_order").alias("token_id"), F.max("ins_order").alias("ins_order")
    )
    _write_object(
        last.select(
            F.col("ins_order").alias("at"),
            hex_to_shown(F.col("token_hex")).alias("key"),
            F.col("token_id").cast("string").alias("value"),
        ),
        path,
    )


def _write_lines(rows: DataFrame, path: str) -> None:
    """One file in order; vocabulary-sized."""
    rows.coalesce(1).sortWithinPartitions("at").select("line").write.mode("overwrite").text(path)


def _write_object(rows: DataFrame, path: str) -> None:
    """One JSON object whose entries are in order; vocabulary-sized, as the reader needs it whole."""
    entries = F.sort_array(F.collect_list(F.struct("at", "key", "value")))
    as_map = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], e["value"])))
    rows.agg(F.to_json(as_map).alias("value")).write.mode("overwrite").text(path)
