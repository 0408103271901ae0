"""From token ids back to text, and checks on the way."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions.symbols import MAX_SYMBOLS
from pairloom.operators.batches import list_offsets, list_slices


class _Bytes:
    """Texts of many id lists at once: bytes are looked up and joined in Arrow."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.known = pa.array(list(bytes_of), pa.int64())
        self.tokens = pa.array([*bytes_of.values(), b""], pa.large_binary())

    def texts(self, ids: pa.Array, offsets: np.ndarray) -> pa.Array:
        places = pc.fill_null(pc.index_in(ids.cast(pa.int64()), self.known), len(self.known))
        pieces = self.tokens.take(places)
        _, piece_ends, data = pieces.buffers()
        ends = np.frombuffer(piece_ends, np.int64)[: len(pieces) + 1][offsets]
        if ends[-1] >= 1 << 31:
            raise OverflowError("a text has more than 2^31 bytes")
        joined = pa.BinaryArray.from_buffers(
            pa.binary(), len(offsets) - 1, [None, pa.py_buffer(ends.astype(np.int32)), data]
        )
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:  # somewhere the bytes are not UTF-8
            return pa.array([b.decode("utf-8", "replace") for b in joined.to_pylist()], pa.string())


def _arrow_text(bytes_of: dict[int, bytes]):
    @F.arrow_udf("string")
    def decoded(ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lookup = _Bytes(bytes_of)
        for part in list_slices(ids):
            yield lookup.texts(part.flatten(), list_offsets(part))

    return decoded


def _arrow_parts(bytes_of: dict[int, bytes]):
    @F.arrow_udf("string")
    def decoded(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        lookup = _Bytes(bytes_of)
        for at, ids in columns:
            start = 0
            for part in list_slices([ids]):
                offsets, values = list_offsets(part), part.flatten().cast(pa.int64())
                yield lookup.texts(_in_order(at.slice(start, len(part)).flatten(), values, offsets), offsets)
                start += len(part)

    return decoded


def _in_order(at: pa.Array, values: pa.Array, offsets: np.ndarray) -> pa.Array:
    """The values of each list by place, then value, nulls first."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    least = np.iinfo(np.int64).min
    place = pc.fill_null(at.cast(pa.int64()), least).to_numpy(zero_copy_only=False)
    if ((place[1:] > place[:-1]) | (row[1:] > row[:-1])).all():
        return values
    return values.take(pa.array(np.lexsort((pc.fill_null(values, least).to_numpy(zero_copy_only=False), place, row))))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, at, ids) from (key, pos, token_id): one row for each run of rows with one key."""
    for batch in batches:
        key, n = batch.column(0), batch.num_rows
        if not n:
            continue
        try:
            differs = pc.fill_null(pc.not_equal(key.slice(1), key.slice(0, n - 1)), False).to_numpy(zero_copy_only=False)
            missing = key.is_null().to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.concatenate(([True], differs | (missing[1:] != missing[:-1]))))
        except pa.ArrowNotImplementedError:  # a type that Arrow does not compare: grouping puts its rows together
            starts = np.arange(n)
        offsets = pa.array([*starts.tolist(), n], pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, batch.column(i)) for i in (1, 2)]
        yield pa.RecordBatch.from_arrays([key.take(pa.array(starts)), *lists], names=["key", "at", "ids"])


def _bytes_of(vocab: DataFrame) -> dict[int, bytes]:
    """Of entries with one id, the one put in last counts."""
    order = ["ins_order"] if "ins_order" in vocab.columns else []
    rows = vocab.select("token_id", "token_hex", *order).limit(MAX_SYMBOLS + 1).collect()
    if len(rows) > MAX_SYMBOLS:
        raise ValueError(f"vocabulary of more than {MAX_SYMBOLS} entries")
    if order:
        rows.sort(key=lambda r: r["ins_order"])
    return {r["token_id"]: bytes.fromhex(r["token_hex"]) for r in rows}


def decode_column(docs: DataFrame, vocab: DataFrame, ids: str, to: str) -> DataFrame:
    """Decode id arrays in their rows: no join, no shuffle, and the same cost however ids are numbered.

    The bytes are put together before they are read as UTF-8, since a character may span tokens.
    """
    return docs.withColumn(to, _arrow_text(_bytes_of(vocab))(F.col(ids)))


def decode_rows(tokens: DataFrame, key: str, vocab: DataFrame) -> DataFrame:
    """(key, text) from (key, pos, token_id). A group is one document's own tokens. Neighbouring rows of
    one key are put together before the shuffle, which then moves a few rows of numbers for each document."""
    rows = tokens.select(F.col(key).alias("key"), "pos", "token_id")
    of = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType().add("key", of["key"]).add("at", T.ArrayType(of["pos"])).add("ids", T.ArrayType(of["token_id"]))
    # runs by their first place: rows that came in order stay so
    parts = F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("parts")
    documents = rows.mapInArrow(_runs, schema).groupBy("key").agg(parts)
    text = _arrow_parts(_bytes_of(vocab))(F.flatten("parts.at"), F.flatten("parts.ids"))
    return documents.select(F.col("key").alias(key), text.alias("text"))


def unknown_ids(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """(token_id, n): ids that decoding drops. Counted before the join, so a hot id is one row."""
    return (
        tokens.groupBy("token_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(vocab.select("token_id"), "token_id", "left_anti")
    )


def roundtrip_audit(decoded: DataFrame, text: str, back: str, by: str) -> DataFrame:
    """(by, n_texts, n_equal, n_different): does decoding give the text again?"""
    same = F.col(text).eqNullSafe(F.col(back))
    return decoded.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.count_if(same).alias("n_equal"),
        F.count_if(~same).alias("n_different"),
    )
