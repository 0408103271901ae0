"""One query for each operator, over the whole tables in `sf_dir`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.functions.symbols import SymbolTable, byte_word_hex, delimited_hex
from pairloom.functions.text import DELIMITER
from pairloom.operators import decode as dec
from pairloom.operators import pairs as prs
from pairloom.operators import pretokenize as pre
from pairloom.operators import vocab as voc
from pairloom.operators.encode import special_counts as count_special
from pairloom.plans.examples import (
    ABSENT_BYTES,
    EDGES,
    KNOWN_MERGES,
    LONG_MERGES,
    LONG_STOP,
    MERGES,
    SHORT_MERGES,
    SPECIALS,
    TRAIN_MERGES,
    TRAIN_STEP,
)
from pairloom.plans.tokenizer import Tokenizer, merge_table
from pairloom.plans.train import resume_training, train_bpe
from pairloom.session import work_dir
from pairloom.sources import checkpoints, corpus, tokenizer_files
from pairloom.streaming import encode_stream, merge_stream_counts, pretoken_counts_stream

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.read_table(spark, f"{sf_dir}/documents.parquet", "doc_id", "text")


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chat_id, text): each turn with its role as a special token and one or two delimiters after."""
    turns = corpus.read_table(spark, f"{sf_dir}/conversations.parquet", "conv_id", "turn", "role", "text")
    ends = F.when(F.col("turn") % 3 == 0, DELIMITER + DELIMITER).otherwise(DELIMITER)
    return turns.select(
        (F.col("conv_id") * 100000 + F.col("turn")).alias("chat_id"),
        F.concat(F.lit("<|"), "role", F.lit("|>"), "text", ends).alias("text"),
    )


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pre.word_counts(documents(spark, sf_dir))


def example_tokenizer(
    spark: SparkSession, merges: list[tuple[str, str]], specials: list[str] | None = None
) -> Tokenizer:
    table = merge_table(spark, merges)
    return Tokenizer.build(voc.build_vocab(spark, table, specials or []), table, specials)


def partial_tokenizer(spark: SparkSession) -> Tokenizer:
    """All short merges, but ids for some of them only and not for every byte."""
    whole = example_tokenizer(spark, SHORT_MERGES)
    known = whole.vocab.where(
        (F.col("token_id") < 256 + KNOWN_MERGES) & ~F.col("token_hex").isin(*ABSENT_BYTES)
    )
    return Tokenizer(known, whole.merges)


def ranked_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rank, l, r) of the corpus's byte pairs by frequency: a merge-shaped table of at most 65,536
    rows, which is why one window may hold it."""
    order = Window.orderBy(F.desc("n"), F.desc("l"), F.desc("r"))
    return prs.pair_counts(words(spark, sf_dir)).select(
        (F.row_number().over(order) - 1).cast("int").alias("rank"), "l", "r"
    )


def pair_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stored vocabulary."""
    path = work_dir(spark, "pairs")
    ranked_pairs(spark, sf_dir).select(
        F.col("rank").alias("token_id"),
        F.concat("l", "r").alias("token_hex"),
        F.col("rank").alias("ins_order"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def joined(ids: str) -> Column:
    return F.concat_ws(",", F.col(ids).cast("array<string>")).alias(ids)


def corpus_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "corpus")
    documents(spark, sf_dir).select("text").write.option("lineSep", DELIMITER).text(path)
    return (
        corpus.scan_delimited(spark, path)
        .groupBy(F.md5("text").alias("text_md5"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def corpus_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "corpus")
    documents(spark, sf_dir).select("text").write.option("lineSep", DELIMITER).text(path)
    return corpus.corpus_pretoken_counts(spark, path, [DELIMITER])


def corpus_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text as bytes with a stray byte before and a cut character after."""
    broken = documents(spark, sf_dir).select(
        "doc_id",
        F.concat(F.unhex(F.lit("FF")), F.encode("text", "UTF-8"), F.unhex(F.lit("E282"))).alias("content"),
    )
    return corpus.decode_files(broken)


def special_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pre.split_specials(chat(spark, sf_dir), "chat_id", "text", SPECIALS)


def pretoken_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pre.pretoken_rows(documents(spark, sf_dir), "doc_id", "text")


def pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pre.pretoken_counts(documents(spark, sf_dir))


def pretoken_counts_special(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pre.pretoken_counts(chat(spark, sf_dir), "text", SPECIALS)


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pre.corpus_stats(pretoken_counts(spark, sf_dir))


def byte_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words(spark, sf_dir).select(
        delimited_hex(F.col("word"), SymbolTable()).alias("symbols"),
        F.length("word").alias("n_symbols"),
        "cnt",
    )


def pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prs.pair_counts(words(spark, sf_dir))


def pair_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prs.pair_index(words(spark, sf_dir)).select(
        "l", "r", byte_word_hex(F.col("word")).alias("word"), joined("positions")
    )


def best_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prs.best_pair(pair_counts(spark, sf_dir))


def merge_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = SymbolTable()
    merged = prs.merge_once(words(spark, sf_dir), table, *SHORT_MERGES[0])
    return merged.select(
        byte_word_hex(F.col("word")).alias("word"),
        delimited_hex(F.col("merged"), table).alias("merged"),
        "cnt",
    )


def trained(spark: SparkSession, sf_dir: str, **options) -> Tokenizer:
    return train_bpe(
        documents(spark, sf_dir), 256 + len(SPECIALS) + TRAIN_MERGES, SPECIALS, **options
    )


def train_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trained(spark, sf_dir).merges


def train_special(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training on text that holds special tokens: they take part as bytes."""
    return train_bpe(chat(spark, sf_dir), 256 + len(SPECIALS) + TRAIN_MERGES, SPECIALS).merges


def train_without_special(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_bpe(
        chat(spark, sf_dir), 256 + len(SPECIALS) + TRAIN_MERGES, SPECIALS, exclude_specials=True
    ).merges


def vocab_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trained(spark, sf_dir).vocab.select("token_id", "token_hex")


def train_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "training")
    size = 256 + len(SPECIALS)
    train_bpe(
        documents(spark, sf_dir),
        size + TRAIN_STEP,
        SPECIALS,
        save_progress=True,
        progress_interval=TRAIN_STEP,
        checkpoint_dir=path,
    )
    return resume_training(
        spark, f"{path}/step={TRAIN_STEP}", size + TRAIN_MERGES, save_progress=False
    ).merges


def train_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `benchmark`, over several stored bases, resumed on the way."""
    path = work_dir(spark, "training")
    items = corpus.read_table(spark, f"{sf_dir}/benchmark.parquet", "text")
    size = 256 + len(SPECIALS)
    train_bpe(
        items, size + LONG_STOP, SPECIALS, save_progress=True, progress_interval=LONG_STOP, checkpoint_dir=path
    )
    return resume_training(spark, f"{path}/final", size + LONG_MERGES, save_progress=False).merges


def train_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained, saved, loaded, then used on the text it was trained on."""
    path = work_dir(spark, "tokenizer")
    trained(spark, sf_dir).save(path)
    tok = Tokenizer.load(spark, path)
    encoded = tok.encode(documents(spark, sf_dir)).select("doc_id", "ids")
    return tok.decode(encoded).select("doc_id", joined("ids"), "text")


def _chat_training(spark: SparkSession, sf_dir: str) -> str:
    path = work_dir(spark, "training")
    train_bpe(
        chat(spark, sf_dir),
        256 + len(SPECIALS) + TRAIN_MERGES,
        SPECIALS,
        save_progress=True,
        progress_interval=TRAIN_STEP,
        checkpoint_dir=path,
    )
    return path


def checkpoint_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last checkpoint's words look like after all merges."""
    saved = checkpoints.read_checkpoint(spark, f"{_chat_training(spark, sf_dir)}/final")
    merges = [(r["l"], r["r"]) for r in saved.merges.orderBy("rank").collect()]
    return saved.words.select(delimited_hex(F.col("word"), SymbolTable(merges)).alias("symbols"), "cnt")


def training_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpoints.training_history(spark, _chat_training(spark, sf_dir))


def save_load_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables written and read again, as merges and vocabulary in one listing."""
    path = work_dir(spark, "tokenizer")
    pairs = ranked_pairs(spark, sf_dir)
    checkpoints.write_tables(path, pairs, voc.build_vocab(spark, pairs, SPECIALS), SPECIALS)
    vocab, merges, _ = checkpoints.read_tables(spark, path)
    return vocab.join(
        merges.select((F.col("rank") + 256 + len(SPECIALS)).alias("token_id"), "l", "r"), "token_id", "left"
    ).select("token_id", "token_hex", "l", "r")


def load_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "merges")
    tokenizer_files.save_merges(ranked_pairs(spark, sf_dir), path)
    return tokenizer_files.load_merges(spark, path)


def load_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "vocab")
    tokenizer_files.save_vocab(pair_vocab(spark, sf_dir), path)
    return tokenizer_files.load_vocab(spark, path)


def load_gpt2_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "gpt2-vocab")
    tokenizer_files.save_gpt2_vocab(pair_vocab(spark, sf_dir), path)
    return tokenizer_files.load_gpt2_vocab(spark, path, SPECIALS)


def load_gpt2_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "gpt2-merges")
    tokenizer_files.save_gpt2_merges(ranked_pairs(spark, sf_dir), path)
    return tokenizer_files.load_gpt2_merges(spark, path)


def vocab_add_specials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voc.add_specials(pair_vocab(spark, sf_dir), ["th", *SPECIALS, "th"]).select(
        "token_id", "token_hex"
    )


def vocab_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token twice, under two ids; the copy put in last is the one with the smaller id."""
    vocab = pair_vocab(spark, sf_dir)
    again = vocab.select(
        (-1 - F.col("token_id")).alias("token_id"), "token_hex", (F.col("ins_order") + 100000).alias("ins_order")
    )
    return voc.reverse_vocab(vocab.unionByName(again))


def vocab_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "pairs")
    ranked_pairs(spark, sf_dir).write.parquet(path)
    merges = spark.read.parquet(path)
    return voc.vocab_stats(voc.build_vocab(spark, merges, SPECIALS), merges)


def special_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voc.special_list(chat(spark, sf_dir), "text", SPECIALS)


def encode_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = example_tokenizer(spark, MERGES)
    return tok.encode_words(pretoken_counts(spark, sf_dir)).select("pretoken", "n", "symbols", joined("ids"))


def encode_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = example_tokenizer(spark, MERGES)
    return tok.encode(documents(spark, sf_dir)).select("doc_id", joined("ids"))


def encode_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return example_tokenizer(spark, SHORT_MERGES).encode_rows(documents(spark, sf_dir), "doc_id")


def encode_special(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = example_tokenizer(spark, SHORT_MERGES, SPECIALS)
    return tok.encode(chat(spark, sf_dir)).select("chat_id", joined("ids"))


def encode_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partial_tokenizer(spark).encode(documents(spark, sf_dir)).select("doc_id", joined("ids"))


def encode_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markup: long runs of punctuation and white space."""
    pages = corpus.read_table(spark, f"{sf_dir}/pages.parquet", "page_id", "html")
    return example_tokenizer(spark, MERGES).encode(pages, "html").select("page_id", joined("ids"))


def encode_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item with one of the edge cases after it, encoded and decoded."""
    items = corpus.read_table(spark, f"{sf_dir}/benchmark.parquet", "item_id", "text")
    edge = F.array(*map(F.lit, EDGES))[(F.col("item_id") % len(EDGES)).cast("int")]
    tok = example_tokenizer(spark, SHORT_MERGES, SPECIALS)
    encoded = tok.encode(items.select("item_id", F.concat("text", edge).alias("text")))
    return tok.decode(encoded).select("item_id", joined("ids"), "text")


def special_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each special token comes out of encoding."""
    tok = example_tokenizer(spark, SHORT_MERGES, SPECIALS)
    found = tok.encode(chat(spark, sf_dir)).agg(
        *[
            F.sum(count_special("ids", tok.token_ids[s.encode().hex().upper()])).alias(f"c{i}")
            for i, s in enumerate(SPECIALS)
        ]
    )
    return found.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(s).alias("special"), F.col(f"c{i}").alias("n"))
                    for i, s in enumerate(SPECIALS)
                ]
            )
        )
    )


def decode_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = example_tokenizer(spark, MERGES)
    encoded = tok.encode(documents(spark, sf_dir)).select("doc_id", "ids")
    return tok.decode(encoded).select("doc_id", "text")


def decode_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = example_tokenizer(spark, SHORT_MERGES)
    return dec.decode_rows(tok.encode_rows(documents(spark, sf_dir), "doc_id"), "doc_id", tok.vocab)


def decode_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoding with a vocabulary that lacks the line feed: its ids are dropped."""
    tok = example_tokenizer(spark, SHORT_MERGES)
    known = Tokenizer(tok.vocab.where("token_hex <> '0A'"), tok.merges)
    encoded = tok.encode(documents(spark, sf_dir)).select("doc_id", "ids")
    return known.decode(encoded).select("doc_id", "text")


def unknown_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = example_tokenizer(spark, SHORT_MERGES)
    tokens = tok.encode_rows(documents(spark, sf_dir), "doc_id")
    return dec.unknown_ids(tokens, tok.vocab.where(F.col("token_id") < 256 + KNOWN_MERGES))


def token_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each token used by the documents, as text on its own, with its count."""
    tok = example_tokenizer(spark, SHORT_MERGES)
    used = (
        tok.encode_rows(documents(spark, sf_dir), "doc_id")
        .groupBy("token_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return used.join(voc.token_pieces(tok.vocab), "token_id")


def roundtrip_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus.read_table(spark, f"{sf_dir}/documents.parquet", "lang", "text")
    tok = example_tokenizer(spark, MERGES)
    return dec.roundtrip_audit(tok.decode(tok.encode(docs), to="back"), "text", "back", "lang")


def _document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table is one file or a folder of files. A stream takes a folder or a pattern, so its name is
    given as a pattern that fits nothing else."""
    return spark.readStream.schema("doc_id bigint, text string").parquet(f"{sf_dir}/documents.parque[t]")


def encode_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "stream")
    tok = example_tokenizer(spark, SHORT_MERGES)
    encode_stream(_document_stream(spark, sf_dir), tok, path).awaitTermination()
    return spark.read.parquet(f"{path}/rows").select("doc_id", joined("ids"))


def pretoken_counts_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "stream")
    pretoken_counts_stream(_document_stream(spark, sf_dir), path).awaitTermination()
    return merge_stream_counts(spark, path)


QUERIES: dict[str, Query] = {
    "corpus_scan": corpus_scan,
    "corpus_counts": corpus_counts,
    "corpus_decode": corpus_decode,
    "special_split": special_split,
    "pretoken_stream": pretoken_stream,
    "pretoken_counts": pretoken_counts,
    "pretoken_counts_special": pretoken_counts_special,
    "corpus_stats": corpus_stats,
    "byte_symbols": byte_symbols,
    "pair_counts": pair_counts,
    "pair_index": pair_index,
    "best_pair": best_pair,
    "merge_once": merge_once,
    "train_bpe": train_merges,
    "train_special": train_special,
    "train_without_special": train_without_special,
    "train_resume": train_resume,
    "train_long": train_long,
    "train_encode_decode": train_encode_decode,
    "vocab_build": vocab_build,
    "checkpoint_write": checkpoint_write,
    "training_history": training_history,
    "save_load_roundtrip": save_load_roundtrip,
    "load_merges": load_merges,
    "load_vocab": load_vocab,
    "load_gpt2_vocab": load_gpt2_vocab,
    "load_gpt2_merges": load_gpt2_merges,
    "vocab_add_specials": vocab_add_specials,
    "vocab_reverse": vocab_reverse,
    "vocab_stats": vocab_stats,
    "special_list": special_list,
    "encode_words": encode_words,
    "encode_docs": encode_docs,
    "encode_tokens": encode_tokens,
    "encode_special": encode_special,
    "encode_fallback": encode_fallback,
    "encode_pages": encode_pages,
    "encode_edges": encode_edges,
    "special_counts": special_counts,
    "decode_docs": decode_docs,
    "decode_tokens": decode_tokens,
    "decode_unknown": decode_unknown,
    "unknown_ids": unknown_ids,
    "token_pieces": token_pieces,
    "roundtrip_audit": roundtrip_audit,
    "encode_stream": encode_streamed,
    "pretoken_counts_stream": pretoken_counts_streamed,
}
