import bz2
import gzip
import json

import pytest
from pyspark.sql import functions as F

from pairloom.functions.text import DELIMITER
from pairloom.operators.pretokenize import pretoken_counts
from pairloom.plans.examples import SPECIALS
from pairloom.plans.registry import example_tokenizer as tokenizer_of
from pairloom.plans.tokenizer import Tokenizer, merge_table
from pairloom.plans.train import train_bpe
from pairloom.sources import checkpoints, corpus, tokenizer_files
from pairloom.streaming import compact_stream_counts, encode_stream, merge_stream_counts, pretoken_counts_stream

VOCAB = "token_id int, token_hex string, ins_order int"


def ordered(df, key):
    return [tuple(r) for r in df.orderBy(key).collect()]


def test_merges_with_bad_lines(spark, tmp_path):
    path = tmp_path / "merges.txt"
    path.write_text(
        "(b't', b'h')\n\n  (b\"'\", b'\\xc3')  \nnonsense(\n(b'a',)\n[b'a', b'b']\n('a', 'b')\n(b'\\n', b'\\\\')\n",
        encoding="utf-8",
    )
    assert ordered(tokenizer_files.load_merges(spark, str(path)), "rank") == [
        (0, "74", "68"),
        (1, "27", "C3"),
        (2, "0A", "5C"),
    ]
    assert tokenizer_files.parsed_merges(spark, str(path)).where("l is null").count() == 4


def test_vocab_with_bad_entries(spark, tmp_path):
    path = tmp_path / "vocab.json"
    entries = {"3": "b'\\xff'", "0": 'b"it\'s"', "1": "é", "x": "b'a'", "2": "b'oops", " 7 ": "b", "8": "b'\\x00'"}
    path.write_text(json.dumps(entries, indent=2), encoding="utf-8")
    assert ordered(tokenizer_files.load_vocab(spark, str(path)), "ins_order") == [
        (3, "FF", 0),
        (0, "69742773", 1),
        (1, "C3A9", 2),
        (7, "62", 5),
        (8, "00", 6),
    ]


def test_all_bytes_survive_both_formats(spark, tmp_path):
    rows = [(b, f"{b:02X}", b) for b in range(256)] + [(256, "00FF20C3", 256)]
    vocab = spark.createDataFrame(rows, VOCAB)
    tokenizer_files.save_vocab(vocab, str(tmp_path / "v"))
    assert ordered(tokenizer_files.load_vocab(spark, str(tmp_path / "v")), "ins_order") == rows
    tokenizer_files.save_gpt2_vocab(vocab, str(tmp_path / "g"))
    assert ordered(tokenizer_files.load_gpt2_vocab(spark, str(tmp_path / "g")), "ins_order") == rows
    pairs = [(f"{b:02X}", f"{255 - b:02X}") for b in range(256)]
    merges = merge_table(spark, pairs)
    want = [(i, *p) for i, p in enumerate(pairs)]
    tokenizer_files.save_merges(merges, str(tmp_path / "m"))
    assert ordered(tokenizer_files.load_merges(spark, str(tmp_path / "m")), "rank") == want
    tokenizer_files.save_gpt2_merges(merges, str(tmp_path / "gm"))
    assert ordered(tokenizer_files.load_gpt2_merges(spark, str(tmp_path / "gm")), "rank") == want


def test_lossy_vocab_text(spark, tmp_path):
    vocab = spark.createDataFrame([(0, "C3A9", 0), (1, "FF", 1)], VOCAB)
    tokenizer_files.save_vocab(vocab, str(tmp_path / "v"), lossless=False)
    assert ordered(tokenizer_files.load_vocab(spark, str(tmp_path / "v")), "token_id") == [
        (0, "C3A9", 0),
        (1, "EFBFBD", 1),
    ]


def test_gpt2_characters_and_specials(spark, tmp_path):
    (tmp_path / "vocab.json").write_text('{"!": 0, "Ġthe": 1, "Ã©": 2, "Ā": 3}', encoding="utf-8")
    (tmp_path / "merges.txt").write_text("#version: 0.2 x\nĠ the\nlonely\nĊ Ā\n", encoding="utf-8")
    vocab = tokenizer_files.load_gpt2_vocab(spark, str(tmp_path / "vocab.json"), ["<s>", "!"])
    assert ordered(vocab.select("token_id", "token_hex"), "token_id") == [
        (0, "21"),
        (1, "20746865"),
        (2, "C3A9"),
        (3, "00"),
        (4, "3C733E"),
    ]
    merges = tokenizer_files.load_gpt2_merges(spark, str(tmp_path / "merges.txt"))
    assert ordered(merges, "rank") == [(0, "20", "746865"), (1, "0A", "00")]


def test_tables_round_trip(spark, tmp_path):
    merges = merge_table(spark, [("61", "62")])
    vocab = spark.createDataFrame([(0, "FF", 1), (4, "6162", 0)], VOCAB)
    checkpoints.write_tables(str(tmp_path / "t"), merges, vocab, ["<s>", "é"])
    got_vocab, got_merges, specials = checkpoints.read_tables(spark, str(tmp_path / "t"))
    assert (ordered(got_vocab, "token_id"), ordered(got_merges, "rank"), specials) == (
        [(0, "FF", 1), (4, "6162", 0)],
        [(0, "61", "62")],
        ("<s>", "é"),
    )


@pytest.mark.parametrize("ends", [True, False])
def test_delimited_corpus(spark, tmp_path, ends):
    parts = ["Once upon  ", "\n a time", "", "the end"]
    body = DELIMITER.join(parts) + (DELIMITER if ends else "")
    (tmp_path / "c.txt").write_bytes(body.encode())
    counts = corpus.corpus_pretoken_counts(spark, str(tmp_path / "c.txt"), [DELIMITER])
    whole = spark.createDataFrame([(body,)], "text string")
    assert ordered(counts, "pretoken") == ordered(pretoken_counts(whole, "text", [DELIMITER]), "pretoken")


BODIES = ["", "a", DELIMITER, "a" + DELIMITER, "a" + DELIMITER + "b", DELIMITER * 3, "x <|endoftext| y" + DELIMITER + ">z"]
BODIES += [">" + DELIMITER + ">", DELIMITER + "\n  tail  \n", "<|endof" + DELIMITER + "text|><|endoftext|" + "|>" + DELIMITER]


@pytest.mark.parametrize("packed", [False, True])
def test_delimiters_of_each_file_are_counted(spark, tmp_path, packed):
    """With and without a delimiter at the end, compressed or not, and with parts of it in the text."""
    whole = []
    for i, body in enumerate(BODIES):
        data = body.encode() + b"\xff"[: i % 2 if body and not body.endswith(DELIMITER) else 0]
        whole.append(data.decode("utf-8", errors="ignore"))
        (tmp_path / (f"{i}.txt.gz" if packed else f"{i}.txt")).write_bytes(gzip.compress(data) if packed else data)
    counts = corpus.delimiter_counts(spark, str(tmp_path)).collect()
    got = {r["path"].rsplit("/", 1)[1].split(".")[0]: (r["n_records"], r["n_delimiters"]) for r in counts}
    want = {}
    for i, body in enumerate(BODIES):
        parts = body.split(DELIMITER)
        if body:
            want[str(i)] = (len(parts) - (parts[-1] == ""), len(parts) - 1)
    assert got == want
    counted = corpus.corpus_pretoken_counts(spark, str(tmp_path), [DELIMITER])
    table = spark.createDataFrame([(t,) for t in whole], "text string")
    assert ordered(counted, "pretoken") == ordered(pretoken_counts(table, "text", [DELIMITER]), "pretoken")
    if not packed:
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan text") == 1


def test_files_of_both_kinds(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one" + DELIMITER)
    (tmp_path / "b.txt.gz").write_bytes(gzip.compress(("two" + DELIMITER) .encode() * 3000 + b"three"))
    counts = {r["pretoken"]: r["n"] for r in corpus.corpus_pretoken_counts(spark, str(tmp_path), [DELIMITER]).collect()}
    assert counts == {"one": 1, "two": 3000, "three": 1, DELIMITER: 3001}


def test_a_rewrite_that_is_cut_off_leaves_the_old_checkpoint(spark, tmp_path, monkeypatch):
    from pairloom import resume_training, train_bpe

    docs = spark.createDataFrame([("low lower lowest slow slower",)] * 4, "text string")
    path = f"{tmp_path}/run"
    first = train_bpe(docs, 262, save_progress=True, progress_interval=3, checkpoint_dir=path)
    saved = checkpoints.read_checkpoint(spark, f"{path}/final")
    words = sorted(saved.words.collect())

    def cut_off(*_):
        raise RuntimeError("cut off")

    for name in ("write_tables", "replace_file"):
        with monkeypatch.context() as patch, pytest.raises(RuntimeError):
            patch.setattr(checkpoints, name, cut_off)
            train_bpe(docs.limit(1), 264, save_progress=True, progress_interval=100, checkpoint_dir=path)
        again = checkpoints.read_checkpoint(spark, f"{path}/final")
        assert (again.merge_count, sorted(again.words.collect())) == (6, words)
        history = {r["checkpoint"]: r["merge_count"] for r in checkpoints.training_history(spark, path).collect()}
        assert history == {"step=3": 3, "step=6": 6, "final": 6}
    assert resume_training(spark, f"{path}/final", 264).merge_list[:6] == first.merge_list
    train_bpe(docs, 263, save_progress=True, progress_interval=100, checkpoint_dir=path)
    assert checkpoints.read_checkpoint(spark, f"{path}/final").merge_count == 7
    assert sum(p.name.startswith("v-") for p in (tmp_path / "run/final").iterdir()) == 1


def test_corpus_split_over_tasks_keeps_every_record(spark, tmp_path):
    texts = [f"story {i} " + "x" * (i % 97) for i in range(5000)]
    (tmp_path / "c.txt").write_bytes(DELIMITER.join(texts).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10007")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        scanned = corpus.scan_delimited(spark, str(tmp_path / "c.txt"))
        assert scanned.rdd.getNumPartitions() > 10
        assert sorted(r["text"] for r in scanned.collect()) == sorted(texts)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_binary_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"ok\xff \xc3\xa9\xe2\x82")
    df = corpus.decode_files(spark.read.format("binaryFile").load(str(tmp_path / "a.bin")))
    assert df.first()["text"] == "ok é"


def test_streams_equal_batch(spark, tmp_path, sf_dir):
    from pairloom.plans.registry import SHORT_MERGES, documents, example_tokenizer

    source = tmp_path / "in"
    docs = documents(spark, sf_dir)
    for part in range(3):
        docs.where(F.col("doc_id") % 3 == part).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 3).parquet(str(source))
    pretoken_counts_stream(stream, str(tmp_path / "counts")).awaitTermination()
    got = merge_stream_counts(spark, str(tmp_path / "counts"))
    assert got.exceptAll(pretoken_counts(docs)).isEmpty() and got.count() == pretoken_counts(docs).count()
    tok = example_tokenizer(spark, SHORT_MERGES)
    encode_stream(stream, tok, str(tmp_path / "ids")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "ids/rows"))
    assert rows.count() == docs.count()
    assert rows.exceptAll(tok.encode(docs).select(rows.columns)).isEmpty()


def test_faulty_files_are_refused(spark, tmp_path):
    (tmp_path / "vocab.json").write_text('{"0": "a", "1": ')
    with pytest.raises(Exception):
        tokenizer_files.load_vocab(spark, f"{tmp_path}/vocab.json").collect()
    two = tmp_path / "two"
    two.mkdir()
    for name in "ab":
        (two / name).write_text("a b\n")
    with pytest.raises(ValueError):
        tokenizer_files.load_gpt2_merges(spark, str(two))
    packed = tmp_path / "packed.txt.bz2"  # split among tasks
    packed.write_bytes(bz2.compress(b"a<|endoftext|>b"))
    with pytest.raises(ValueError):
        corpus.delimiter_counts(spark, str(packed))


def test_equal_bytes_keep_the_last_id(spark, tmp_path):
    vocab = spark.createDataFrame([(0, "61", 0), (1, "62", 1), (2, "61", 2)], "token_id int, token_hex string, ins_order int")
    tokenizer_files.save_gpt2_vocab(vocab, f"{tmp_path}/vocab")
    got = tokenizer_files.load_gpt2_vocab(spark, f"{tmp_path}/vocab").collect()
    assert {(r["token_id"], r["token_hex"]) for r in got} == {(1, "62"), (2, "61")}


def test_rejected_entries_are_listed(spark, tmp_path):
    (tmp_path / "vocab.json").write_text(json.dumps({"0": "a", "x": "b", "2": "b'oops"}))
    bad = tokenizer_files.parsed_vocab(spark, f"{tmp_path}/vocab.json").where("token_id is null or token_hex is null")
    assert [r["key"] for r in bad.orderBy("pos").collect()] == ["x", "2"]
    (tmp_path / "merges.txt").write_text("a b\n\na b c\nd\nab c\n")
    bad = tokenizer_files.parsed_gpt2_merges(spark, f"{tmp_path}/merges.txt").where("l is null")
    assert [r["line"] for r in bad.orderBy("line_no").collect()] == ["a b c", "d"]


def test_tokenizer_comes_back_from_its_files(spark, tmp_path):
    tok = tokenizer_of(spark, [("74", "68"), ("20", "7468"), ("C3", "A9")], SPECIALS)
    docs = spark.createDataFrame([(1, f"then the {SPECIALS[0]} th\u00e9 \u00fc"), (2, "")], "doc_id int, text string")
    want = sorted(map(str, tok.encode(docs).collect()))
    tok.save(str(tmp_path / "tables"))
    found = [Tokenizer.load(spark, str(tmp_path / "tables"))]
    for gpt2 in (False, True):
        paths = [str(tmp_path / f"{name}-{gpt2}") for name in ("vocab.json", "merges.txt")]
        tok.save_files(*paths, gpt2=gpt2)
        found.append(Tokenizer.from_files(spark, *paths, SPECIALS, gpt2=gpt2))
    for other in found:
        assert sorted(map(str, other.encode(docs).collect())) == want


def test_training_leaves_no_work_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pairloom.session.shared_dir", lambda _: str(tmp_path))
    train_bpe(spark.createDataFrame([("then the thing",)], "text string"), 260)
    assert list(tmp_path.iterdir()) == []


def test_stream_counts_are_compacted(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    source, path = str(tmp_path / "source"), str(tmp_path / "counts")
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet

    def arrive(part):
        docs.where(F.col("doc_id") % 4 == part).coalesce(1).write.mode("append").parquet(source)
        pretoken_counts_stream(stream(source), path).awaitTermination()

    def same(parts):
        want = pretoken_counts(docs.where(F.col("doc_id") % 4 < parts))
        got = merge_stream_counts(spark, path)
        return got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()

    for part in range(3):
        arrive(part)
    assert same(3)
    assert compact_stream_counts(spark, path) == 1 and same(3)
    assert compact_stream_counts(spark, path) is None
    arrive(3)
    assert compact_stream_counts(spark, path) == 2 and same(4)
    left = sorted(p.name for kind in ("parts", "base") for p in (tmp_path / "counts" / kind).iterdir())
    assert left == ["batch_id=2", "batch_id=3", "upto=1", "upto=2"]
    # the last batch is run again, and a compaction was cut off
    spark.read.parquet(f"{path}/parts/batch_id=3").write.parquet(str(tmp_path / "copy"))
    again = spark.read.parquet(str(tmp_path / "copy"))
    again.write.mode("overwrite").parquet(f"{path}/parts/batch_id=3")
    again.limit(1).write.parquet(f"{path}/base/upto=9")
    (tmp_path / "counts/base/upto=9/_SUCCESS").unlink()
    assert same(4)
