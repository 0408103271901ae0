import random

import brute
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.operators import decode, encode, vocab
from pairloom.operators.batches import SLICE_VALUES
from pairloom.plans.tokenizer import Tokenizer, merge_table

D = "<|endoftext|>"


def build(spark, tokens, merges, specials=()):
    rows = [(i, t.hex().upper(), n) for n, (i, t) in enumerate(tokens.items())]
    table = spark.createDataFrame(rows, "token_id int, token_hex string, ins_order int")
    return Tokenizer.build(table, merge_table(spark, brute.hexes(merges)), specials)


def rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(2)


def ids(tok, df):
    return [r[1] for r in sorted(tok.encode(df).select("id", "ids").collect())]


SONG = [D.encode(), b"s", b"o", b"n", b"g", b" ", b"on", b"son", b" s"]
SONG_MERGES = [(b"o", b"n"), (b"s", b"on"), (b" ", b"s")]


def test_ids_worked_out_by_hand(spark):
    tok = build(spark, dict(enumerate(SONG)), SONG_MERGES, [D])
    texts = ["songs so", f"on{D} no", f"x{D}{D}", ""]
    assert ids(tok, rows(spark, texts)) == [[7, 4, 1, 8, 2], [6, 0, 5, 3, 2], [0, 0], []]


def test_long_words_fold_like_short_ones():
    rng = random.Random(3)
    for size in (3, 40, 100_000):
        word = "".join(rng.choice("abc") for _ in range(size))
        rules = ["abx", "xcy", "aaz", "zay", "abw", "yxv", "ccc"[:2] + "u"]
        want = word
        for rule in rules:
            want = want.replace(rule[:2], rule[2])
        assert encode.fold_word(word, rules, encode.rule_ranks(rules)) == want


def test_merges_apply_in_list_order(spark):
    tokens = dict(enumerate([*(bytes([b]) for b in range(256)), b"ab", b"abc", b"aa", b"bc"]))
    texts = ["abc", "aaaaa", "abcabc", "ab" * 700]
    for merges in (
        [(b"ab", b"c"), (b"a", b"b")],
        [(b"a", b"b"), (b"ab", b"c"), (b"a", b"b")],
        [(b"a", b"bc"), (b"b", b"c"), (b"a", b"bc"), (b"a", b"a")],
    ):
        got = ids(build(spark, tokens, merges), rows(spark, texts))
        assert got == [brute.encode(t, tokens, merges) for t in texts]


def test_random_merge_lists_gaps_and_specials(spark):
    for seed in range(6):
        rng = random.Random(seed)
        alphabet = "abé \n"
        parts = [bytes([b]) for b in sorted(set(alphabet.encode()))]
        merges = []
        for _ in range(15):
            pair = (rng.choice(parts), rng.choice(parts))
            merges.append(pair)
            parts.append(pair[0] + pair[1])
        rng.shuffle(merges)
        tokens = {i * 3: t for i, t in enumerate(dict.fromkeys(parts)) if rng.random() < 0.7}
        specials = [D, "ab", D + D]
        tok = build(spark, tokens, merges, specials)
        for s in specials:
            if s.encode() not in tokens.values():
                tokens[max(tokens) + 1] = s.encode()
        texts = ["".join(rng.choices([*alphabet, D], k=rng.randint(0, 30))) for _ in range(60)]
        assert ids(tok, rows(spark, texts)) == [brute.encode(t, tokens, merges, specials) for t in texts]


def test_last_entry_wins_for_equal_bytes(spark):
    tok = build(spark, {7: b"a", 3: b"b", 2: b"a"}, [])
    assert ids(tok, rows(spark, ["aba"])) == [[2, 3, 2]]


def test_rows_words_and_arrays_agree(spark):
    tokens = dict(enumerate([*(bytes([b]) for b in range(256)), b"th", b"the"]))
    merges = [(b"t", b"h"), (b"th", b"e")]
    tok = build(spark, tokens, merges)
    texts = ["the other thing", "bathe", "é"]
    want = [brute.encode(t, tokens, merges) for t in texts]
    got = tok.encode_rows(rows(spark, texts), "id").orderBy("id", "pos").collect()
    assert [tuple(r) for r in got] == [(i, p, t) for i, w in enumerate(want) for p, t in enumerate(w)]
    counts = spark.createDataFrame([(" the", 2), ("é", 1)], "pretoken string, n long")
    words = {r["pretoken"]: (r["n"], r["symbols"], r["ids"]) for r in tok.encode_words(counts).collect()}
    assert words == {" the": (2, "|20|746865|", [32, 257]), "é": (1, "|C3|A9|", [195, 169])}


def test_decode_joins_bytes_before_reading_them(spark):
    tok = build(spark, {0: b"\xc3", 1: b"\xa9", 2: b"x"}, [])
    df = spark.createDataFrame([(0, [0, 1, 2, 9]), (1, [0, 2]), (2, []), (3, [-1])], "id int, ids array<int>")
    assert [r[1] for r in sorted(tok.decode(df).select("id", "text").collect())] == ["éx", "�x", "", ""]
    far = build(spark, {-5: b"\xc3", 2_000_000_000: b"\xa9"}, [])
    df = spark.createDataFrame([(0, [-5, 2_000_000_000, 7])], "id int, ids array<int>")
    assert far.decode(df).first()["text"] == "é"


def test_decode_rows_and_unknown_ids(spark):
    tok = build(spark, {0: b"\xc3", 1: b"\xa9", 2: b"x"}, [])
    tokens = spark.createDataFrame(
        [(1, 0, 0), (1, 1, 1), (1, 2, 8), (2, 0, 2), (2, 1, 8)], "id int, pos int, token_id int"
    )
    assert {tuple(r) for r in decode.decode_rows(tokens, "id", tok.vocab).collect()} == {(1, "é"), (2, "x")}
    assert [tuple(r) for r in decode.unknown_ids(tokens, tok.vocab).collect()] == [(8, 2)]


def test_roundtrip_with_all_bytes(spark):
    tokens = dict(enumerate([*(bytes([b]) for b in range(256)), b" t", b"he"]))
    tok = build(spark, tokens, [(b" ", b"t"), (b"h", b"e")], [D])
    texts = ["", "q", "🐢", "Wohin, kleine Maus?", "Ça va, señor 🐢?", f"naïve {D} the{D}{D} œuf\n\n", "\0\x7f\x80ÿ"]
    encoded = tok.encode(rows(spark, texts))
    assert tok.decode(encoded, to="back").where("NOT text <=> back").count() == 0


def test_added_specials(spark):
    empty = build(spark, {}, [], ["b", "a", "b"])
    assert sorted((r["token_id"], r["token_hex"]) for r in empty.vocab.collect()) == [(0, "62"), (1, "61")]
    some = build(spark, {5: b"a", 9: b"z"}, [], ["q", "a", "r"])
    got = {r["token_hex"]: r["token_id"] for r in some.vocab.collect()}
    assert got == {"61": 5, "7A": 9, "71": 10, "72": 11}
    with pytest.raises(ValueError):
        build(spark, {}, [], [""])


def test_special_counts_and_list(spark):
    tok = build(spark, {0: b"x"}, [], [D])
    df = tok.encode(rows(spark, [f"x{D}{D}", "x"]))
    assert [r[0] for r in df.orderBy("id").select(encode.special_counts("ids", 1)).collect()] == [2, 0]
    assert [tuple(r) for r in vocab.special_list(df, "text", ["x", D]).collect()] == [(0, "x", 2), (1, D, 1)]


def test_encoding_needs_no_shuffle(spark):
    tok = build(spark, dict(enumerate(SONG)), SONG_MERGES, [D])
    df = spark.range(10).select(F.col("id").cast("string").alias("text"))
    plan = tok.decode(tok.encode(df), to="back")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_many_specials_and_many_gaps(spark):
    specials = [f"<|{i}|>" for i in range(60)]
    merges = [(bytes([a]), bytes([b])) for a in b"abcdefgh" for b in b"abcdefgh"]
    tokens = dict(enumerate([*(bytes([b]) for b in b"abcdefg \0"), b"ab"]))
    tok = build(spark, tokens, merges, specials)
    tokens |= {len(tokens) + i: s.encode() for i, s in enumerate(specials)}
    rng = random.Random(9)
    texts = ["".join(rng.choices([*"abcdefgh \0", *specials[:5]], k=25)) for _ in range(40)]
    assert ids(tok, rows(spark, texts)) == [brute.encode(t, tokens, merges, specials) for t in texts]
    counts = spark.createDataFrame([("cdab", 1)], "pretoken string, n long")
    assert tok.encode_words(counts).first()["ids"] == [2, 3, 9]


def test_short_and_long_words_fold_alike():
    rng = random.Random(5)
    symbols = "abcuvwxyz"
    for _ in range(400):
        rules = [rng.choice(symbols) + rng.choice(symbols) + rng.choice(symbols) for _ in range(8)]
        want = word = "".join(rng.choice("abc") for _ in range(rng.randint(0, encode.SHORT_WORD + 8)))
        for rule in rules:
            want = want.replace(rule[:2], rule[2])
        assert encode.fold_word(word, rules, encode.rule_ranks(rules)) == want


def test_a_large_batch_is_encoded_in_parts(spark):
    words = ["ab", " ", "ba"] * 10
    batch = pa.array([words] * 20_000 + [[], None, words], pa.list_(pa.string()))
    tok = build(spark, {0: b"a", 1: b"b", 2: b" ", 3: b"ab"}, [(b"a", b"b")])
    encoder = encode.Encoder(tok.merge_list, tok.token_ids, [])
    ids_of = {c: [i] for c, i in encoder.id_of.items()}
    parts = list(encode._arrow_ids(encoder.rules, ids_of, {}).func(iter([batch])))
    assert max(len(p.values) for p in parts) <= 2 * SLICE_VALUES < sum(len(p.values) for p in parts)
    want = [3, 2, 1, 0] * 10
    assert [x for p in parts for x in p.to_pylist()] == [want] * 20_000 + [[], [], want]


def test_a_large_batch_is_decoded_in_parts(spark):
    rows = [[0, 1, 7, None, 2]] * 120_000 + [[], None, [0, 2], [-1, 2]]
    batch = pa.array([[9], *rows], pa.list_(pa.int32())).slice(1)
    decoded = decode._arrow_text({0: b"\xc3", 1: b"\xa9", 2: b"x"}).func
    parts = list(decoded(iter([batch])))
    assert max(map(len, parts)) <= SLICE_VALUES // 4 < len(rows)
    assert [x for p in parts for x in p.to_pylist()] == ["éx"] * 120_000 + ["", "", "�x", "x"]


def test_decode_rows_in_any_order_with_null_and_repeated_keys(spark):
    tok = build(spark, {i: bytes([b]) for i, b in enumerate(b"abcdefgh")}, [])
    rows = [("x", p, p % 8) for p in range(50)] + [("y", 7, 3), ("y", None, 2), ("y", 7, 1), ("y", 2, None), ("y", 1, 0)]
    rows += [(None, 1, 5), (None, 0, 4), ("z", 0, 99), ("x", 3, 0), ("x", 3, 7)]
    random.Random(2).shuffle(rows)
    tokens = spark.createDataFrame(rows, "id string, pos int, token_id int").repartition(3)
    want = {}
    for k, p, t in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] is not None, r[2] or 0)):
        want[k] = want.get(k, "") + ("abcdefgh"[t] if t is not None and t < 8 else "")
    assert {r["id"]: r["text"] for r in decode.decode_rows(tokens, "id", tok.vocab).collect()} == want


def test_decode_rows_shuffles_runs_not_tokens(spark):
    keys = pa.array([1, 1, 1, None, None, 2, 1, 1], pa.int64())
    batch = pa.RecordBatch.from_arrays([keys, pa.array(range(8), pa.int32()), pa.array(range(8), pa.int32())], names=["k", "p", "t"])
    (got,) = decode._runs(iter([batch]))
    assert [c.to_pylist() for c in got.columns] == [[1, None, 2, 1], [[0, 1, 2], [3, 4], [5], [6, 7]], [[0, 1, 2], [3, 4], [5], [6, 7]]]
