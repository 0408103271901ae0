import random
import time

import brute
from pyspark.sql import functions as F

from pairloom.functions.symbols import pair_list, symbol_list, symbol_word
from pairloom.functions.text import hex_to_text, lenient_decode, pretokens, segments

D = "<|endoftext|>"
ODD = [
    "",
    " ",
    "\n\n\n",
    "a  b   c    ",
    "I'll we've they're it's don't 's 'x",
    "x　　y   z  w\u0085\u0085v",
    "\x1c\x1d\x1e\x1f a\x0b\x0c\r\nb",
    "naïve café 日本語テキスト ١٢٣ 🙃🙃!! ½²",
    "aaaa 1234abc -- ==a== \t\t\tend",
    "é́ ​‍ x﻿y",
    f"{D}{D} a  {D}  b{D}",
    f"  {D}",
    "<|endoftext|",
]


def rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def column(df, col):
    return [r[1] for r in sorted(df.select("id", col.alias("x")).collect())]


def test_pretokens_equal_the_regex_module(spark):
    assert column(rows(spark, ODD), pretokens(F.col("text"))) == [brute.pretokens(t) for t in ODD]


def test_pretokens_on_random_text(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab1 '\n\t.　 é'sll<|>", k=rng.randint(0, 60))) for _ in range(400)]
    assert column(rows(spark, texts), pretokens(F.col("text"))) == [brute.pretokens(t) for t in texts]


def test_pretokens_with_overlapping_specials(spark):
    specials = [D, D + D, "ab", "a", ".*", " x"]
    rng = random.Random(2)
    pieces = [*specials, " ", "b", "  ", "\n", "!", "ax", "."]
    texts = ODD + ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(300)]
    got = column(rows(spark, texts), pretokens(F.col("text"), specials))
    assert got == [brute.pretokens(t, specials) for t in texts]


def test_segments_keep_specials_and_drop_empty_parts(spark):
    texts = [f"{D}{D}a{D}", "", "plain"]
    got = column(rows(spark, texts), segments(F.col("text"), [D, D + D]))
    assert got == [[D + D, "a", D], [], ["plain"]]


def test_null_text_is_empty(spark):
    df = spark.createDataFrame([(0, None)], "id int, text string")
    assert column(df, pretokens(F.col("text"), [D])) == [[]]


def test_lenient_decode_drops_what_python_drops(spark):
    rng = random.Random(3)
    lead = [0x41, 0x80, 0xBF, 0xC2, 0xC3, 0xE0, 0xE2, 0x82, 0xED, 0xA0, 0xEF, 0xBD, 0xF0, 0x9F, 0x98, 0xF4, 0xFF]
    data = [bytes(rng.choices(lead, k=rng.randint(0, 12))) for _ in range(1000)]
    data += ["� ok �".encode(), "�".encode() + b"\xff" + "é�".encode(), b""]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(data)], "id int, b binary")
    assert column(df, lenient_decode(F.col("b"))) == [b.decode("utf-8", "ignore") for b in data]


def test_hex_to_text_replaces_like_python(spark):
    rng = random.Random(4)
    lead = [0x41, 0x80, 0xBF, 0xC2, 0xC3, 0xE0, 0xE2, 0x82, 0xED, 0xA0, 0xEF, 0xBD, 0xF0, 0x9F, 0x98, 0xF4, 0xFF]
    data = [bytes(rng.choices(lead, k=rng.randint(0, 12))) for _ in range(1000)]
    df = spark.createDataFrame([(i, b.hex()) for i, b in enumerate(data)], "id int, h string")
    assert column(df, hex_to_text(F.col("h"))) == [b.decode("utf-8", "replace") for b in data]


def test_symbols_and_pairs(spark):
    texts = ["aaa", "é\n", "a", "", "🙃"]
    df = rows(spark, texts)
    word = symbol_word(F.col("text"))
    latin = [t.encode().decode("latin-1") for t in texts]
    assert column(df, word) == latin
    assert column(df, symbol_list(word)) == [list(w) for w in latin]
    assert column(df, pair_list(word)) == [[w[i : i + 2] for i in range(len(w) - 1)] for w in latin]


def test_symbols_beyond_the_basic_plane(spark):
    words = ["\U00010400퟿", "\U0010ffff"]
    df = rows(spark, words)
    assert column(df, symbol_list(F.col("text"))) == [list(w) for w in words]
    assert column(df, F.transform(symbol_list(F.col("text")), lambda s: F.ascii(s))) == [
        [ord(c) for c in w] for w in words
    ]


def test_special_tries_take_the_longest(spark):
    rng = random.Random(8)
    for alphabet, n in (("ab", 12), ("<|>ab.é*", 40), ("abcdefghijklmnopqrstuvwxyz\U0001f600水", 60)):
        specials = list({"".join(rng.choices(alphabet, k=rng.randint(1, 5))) for _ in range(n)})
        texts = ["".join(rng.choices(alphabet + " z", k=rng.randint(0, 30))) for _ in range(60)]
        df = spark.createDataFrame([(t,) for t in texts], "text string")
        got = [r[0] for r in df.select(pretokens(F.col("text"), specials)).collect()]
        assert got == [brute.pretokens(t, specials) for t in texts]


def test_cost_does_not_grow_with_the_number_of_specials(spark):
    """2,000 specials against 20, in texts that hold them and texts that nearly do."""
    rng = random.Random(9)
    many = [f"<|special_{i}|>" for i in range(1000)] + [chr(0x4E00 + i) + "!" for i in range(1000)]
    words = ["plain", "<|special_", "<|spec", many[3], many[5], chr(0x4E03), "水"]
    texts = [(" ".join(rng.choices(words, k=400)),) for _ in range(400)]
    df = spark.createDataFrame(texts, "text string").repartition(4).cache()
    want = [brute.pretokens(t, many) for (t,) in texts[:3]]
    assert [r[0] for r in spark.createDataFrame(texts[:3], "text string").select(pretokens(F.col("text"), many)).collect()] == want
    df.count()

    def seconds(specials):
        found = df.select(F.explode(pretokens(F.col("text"), specials)))
        best = 1e9
        for _ in range(3):
            start = time.perf_counter()
            found.write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        return best

    assert seconds(many) < 4 * seconds(many[:20]) + 0.3
