"""Spelling variants against a comparison of all words."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairloom.llm import spelling

LETTERS = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | {chr(c) for c in range(0xC0, 0x100)}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def by_hand(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, n, len(near[w]), form.get(w), counts.get(form.get(w)), root))
    return out


def words_by_hand(rows):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c in LETTERS:
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                at = h % len(run)
                counts[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
            run = ""
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def result(df):
    return {(r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


@pytest.mark.parametrize("alphabet,n", [("ab", 150), ("abcéÿ", 250), ("abcdefghijklmnop", 200), ("a", 12)])
def test_near_words_equal_comparison_of_all(spark, alphabet, n):
    rng = random.Random(n)
    words = {"".join(rng.choices(alphabet, k=rng.randint(5, 8))) for _ in range(n)}
    for w in list(words):
        i = rng.randrange(len(w))
        words |= {w[:i] + w[i + 1 :], w[:i] + rng.choice(alphabet) + w[i:], w[:i] + rng.choice(alphabet) + w[i + 1 :]}
    counts = {w: rng.choice([3, 4, 6, 9, 12, 40, 90]) for w in words if len(w) >= 5}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.group_variants(table)
    assert got.count() == len(counts)
    assert result(got) == by_hand(counts)


def test_pivots_are_the_lightest_bigrams_apart(spark):
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abcd", k=rng.randint(5, 9))) for _ in range(120)})
    rows = spelling.prefixes(spark.createDataFrame([(w, 3) for w in words], "word string, n long")).collect()
    assert len(rows) == len(words)
    holds = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
    for r in rows:
        grams = sorted((holds[r["word"][i : i + 2]], r["word"][i : i + 2], i) for i in range(len(r["word"]) - 1))
        prefix, pivots = [tuple(x) for x in r["prefix"]], [tuple(x) for x in r["pivots"]]
        assert prefix == grams[:3] and set(pivots) <= set(prefix)
        weights = [a[0] + b[0] for a in prefix for b in prefix if b[2] - a[2] >= 2]
        assert pivots[1][2] - pivots[0][2] >= 2 and pivots[0][0] + pivots[1][0] == min(weights)


def test_words_of_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(None, "Wörter wörter WöRTER words"), (5, None), (6, ""), (7, "×÷ abcdeĀfghij " * 4), rows[0], (8, "longword" * 40_000)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, word string, n string")
    got = spelling.word_counts(spelling.noisy_runs(docs.repartition(5)))
    want = words_by_hand(rows)
    assert {r["word"]: r["n"] for r in got.collect()} == want and len(want) > 1000
    assert any(len(w) > 0 and "×" in w for w in want) or "×÷" not in want


def test_chains_ties_and_empty_tables(spark):
    chain = [("aaaaa", 3), ("aaaab", 6), ("aaabb", 12), ("aabbb", 24), ("abbbb", 48), ("zzzzz", 7), ("zzzzy", 14), ("zzzzx", 14)]
    got = {r["word"]: r for r in spelling.group_variants(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert {got[w]["root"] for w, _ in chain[:5]} == {"abbbb"}
    assert got["aaaaa"]["form"] == "aaaab" and got["zzzzz"]["form"] == "zzzzx" and got["zzzzx"]["form"] is None
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(nothing).count() == 0
    one = spark.createDataFrame([(1, "alone alone alone")], "doc_id long, text string")
    assert spelling.spelling_variants(one).where(F.col("root") == F.col("word")).count() == 1
