"""Quality rules: counts and cutoffs against plain Python, and the bound they promise."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from pairloom.llm import quality_rules as qr

SPACES = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, lang string, text string, stratum string, n_words int"


def split(text):
    return "".join(" " if c in SPACES else c for c in text or "").split(" ")


def values_by_hand(text):
    words = [w for w in split(text) if w]
    lines = [line for line in (text or "").split("\n") if line.strip(SPACES)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 8))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return (len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(covered))


def passes(rule, v, cutoff):
    """Whether the values are over the cutoff, by the rule's name."""
    n_words, chars, symbols, lines, dup, repeat = v
    value = {
        "few_words": -n_words,
        "long_words": 100 * chars // n_words,
        "short_words": -(100 * chars // n_words),
        "symbols": 10000 * symbols // n_words,
        "dup_lines": 10000 * dup // lines,
        "repeats": 10000 * repeat // n_words,
    }
    return value[rule.name] > cutoff


def tail(n, k, p):
    p = Fraction(str(p))
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def judged_by_hand(rows, labels, alpha, delta):
    good = {}
    for i, label in labels:
        if i is not None and label is not None:
            good[i] = min(good.get(i, 1), label)
    base = lambda v: v[0] < 20 or 100 * v[5] > 30 * v[0]
    known = defaultdict(dict)
    for i, lang, text in rows:
        v = values_by_hand(text)
        if i in good and not base(v):
            known[lang][i] = min(known[lang].get(i, v), v)
    side = lambda i: hashlib.md5(str(i).encode()).hexdigest()[0] < "8"
    tested = {lang for lang, found in known.items() if any(side(i) and good[i] for i in found)}
    chosen = {}
    for lang in tested:
        fit = {i: v for i, v in known[lang].items() if not side(i)}
        hold = [v for i, v in known[lang].items() if side(i) and good[i]]
        n = Counter(good[i] for i in fit)
        ladder = []
        for r, rule in enumerate(qr.RULES):
            for place, cutoff in enumerate(rule.cutoffs):
                hit = Counter(good[i] for i, v in fit.items() if passes(rule, v, cutoff))
                if hit[0] * n[1] > hit[1] * n[0]:
                    ladder.append((-(1_000_000 * hit[0] // (hit[0] + hit[1])), -hit[0], r, place))
        stands = []
        for _, _, r, place in sorted(ladder):
            step = [*stands, (qr.RULES[r], qr.RULES[r].cutoffs[place])]
            k = sum(any(passes(rule, v, c) for rule, c in step) for v in hold)
            if tail(len(hold), k, alpha) > delta / len(tested):
                break
            stands = step
        chosen[lang] = stands
    out = []
    for i, lang, text in rows:
        v = values_by_hand(text)
        failed = base(v)
        kept = not failed and not any(passes(rule, v, c) for rule, c in chosen.get(lang, ()))
        out.append((i is None, i or 0, lang or "", *v, failed, kept))
    return sorted(out), chosen


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    words = [f"w{'ab' * rng.randint(0, 3)}{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1600):
        lang = rng.choice(["en", "en", "en", "fr", None, "rare" if i < 30 else "fr"])
        text = " ".join(rng.choices(words, k=rng.randint(15, 120)))
        bad = rng.random() < 0.25
        if bad and lang != "fr":
            text += " # % |" * rng.randint(0, 12)
        if bad and lang == "fr":
            text += "\nsame line here" * rng.randint(0, 6)
        if rng.random() < 0.02:
            text += " $$$ some price"
        rows.append((i, lang, text))
        if i < 1500:
            labels.append((i, int(not bad)))
    rows += [(2000, "en", None), (2001, "en", ""), (2002, "fr", " \n\t "), (2003, "en", "a b c d e f g h " * 9), (2004, "fr", "é" * 70_000)]
    rows += [(2005, None, "x " * 300_000), rows[3], (None, "en", "no id " * 12), (2006, "xx", " ".join(words[:40]) + " # # # #")]
    labels += [(5, 0), (5, None), (None, 0), (9999, 1), (2001, 0)]
    return rows, labels


def test_equals_plain_python(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame([(i, lang, t, "s", 0) for i, lang, t in rows], SCHEMA).repartition(5)
    table = spark.createDataFrame(labels, "doc_id long, good int")
    want, chosen = judged_by_hand(rows, labels, 0.05, 0.1)
    got = qr.judge(docs, table, alpha=0.05, delta=0.1).collect()
    found = [(r["doc_id"] is None, r["doc_id"] or 0, r["stratum"] or "", *[r[v] for v in qr.VALUES], r["base_failed"], r["kept"]) for r in got]
    assert sorted(found) == want
    assert {"en", "fr", None} <= set(chosen) and all(chosen[s] for s in ("en", "fr")) and chosen["en"] != chosen["fr"]
    assert any(not w[-2] and not w[-1] for w in want)


def test_binomial_bound_is_exact():
    for n, alpha, level in [(0, 0.02, 0.01), (10, 0.02, 0.01), (300, 0.02, 0.0125), (50, 0.3, 0.05)]:
        k = qr.most_rejections(n, alpha, level)
        assert k == max([j for j in range(n + 1) if tail(n, j, alpha) <= level], default=-1)


def test_false_rejections_stay_below_the_bound():
    """Labels without any meaning: cutoffs that reject more than alpha are chosen in few trials only."""
    rng, alpha, delta, broken, trials = random.Random(1), 0.1, 0.1, 0, 400
    for _ in range(trials):
        rate = [0.02, 0.06, 0.1, 0.101, 0.2]  # true rejection rates of the steps
        n = 200
        draws = [rng.random() for _ in range(n)]
        most = qr.most_rejections(n, alpha, delta)
        stands = 0.0
        for r in rate:
            if sum(d < r for d in draws) > most:
                break
            stands = r
        broken += stands >= alpha
    assert broken <= delta * trials * 1.3


def test_no_labels_no_documents_and_too_many_strata(spark, corpus, monkeypatch):
    rows, labels = corpus
    docs = spark.createDataFrame([(i, lang, t, "s", 0) for i, lang, t in rows[:50]], SCHEMA)
    table = spark.createDataFrame(labels, "doc_id long, good int")
    none = qr.judge(docs, table.limit(0))
    assert none.where("kept = base_failed").count() == 0 and none.count() == 50
    assert qr.judge(docs.limit(0), table).count() == 0
    whole = qr.judge(docs, table, stratum=None)
    assert whole.where(F.col("stratum") != "").count() == 0
    monkeypatch.setattr(qr, "MAX_STRATA", 2)
    with pytest.raises(ValueError, match="strata"):
        qr.judge(docs, table)
