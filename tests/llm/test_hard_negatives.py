"""Hard negatives against scoring every row for every anchor."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from pairloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<float>, anchor_id int, score string"


def by_hand(rows, every=50):
    kept = {}
    for i, label, vector, *_ in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        row = ((label + 1) % 10 if i % 7 == 0 else label, whole)
        kept[i] = min(kept.get(i, row), row)
    out = []
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scores = defaultdict(list)
        for b, (other, w) in kept.items():
            if a != b:
                scores[other == label].append((-sum(x * y for x, y in zip(v, w)), b))
        for ps, p in sorted(scores[True])[:5]:
            fit = [(-s, b) for s, b in sorted(scores[False]) if 50 * -ps <= 100 * -s <= 95 * -ps]
            out += [(a, p, k, b, -ps, s) for k, (s, b) in enumerate(fit[:3], 1)]
    return sorted(out)


def vectors(rng, n, dim, spread=1.0, centres=3):
    middle = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(centres)]
    return [[m + spread * rng.gauss(0, 1) for m in rng.choice(middle)] for _ in range(n)]


def result(spark, rows, **options):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    got = hn.hard_negatives(table, **options).collect()
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in got)


@pytest.mark.parametrize("seed,spread,block,group", [(1, 1.0, 8192, 512), (2, 0.05, 100, 16), (3, 0.3, 64, 4)])
def test_equals_scoring_all(spark, monkeypatch, seed, spread, block, group):
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "GROUP", group)
    rng = random.Random(seed)
    rows = [(i, rng.choice([0, 1, 1, 1, 2, 9]), v) for i, v in enumerate(vectors(rng, 500, 8, spread), -100)]
    rows += [(1000 + i, rng.randrange(3), rows[7][2]) for i in range(120)]  # equal vectors, many ties
    rows += [(None, 1, [1.0] * 8), (2000, None, [1.0] * 8), (2050, 1, None), (2100, 1, [1.0, None]), (2150, 2, [float("nan")] * 8)]
    rows += [(2200, 1, []), (2250, 2, [0.5, 2.0]), (2251, 1, [float("inf")]), rows[150], rows[151], (50, 5, [3.0] * 8), (2300, 1, [0.0] * 8)]
    got = result(spark, rows, every=10)
    assert got == by_hand(rows, 10) and len(got) > 100


def test_few_rows_empty_tables_and_large_numbers(spark):
    assert result(spark, []) == [] and result(spark, [(1, 1, [1.0])]) == [] and result(spark, [(50, 1, [1.0]), (51, 1, [2.0])]) == []
    rows = [(0, 0, [2.0**20, 1.0]), (1, 1, [2.0**19, 3.0]), (2, 2, [2.0**18, 5.0]), (50, 1, [2.0**18 + 4, -2.0**19])]
    rows += [(i, 3 + i % 2, [2.0**18 + i * 64, float(i)]) for i in range(100, 140)]
    got = result(spark, rows)
    assert got == by_hand(rows) and len(got) > 2
    with pytest.raises(Exception, match="2\\^62"):
        result(spark, [(0, 0, [2.0**60]), (1, 1, [2.0**60])])


def test_spanning_tree_is_the_least():
    rng = np.random.default_rng(4)
    v = rng.integers(-50, 50, (40, 5))
    order, parent = hn.spanning_tree(v)
    assert sorted(order) == list(range(40)) and parent[0] == -1 and all(parent[i] < i for i in range(1, 40))
    dist = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    total = sum(dist[order[i], order[parent[i]]] for i in range(1, 40))
    joined, kruskal = list(range(40)), 0.0
    for d, i, j in sorted((dist[i, j], i, j) for i in range(40) for j in range(i)):
        if joined[i] != joined[j]:
            kruskal += d
            joined = [joined[j] if c == joined[i] else c for c in joined]
    assert total == pytest.approx(kruskal)


def test_bounds_spare_rows_where_anchors_are_near():
    rng = np.random.default_rng(5)
    base = rng.normal(0, 100, 16)
    anchors = np.floor(base + rng.normal(0, 2, (50, 16)))
    rows = np.floor(rng.normal(0, 100, (2000, 16)))
    order, parent = hn.spanning_tree(anchors)
    tree, scores = anchors[order], rows @ anchors[order].T
    least = np.quantile(scores, 0.99, axis=0)
    rescored = 0
    for place, at, exact in hn.walk(rows, tree, parent, lambda p, low, high: high >= least[p]):
        assert set(np.flatnonzero(scores[:, place] >= least[place])) <= set(at)
        assert (exact == scores[at, place]).all()
        rescored += len(at)
    assert rescored < 0.1 * rows.shape[0] * len(tree)
