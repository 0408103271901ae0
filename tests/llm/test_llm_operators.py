"""The training-data operators against plain Python, on small tables with nulls, ties and repeats."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pairloom.llm import (
    common,
    decontaminate,
    exact_dedup,
    html_text,
    ngram_join,
    packing,
    quality,
    sharding,
    substring_dedup,
    toxicity,
    url_filter,
    windows,
)
from pairloom.llm.common import BATCH_BYTES, WordHasher, components, stored
from pairloom.session import list_folder, shared_dir

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, file string, row int"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def phrase(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """(doc_id, text): copies, near copies, shared passages, nulls, empty, long, repeated rows."""
    rng = random.Random(5)
    passage = phrase(rng, 60)
    texts = [None, "", " \t\n", "one", "One two", "a b c", "A  b\nc", "a b c d"]
    base = [phrase(rng, rng.choice([20, 80, 150])) for _ in range(12)]
    texts += base + base[:4] + [t + " extra" for t in base[:6]] + [t.replace(" ", "  ") for t in base[2:5]]
    texts += [phrase(rng, 10) + " " + passage + " " + phrase(rng, 15) for _ in range(8)]
    texts += [" ".join(t.split()[:5] + ["new"] + t.split()[6:]) for t in base]
    texts.append(phrase(rng, 4000))
    out = list(enumerate(texts))
    rng.shuffle(out)
    return out + [out[3], out[9], (None, "no id here"), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, "d", "f", 1) for i, t in rows], DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_word_hasher_keeps_words_apart_and_slices_long_texts():
    hasher = WordHasher()
    texts = [b"", b" a  b ", "é a".encode(), b"x" * 10, b"a " * BATCH_BYTES]
    got = hasher.each(texts)
    assert [len(g) for g in got] == [len(t.split()) for t in texts]
    assert got[1][0] == got[2][1] == got[4][0] and len(set(got[4])) == 1
    assert [len(g) for g in hasher.each(texts[:4])] == [0, 2, 2, 1]


def test_components(spark):
    links = [(5, 9), (9, 2), (7, 8), (1, 1), (8, 7), (20, 21), (21, 22), (22, 23), (23, 24)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {5: 2, 9: 2, 2: 2, 7: 7, 8: 7, **dict.fromkeys((20, 21, 22, 23, 24), 20)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_hypergeometric_matrix():
    counts, cells = np.array([5, 0, 12, 30]), sharding.cell_table(47, 3, 4)[:, 2]
    whole = np.array([sharding.matrix_row(counts, cells, p, 1) for p in range(4)])
    assert (whole.sum(1) == counts).all() and (whole.sum(0) == cells).all()
    mean = np.mean([sharding.matrix_row(np.array([20, 20]), np.array([10, 30]), 0, s) for s in range(400)], axis=0)
    assert abs(mean[0] - 5) < 0.4
    rng = np.random.default_rng(3)
    large = [sharding.hypergeometric(rng, 2 * 10**9, 6 * 10**9, 1000) for _ in range(300)]
    assert abs(np.mean(large) - 250) < 5 and 8 < np.std(large) < 20


def test_sharding(spark, docs, nothing, rows):
    out = sharding.shuffle_to_shards(docs, 5, cell_rows=4).toPandas()
    assert sorted(out.text.fillna("-")) == sorted("-" if t is None else t for _, t in rows)
    for _, shard in out.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    sizes = out.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1
    assert sharding.shuffle_to_shards(nothing, 5).count() == 0


def kneser_ney(texts, order):
    """The model of `quality` for one language, by dictionaries: {order: {run: probability}}."""
    runs = Counter()
    for text in texts:
        padded = "\n" * (order - 1) + text
        runs.update(padded[i : i + order] for i in range(len(text)))
    models = {}
    for n in range(order, 0, -1):
        c = Counter(runs.values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] + 2 * c[2] else None
        d = {}
        for k in (1, 2, 3):
            d[k] = 0.5 if not c[k] or y is None else min(max(k - (k + 1) * y * c[k + 1] / c[k], 0), k)
        context, held = Counter(), Counter()
        for run, count in runs.items():
            less = min(d[min(count, 3)], count)
            context[run[:-1]] += count
            held[run[:-1]] += less
        models[n] = ({r: k - min(d[min(k, 3)], k) for r, k in runs.items()}, context, held)
        runs = Counter(r[1:] for r in runs)
    def probability(run):
        p = 1 / (len(models[1][0]) + 1)
        for n in range(1, order + 1):
            part = run[len(run) - n :]
            mass, context, held = models[n]
            if context[part[:-1]]:
                p = (mass.get(part, 0) + held[part[:-1]] * p) / context[part[:-1]]
        return p
    return probability


def unseen_ids(spark, n):
    fold = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(quality.FOLDS))
    return {r["id"] for r in spark.range(n).where(fold == 0).collect()}


@pytest.mark.parametrize("block", [1 << 25, 300])
def test_quality_equals_plain_model(spark, monkeypatch, block):
    monkeypatch.setattr(quality, "BLOCK_BYTES", block)
    monkeypatch.setattr(quality, "BROADCAST_LABELS", 0 if block == 300 else 1000)
    rng = random.Random(block)
    words = {"en": "the cat sat on a mat hat with that rat".split(), "ru": "кот сел на мат и кит шёл там".split(), None: "猫 坐在 垫子 上 𝄞 里".split()}
    rows = []
    for i in range(240):
        lang = rng.choice(list(words))
        junk = i % 6 == 5
        text = " ".join(rng.choices(words[lang], k=rng.randint(3, 25)))
        if junk:
            text = "".join(rng.sample(text + "%$#@ыъ", len(text)))
        rows.append((i, lang, text, int(not junk)))
    rows += [(1000, "en", "", 1), (1001, "xx", "no trusted text", 0), (1002, "en", "a\0b", 0), (None, "en", "the cat", 1), rows[7]]
    rows += [(1003, "ru", "кот " * 2000, 0)]
    table = [(i, lang, t, "x", 0) for i, lang, t, _ in rows] + [(1004, "en", None, "x", 0)]
    docs = spark.createDataFrame(table, "doc_id long, lang string, text string, block string, run int").repartition(3)
    docs = stored(docs, "quality-test")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(3, None), (5, 1)], "doc_id long, quality int")
    got = quality.quality(docs, labels).collect()
    unseen, good = unseen_ids(spark, 1010), {r[0] for r in rows if r[3] and r[0] is not None} | {5}
    assert len(got) == len(table) and {r["doc_id"] for r in got if r["trusted"]} == good
    models = {lang: kneser_ney([t for i, x, t, _ in rows if x == lang and i in good - unseen], quality.ORDER) for lang in words}
    found = {r["doc_id"]: r for r in got}
    for i, lang, text, _ in rows:
        text = text.replace("\0", "\ufffd")
        padded = "\n" * (quality.ORDER - 1) + text
        want = 1.0
        if lang in models and text:
            logs = [np.log(max(models[lang](padded[k : k + quality.ORDER]), 1e-12)) for k in range(len(text))]
            want = np.exp(-np.mean(logs))
        assert found[i]["perplexity"] == pytest.approx(want, rel=1e-4) and found[i]["n_tokens"] == len(text)
    assert found[1004]["perplexity"] == 1 and found[1004]["kept"] and found[1001]["kept"]
    junk = [found[i]["kept"] for i, _, _, ok in rows[:240] if not ok and i != 5]
    clean = [found[i]["kept"] for i, _, _, ok in rows[:240] if ok]
    assert np.mean(junk) < 0.2 and np.mean(clean) > 0.9
    assert quality.quality(docs.limit(0), labels).count() == 0
    assert quality.quality(docs, labels.limit(0)).where("kept").count() == len(table)


def tables_at(spark, monkeypatch, module, last):
    """What `module` stores, by label, and the labels that lie in the shared folder when `last` is stored."""
    before, kept, beside = set(list_folder(spark, shared_dir(spark))), {}, set()

    def noted(df, label, **options):
        if label == last:
            beside.update(name.rsplit("-", 1)[0] for name in set(list_folder(spark, shared_dir(spark))) - before)
        table = stored(df, label, **options)
        kept[label] = (table.columns, table.count())
        return table

    monkeypatch.setattr(module, "stored", noted)
    return kept, beside


def test_quality_asks_for_a_run_once_and_frees_its_tables(spark, monkeypatch):
    monkeypatch.setattr(quality, "BLOCK_BYTES", 30)  # each text is a block
    docs = spark.createDataFrame([(i, "en", "the cat sat on the mat", 1) for i in range(20)], "doc_id long, lang string, text string, quality int")
    docs = stored(docs, "quality-test")
    kept, beside = tables_at(spark, monkeypatch, quality, "perplexities")
    assert quality.quality(docs, docs).where("kept").count() == 20
    text = "\n\n\n\nthe cat sat on the mat"
    assert kept["asked-runs"][1] == len({text[k : k + 5] for k in range(len(text) - 4)})
    assert not beside & {"asked-runs", "log-probabilities", "contexts-5", "runs-5"}


@pytest.mark.parametrize("text", ["plain", "кот сел", "猫坐在垫子", "𝄞é\ufffda𝄞b\n\n"])
def test_runs_as_strings(text):
    runs, _ = quality._windows([text.encode()])
    padded = "\n" * 4 + text
    assert quality._strings(runs).to_pylist() == [padded[k : k + 5] for k in range(len(text))]


def test_url_filter(spark):
    urls = [None, "", "no scheme", "HTTP://Www.Example.COM/en/1?x#y", "http://a.example.com/en/2", "x://b.net/es/", "x://b.net#/es/", "x://net/fr/z", "x://.net/fr/z", "http://xcom/", "q://é.COM/"]
    urls += [f"http://n.net/{lang}/{i}" for lang in ("es", "en") for i in range(40)] + [f"http://s.org/post/{'abcdef'[i % 6]}{i}x" for i in range(30)]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(3, urls[3])], "page_id long, url string")
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
    got = {r["page_id"]: r for r in url_filter.judge(pages, rules).collect()}
    assert len(got) == len(urls)
    expect = {0: ("", "", None), 2: ("", "", None), 3: ("www.example.com", "/en/1", "www.example.com/en/"), 4: ("a.example.com", "/en/2", "example.com/en/"), 5: ("b.net", "/es/", "net/es/"), 6: ("b.net", "", None), 7: ("net", "/fr/z", "net/fr/"), 9: ("xcom", "/", None), 10: ("é.com", "/", "com/")}
    assert {k: (got[k]["host"], got[k]["path"], got[k]["rule"]) for k in expect} == expect
    assert got[3]["verdict"] == "allow" and got[4]["verdict"] == "block"
    assert got[60]["verdict"] == "allow" and got[60]["template"] == "/en/{n}"
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_url_templates_do_not_depend_on_the_number_of_siblings(spark):
    rules = [("block", "net/es/"), ("block", "net/fr/"), ("block", "org/x/y/")]
    first = ["es", "fr", "en", "de", *"abcdefghijk"]
    urls = [f"http://h.net/{f}/{i}" for f in first for i in range(60 if f in ("es", "fr") else 50)]
    rare = [f"http://h.net/en/p/{''.join(chr(97 + int(d)) for d in str(i))}" for i in range(100)]
    deep = [f"http://d.org/x/{s}/1/2/3/4/{i}" for s in ("y", "z") for i in range(50)] + ["http://e.org/" + "s/" * 300]
    every = urls + rare + deep
    pages = spark.createDataFrame(list(enumerate(every)), "page_id long, url string")
    got = {every[r["page_id"]]: r for r in url_filter.judge(pages, rules).collect()}
    for url in urls:
        assert got[url]["verdict"] == ("block" if "/es/" in url or "/fr/" in url else "allow"), url
    assert got["http://h.net/en/7"]["template"] == "/en/{n}"
    assert {got[u]["template"] for u in rare} == {"/en/p/*"}
    assert got["http://d.org/x/z/1/2/3/4/5"]["template"] == "/x/z/{n}/{n}/{n}/{n}/{n}"
    assert got["http://d.org/x/z/1/2/3/4/5"]["verdict"] == "allow" and got[deep[-1]]["template"] == "/" + "/".join("s" * 300)


def links_by_hand(rows, n, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = split((text or "").translate(low))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(rows)))
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[find(i)].append(doc)
    smallest = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return Counter((doc, len(sets[i]), smallest[find(i)]) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (2, 60)])
def test_ngram_components(docs, rows, n, percent):
    got = ngram_join.ngram_components(docs, size=n, percent=percent)
    assert Counter(tuple(r) for r in got.collect()) == links_by_hand(rows, n, percent)


def test_ngram_components_of_a_large_cluster(spark):
    """Chains of near copies around hubs: what the hubs miss is found in the second round."""
    rng = random.Random(8)
    base = [f"t{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(60)] = f"u{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    got = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), size=3, percent=80)
    assert Counter(tuple(r) for r in got.collect()) == links_by_hand(rows, 3, 80)


def test_ngram_prefixes_go_before_sets_are_compared(spark, monkeypatch):
    rows = [(i, " ".join(f"w{k}" for k in range(60 - i % 3))) for i in range(12)]
    kept, beside = tables_at(spark, monkeypatch, ngram_join, "ngram-tokens")
    got = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), size=3, percent=80)
    assert {r["component_id"] for r in got.collect()} == {0}
    assert "ngram-members" in beside
    assert not any("prefix" in kept[label][0] for label in beside & kept.keys())


def test_ngram_components_inside_one_group(spark):
    """Two members of a group that are linked with each other, and not with the group's first member."""
    rows = []
    for k in range(8):
        words = [f"k{k}v{i}".encode() for i in range(40)]
        tokens = ngram_join.gram_hashes(WordHasher().each([b" ".join(words)])[0], 1)
        ordered = [words[i].decode() for i in np.argsort(tokens)]
        prefix, rest = ordered[:3], ordered[3:]
        for members in (rest[:7], rest[1:8], rest[20:27]):
            rows.append((len(rows), " ".join(prefix + members)))
    found = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), size=1, percent=80)
    assert Counter(tuple(r) for r in found.collect()) == links_by_hand(rows, 1, 80)


def test_ngram_components_through_a_text_without_an_id(spark):
    words = [f"v{i}" for i in range(40)]
    rows = [(7, " ".join(words[:30])), (None, " ".join(words[3:33])), (9, " ".join(words[6:36])), (3, "other words")]
    got = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), size=3, percent=80)
    assert Counter(tuple(r) for r in got.collect()) == links_by_hand(rows, 3, 80)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {7: 7, None: 7, 9: 7, 3: 3}


def test_keep_one_each(docs, nothing, rows):
    kept = ngram_join.keep_one_each(docs)
    assert kept.columns == docs.columns
    want = [d for d, n, c in links_by_hand(rows, 5, 80).elements() if d is None or d == c]
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, want))
    assert ngram_join.keep_one_each(nothing).count() == 0


def tiled_by_hand(item, text, least):
    """Greedy tiling by comparing everything with everything."""
    a, b, total = [False] * len(item), [False] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k] and not a[i + k] and not b[j + k]:
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if k < least:
            return total
        a[i : i + k] = b[j : j + k] = [True] * k
        total += k


def test_tiles():
    rng = random.Random(4)
    for _ in range(60):
        item = [rng.randrange(1, 6) for _ in range(rng.randrange(1, 30))]
        text = [rng.choice([1, 2, 3, 4, 5, 9]) for _ in range(40)] + item[len(item) // 2 :] + item[: len(item) // 2]
        tiles = decontaminate.tile(item, text, 3)
        assert all(item[i : i + n] == text[j : j + n] and n >= 3 for i, j, n in tiles)
        assert len({p for i, _, n in tiles for p in range(i, i + n)}) == sum(n for _, _, n in tiles)
        assert sum(n for _, _, n in tiles) == tiled_by_hand(item, text, 3)
    item = list(range(1, 41))
    assert sum(t[2] for t in decontaminate.tile(item, item[20:] + [99] + item[:20], 5)) == 40


def test_contaminated(spark, nothing):
    rng = random.Random(6)
    items = [phrase(rng, 40, 5000) for _ in range(5)] + ["tiny item here", "", None]
    bench = spark.createDataFrame(list(enumerate(items)) + [(None, "x y z")], "item_id long, text string")
    w = items[1].split()
    texts = {
        0: phrase(rng, 300, 5000) + " " + items[0].upper() + "! " + phrase(rng, 9, 5000),
        1: " ".join(w[20:]) + " " + phrase(rng, 30, 5000) + " " + " ".join(w[:20]),
        2: " ".join(w[:15]) + " " + phrase(rng, 30, 5000),
        3: "so, (tiny) item\nHere.",
        4: None,
        5: "",
        6: phrase(rng, 500, 5000),
    }
    docs = spark.createDataFrame([*texts.items(), (0, texts[0]), (None, items[2])], "doc_id long, text string")
    got = decontaminate.contaminated(docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(0, 0), (1, 1), (3, 5)]
    assert {r["doc_id"]: r["n_tiles"] for r in got} == {0: 1, 1: 2, 3: 1}
    left = decontaminate.drop_contaminated(docs, bench)
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["2", "4", "5", "6", "None"]
    assert decontaminate.contaminated(nothing, bench).count() == decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def groups_by_hand(rows):
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc is None, doc or 0, i))
    return {k: (min(v), len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: __import__("pyspark.sql.functions", fromlist=["x"]).substring(c, 1, 1)])
def test_exact_dedup(docs, rows, digest):
    """Also with a digest that collides, where the bytes decide."""
    got = exact_dedup.exact_dedup(docs, digest=digest).collect()
    groups = groups_by_hand(rows)
    assert len(got) == len(rows) and sum(r["kept"] for r in got) == len(groups)
    want = Counter()
    for doc, text in rows:
        best, size = groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")]
        want[(doc, None if best[1] else best[2], size)] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == want


def test_drop_copies(docs, nothing, rows):
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(groups_by_hand(rows))
    assert exact_dedup.drop_copies(nothing).count() == 0


def test_state_goes_on(spark, tmp_path):
    """A second run over more stored rows sees the documents of the first."""
    a = spark.createDataFrame([("x", 1, -1, "f", 0)], "digest string, n_points long, rev_id long, file string, row long")
    a.write.parquet(f"{tmp_path}/keyed")
    exact_dedup.stream_state(spark, f"{tmp_path}/keyed", a.schema, f"{tmp_path}/state")
    spark.createDataFrame([("x", 5, -2, "g", 0), ("y", 1, -3, "g", 1)], a.schema).write.mode("append").parquet(f"{tmp_path}/keyed")
    state = exact_dedup.stream_state(spark, f"{tmp_path}/keyed", a.schema, f"{tmp_path}/state")
    assert {r["digest"]: (r["rev_id"], r["group_size"]) for r in state.collect()} == {"x": (-2, 2), "y": (-3, 1)}


def test_packing(docs, nothing, rows):
    tokens = packing.tokenized(docs, TOKENIZER)
    pieces = packing.pack(tokens)
    got = pieces.toPandas()
    library = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [packing.END]
        first = (len(ids) - 1) % packing.LENGTH + 1
        cuts = [0, *range(first, len(ids) + 1, packing.LENGTH)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(str(doc), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    ids = got.doc_id.map(lambda d: "None" if d != d else str(int(d)))
    assert Counter(zip(ids, got.piece, got.start, got.length, got.ids_crc32)) == want
    ordered = got.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= packing.LENGTH
    assert got.sequence_id.nunique() <= -(-got.length.sum() // packing.LENGTH) + 1
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(pieces, tokens).collect()}
    row = got.iloc[0]
    start, length = int(row.offset), int(row.length)
    part = whole[int(row.sequence_id)][start * 4 : (start + length) * 4]
    assert zlib.crc32(bytes(part)) == row.ids_crc32
    assert packing.pack_documents(nothing, TOKENIZER).count() == 0


def test_special_tokens_and_odd_spaces_encode_like_the_library():
    ids_of = packing.TextIds(*packing.read_ranks(TOKENIZER))
    library = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(2)
    for _ in range(800):
        text = "".join(rng.choice(["a", " ", "\n", "'s", "1", ",", "\t", "é", "<|endoftext|>", "\x85", "word"]) for _ in range(rng.randrange(9)))
        assert np.frombuffer(ids_of.of(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_runs_of_spaces_encode_like_the_library():
    ids_of = packing.TextIds(*packing.read_ranks(TOKENIZER))
    library = Tokenizer.from_file(TOKENIZER)
    same = lambda text: np.frombuffer(ids_of.of(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert same("a" + " " * 2_000_000 + "b")
    rng = random.Random(3)
    runs = [" " * 1200, "\n" * 1001, " \t" * 700, "\u3000" * 1100, " \x85" * 500 + "\xa0", "\x1c" * 1100]
    for _ in range(60):
        assert same("".join(rng.choice([*runs, "a", " ", "\n", "'s", "1", ",", "é", "<|endoftext|>", "word"]) for _ in range(rng.randrange(9))))


def test_plan_uses_up_any_histogram():
    rng = np.random.default_rng(1)
    for full in (8, 64):
        for _ in range(20):
            counts = rng.integers(0, rng.choice([2, 50, 5000]), full + 1) * rng.integers(0, 2, full + 1)
            counts[0] = counts[full] = 0
            chosen = packing.plan(counts, full)
            used = np.zeros(full + 1, np.int64)
            for pattern, n in chosen:
                assert sum(pattern) <= full and n > 0
                for size in pattern:
                    used[size] += n
            assert (used == counts).all()


def test_toxicity(spark, nothing):
    rng = random.Random(9)
    texts = [phrase(rng, 60) + (" Awful, nasty! " if i % 5 == 0 else " ") + phrase(rng, 20) for i in range(600)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "x"), (5, texts[5])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(500)] + [(1, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert len(got) == 604 and all(0 <= r["score"] <= 1 for r in got)
    right = [r["predicted"] == int(r["doc_id"] % 5 == 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 600]
    assert np.mean(right) > 0.99
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    assert toxicity.toxicity_scores(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.drop_toxic(nothing, labels).count() == 0
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end toxic")
    again = toxicity.toxicity_scores(docs, flipped).collect()
    assert [r["score"] for r in again] == [r["score"] for r in got]


def test_toxicity_brings_only_telling_words_to_the_driver(spark):
    """However many words the sample has, the driver gets those that positives hold clearly more often."""
    rng = random.Random(3)
    plain = [phrase(rng, 200, 100_000) for _ in range(60)]
    side = lambda texts: spark.createDataFrame([(t,) for t in texts], "text string")
    positive, unlabelled = side([t + " awful nasty" for t in plain[:20]] * 2), side(plain[20:] + [None, ""])
    sample = toxicity._sample(positive, unlabelled)
    assert sorted(sample.groupBy("positive").count().collect()) == [(False, 41), (True, 20)]
    words = toxicity.Words()
    want = np.unique(np.concatenate(words.features(toxicity.pa.array(["awful nasty"]))))
    places = toxicity._telling(sample, 20, 41)
    assert list(places) == list(want)
    known = sample.mapInArrow(toxicity._columns_task(places), "positive boolean, key bigint, words array<int>")
    of, row, n = toxicity._sparse(known.where("positive"))
    assert (len(of), n) == (40, 20) and sorted(row) == sorted([*range(20)] * 2)


def removed_by_hand(rows, size):
    first = {}
    for doc, text in rows:
        w = split(text)
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = Counter()
    for doc, text in rows:
        w = split(text)
        gone = set()
        for i in range(len(w) - size + 1):
            if doc is not None and first[tuple(w[i : i + size])] < doc:
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[(doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("size,part", [(50, 20), (8, 3)])
def test_substring_dedup(docs, nothing, rows, size, part):
    got = substring_dedup.substring_dedup(docs, size=size, part=part).collect()
    found = Counter((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in got)
    assert found == removed_by_hand(rows, size)
    assert substring_dedup.substring_dedup(nothing).count() == 0


def test_rolling_and_minimizers():
    tokens = np.random.default_rng(0).integers(0, 4, 300).astype(np.uint64)
    hashes = windows.Rolling(5).of(tokens, 7)
    runs = [tuple(tokens[i : i + 5]) for i in range(296)]
    assert len(hashes) == 296 and len(set(zip(runs, hashes))) == len(set(runs)) == len(set(hashes))
    assert (windows.window_minima(tokens, 7) == [tokens[i : i + 7].min() for i in range(294)]).all()


def test_main_text(spark):
    html = """<!DOCTYPE html><head><title>T &am</title><style>p{}</style></head><body><header>Top</header><nav><ul><li><a href="/x>y">Menu</a></ul></nav>
<!-- note --><div class="ad">Buy</div><article><h1>Head &amp; line</h1><p><b>One<br><p>two\n  three&nbsp;x</p><aside>side</aside>
<script>var t="</p>";</script><p class="x">last &lt;p&gt;</p><div id="comments"><p>reader</p></div></article><footer>&copy; foot</footer></body></html>"""
    plain = "<body><div>site name and the long menu of it all</div><p>{0} unique {0}</p><div>the same foot line on every page here</div>"
    pages = [(0, "http://h.com/0", html), (1, "http://h.com/1", plain.format("one")), (2, "http://h.com/2", plain.format("two")), (3, None, None), (4, "http://z.com", ""), (5, "http://o.org/", plain.format("three")), (None, "http://h.com/3", "<p>a"), (7, "x", "<article><p>a<"), (8, "x", "<script>never ends"), (9, "x", "<main><article><p>in</article> out</main>")]
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[0] == "Head & line\nOne\ntwo three x\nlast <p>"
    assert got[1] == "one unique one" and got[2] == "two unique two"
    assert got[5].count("\n") == 2  # nothing repeats on its host
    assert got[3] == got[4] == got[8] == "" and got[None] == "a" and got[7] == "a\n<" or got[7] == "a<"
    assert got[9] == "in\nout"


@pytest.mark.parametrize("open_", ['<body class="has-sidebar">', '<body class="no-comments sidebar">', '<div id="page" class="with-footer">', '<div class="modal">', '<article class="post sharing-on">', '<article class="post widget">', '<main class="social">'])
def test_class_names_do_not_hide_an_article(open_):
    tag = open_[1:].split()[0]
    inner = "<p>the whole story</p>" if tag in ("article", "main") else "<article><p>the whole story</p></article>"
    page = f'{open_}{inner}<div class="sidebar">side</div><div class="ad-banner">buy</div></{tag}>'
    assert [b for b in html_text.blocks(page) if b[1] == "main"] == [("the whole story", "main")]
    # beside a longer article that is not named so, a named one is furniture
    teaser = '<div class="sidebar"><article>read on</article></div><article>a<p class="no-comments">b c d</p><div id="comments"><article class="comment">I say</article></div></article>'
    assert [b for b in html_text.blocks(teaser) if b[1] == "main"] == [("a", "main"), ("b c d", "main")]


def main_texts(spark, pages):
    found = html_text.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string"))
    return {r["page_id"]: r["text"] for r in found.collect()}


def test_copies_and_quotations_keep_their_text(spark):
    page = "<div>the long menu of this site</div><p>{0} is what we say of {0} and no more</p>{1}<div>{2}</div>"
    quote = "to be or not to be that is the question"
    pages = [(i, "http://h.com/", page.format(f"n{i} m{i}", f"<p>{quote}</p>" if i < 2 else "", "")) for i in range(12)]
    pages += [(20, "http://h.com/print", pages[0][2]), (21, "http://h.com/2", pages[0][2].replace("<p>", "<div>"))]
    pages += [(30 + i, "http://c.com/", "<p>one text that is on two pages of a host</p>") for i in range(2)]
    got = main_texts(spark, pages)
    assert got[0] == got[20] == got[21] == f"n0 m0 is what we say of n0 m0 and no more\n{quote}"
    assert got[1].endswith(quote) and got[5] == "n5 m5 is what we say of n5 m5 and no more"
    assert got[30] == got[31] == "one text that is on two pages of a host"


def test_the_parse_says_which_pages_have_main_text(spark):
    menu, foot = "<div>the long menu of this whole site here</div>", "<div>the same foot line on every page</div>"
    bodies = ["<script>'<main>'</script>", "<!-- <article > -->", "<aside><article>side</article></aside>", "<div role=search>main</div>"]
    pages = [(i, "http://h.com/", f"{menu}{b}<p>text {i}</p>{foot}") for i, b in enumerate(bodies)]
    pages += [(10, "http://h.com/", f"{menu}<DIV ROLE='Main'>all of it</DIV>{foot}")]
    pages += [(11, "http://h.com/", f"{menu}<article>read more</article><p>{' '.join(f'w{i}' for i in range(30))}</p>{foot}")]
    pages += [(12, "http://h.com/", f"{menu}<article>a b c d e f g h i</article>{menu}{foot}<p>j</p>")]
    got = main_texts(spark, pages)
    assert [got[i] for i in range(4)] == [f"text {i}" for i in range(4)]
    assert got[10] == "all of it" and got[11].startswith("read more\nw0 w1") and got[11].endswith("w29")
    assert got[12] == "a b c d e f g h i"


@pytest.mark.parametrize(
    "broken",
    ["<a ", "x <b y ", '<a ">" ', "<a '", "<!-- ", "<script></script ", '<article class="ad">', "</ul>x", "<div></span>", "<div><p>t ", '<div class="ad">x ', "<a\"", "<"],
)
def test_broken_pages_take_linear_time(broken):
    """Five megabytes of it; less after an article, with and without a last >."""
    body = broken * (5_000_000 // len(broken))
    less = body[:200_000]
    for page in (body, "<article><p>story</p></article>" + less, less + ">", less + '"\'>'):
        start = time.perf_counter()
        found = html_text.blocks(page)
        assert time.perf_counter() - start < 40
        if page.startswith("<article><p>story"):
            assert found[0] == ("story", "main")


def test_text_of_broken_tags_stays():
    assert html_text.blocks("<p>a <b c") == [("a <b c", "other")]
    assert html_text.blocks('<p>a</p><a title="x>y">b</a><p>1 < 2 <i>c') == [("a", "other"), ("b", "other"), ("1 < 2 c", "other")]
    assert html_text.blocks('<p>a</p><a title="x>b</a><p>c') == [("a", "other"), ("b", "other"), ("c", "other")]


def test_no_article_text_is_lost_to_a_class_word():
    page = """<article><h2 id="comments">Comments on the law</h2><p class="share">share of the market rose</p>
    <div class="widget">a widget is a thing</div><blockquote class="notice">take notice</blockquote>
    <div class="ad">buy</div><div id="comments"><p>reader</p></div><ul class="share"><li>tweet</li></ul></article>"""
    kept = [t for t, zone in html_text.blocks(page) if zone == "main"]
    assert kept == ["Comments on the law", "share of the market rose", "a widget is a thing", "take notice"]


def test_copies_in_a_table_with_clashing_columns(spark):
    rows = [(1, "a b", "f", 1, "x"), (2, "ab ", "g", 2, "y"), (3, None, "h", 3, "z"), (4, "", "i", 4, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Content_File string, _content_row long, file string")
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[2]]


@pytest.mark.parametrize("hot", [1, 4, 1000])
def test_join_with_hot_keys_equals_a_plain_join(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT_KEYS", hot)
    rows = stored(spark.createDataFrame([(i, 0 if i % 2 else i % 7) for i in range(100)], "i int, k int"), "join-rows")
    keyed = stored(rows.where("k <> 3").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("least")), "join-keys")
    got = common.join_counted(rows, keyed, ["k"])
    want = rows.join(keyed.drop("n"), ["k"])
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
