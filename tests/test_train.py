import random

import brute
import pytest
from pyspark.sql import functions as F

from pairloom import resume_training, train_bpe
from pairloom.functions.symbols import SymbolTable
from pairloom.operators import pairs as prs
from pairloom.operators.pretokenize import word_counts
from pairloom.plans import train
from pairloom.plans.train import certain_merges, learn_merges
from pairloom.sources import checkpoints

D = "<|endoftext|>"


def docs(spark, texts, partitions=3):
    return spark.createDataFrame([(t,) for t in texts], "text string").repartition(partitions)


def random_texts(seed, alphabet="aab b", n=30):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(n)]


def test_pair_counts_overlap_and_best_pair_ties(spark):
    words = word_counts(docs(spark, ["aaa aaa", "bbb"]))
    got = {(r["l"], r["r"]): r["n"] for r in prs.pair_counts(words).collect()}
    assert got == {("61", "61"): 4, ("20", "61"): 1, ("62", "62"): 2}
    tied = spark.createDataFrame([("61", "62", 5), ("61", "6261", 5), ("60", "FF", 5)], "l string, r string, n long")
    assert tuple(prs.best_pair(tied).first()) == ("61", "6261", 5)


def test_pair_index_and_merge_once(spark):
    words = word_counts(docs(spark, ["aaaa"]))
    assert prs.pair_index(words).first()["positions"] == [0, 1, 2]
    table = SymbolTable()
    row = prs.merge_once(words, table, "61", "61").first()
    assert [table.hex(c) for c in row["merged"]] == ["6161", "6161"]


@pytest.mark.parametrize("seed,alphabet", [(1, "aab b"), (2, "abcd "), (3, "aé'ss  "), (4, "a")])
def test_training_equals_one_merge_at_a_time(spark, seed, alphabet):
    texts = random_texts(seed, alphabet)
    got = learn_merges(word_counts(docs(spark, texts)), 40)
    assert got == brute.hexes(brute.train(texts, 40))


def test_training_does_not_depend_on_partitioning(spark):
    texts = random_texts(7, "abcde ")
    runs = {tuple(learn_merges(word_counts(docs(spark, texts, n)), 15)) for n in (1, 5)}
    assert len(runs) == 1


def one_round(words, symbols, room, rng):
    """The batch rule alone, without Spark, over all grams or the first few."""
    counts = {}
    for word, n in words.items():
        for size in (2, 3):
            for i in range(len(word) - size + 1):
                gram = tuple(s.hex().upper() for s in word[i : i + size])
                counts[gram] = counts.get(gram, 0) + n
    grams = sorted(counts.items(), key=lambda x: (-x[1], rng.random()))
    pairs = sorted(((n, *g) for g, n in counts.items() if len(g) == 2), reverse=True)
    if not pairs:
        return []
    top = grams[: rng.choice([len(grams), 5, 12, 40])]
    cut = top[-1][1] if len(top) < len(grams) else 0
    listed = [(n, *g) for g, n in top if len(g) == 2]
    if all(n <= cut for n, *_ in listed):
        first = [p for p in pairs if p[0] == pairs[0][0]][: rng.choice([1, 2, 100])]
        return certain_merges(first, {}, first[0][0], symbols, room, tied=True)
    return certain_merges(listed, {g: n for g, n in top if len(g) == 3}, cut, symbols, room)


def test_certain_merges_equal_single_steps_on_random_corpora():
    rounds = 0
    for seed in range(400):
        rng = random.Random(seed)
        texts = random_texts(seed, rng.choice(["ab ", "abc ", "abcdef ", "aab", "abcdefghijklmnop "]), n=rng.randint(1, 12))
        want = brute.train(texts, 25)
        words = {}
        for t in texts:
            for p in brute.pretokens(t):
                words[brute.as_word(p)] = words.get(brute.as_word(p), 0) + 1
        got, symbols = [], SymbolTable()
        while len(got) < 25:
            taken = one_round(words, symbols, 25 - len(got), rng)
            rounds += 1
            if not taken:
                break
            for left, right in taken:
                pair = (bytes.fromhex(left), bytes.fromhex(right))
                merged = {}
                for w, n in words.items():
                    merged[brute.merge(w, pair)] = merged.get(brute.merge(w, pair), 0) + n
                words = merged
                symbols.rule(left, right)
                got.append(pair)
        assert got == want, seed
    assert rounds < 400 * 25


@pytest.mark.parametrize("top,hot", [(2, 3), (5, 8), (4, 4096)])
def test_grams_beyond_the_listed_ones(spark, monkeypatch, top, hot):
    monkeypatch.setattr(train, "TOP_GRAMS", top)
    monkeypatch.setattr(train, "HOT_GRAMS", hot)
    for texts in (["ab cd ef gh ij kl", "mn op"], random_texts(12, "abcd ")):
        assert learn_merges(word_counts(docs(spark, texts)), 12) == brute.hexes(brute.train(texts, 12))


@pytest.mark.parametrize("merges,share", [(1, 4), (3, 0), (128, 0), (128, 1000)])
def test_new_bases_and_the_index(spark, monkeypatch, merges, share):
    monkeypatch.setattr(train, "MERGES_PER_BASE", merges)
    monkeypatch.setattr(train, "INDEX_SHARE", share)  # 0: always the index
    texts = random_texts(11, "abcab ") + random_texts(13, "xyzé ")
    learner = train.MergeLearner(word_counts(docs(spark, texts)))
    learner.learn(12)
    learner.learn(25)
    assert learner.merges == brute.hexes(brute.train(texts, 25))
    assert (learner.index is not None) == (share == 0 and merges > 1) or share == 4
    left = {"".join(c) for c in learner.words().select("word").toPandas()["word"]}
    learner.close()
    assert left


def test_a_round_reads_only_words_with_the_pair(spark, monkeypatch):
    """Rows read fall with the pair's frequency: the index gives the words of the pairs, each once."""
    monkeypatch.setattr(train, "INDEX_SHARE", 0)
    texts = random_texts(17, "abcdefgh ", n=60)
    learner = train.MergeLearner(word_counts(docs(spark, texts)))
    words = {tuple(r) for r in learner.base_words.collect()}
    for pairs in (["ab"], ["ab", "bc", "gh"], ["zz"]):
        got = [tuple(r) for r in learner._words_with(pairs).collect()]
        assert sorted(got) == sorted(w for w in words if any(p in w[0] for p in pairs))
    plan = learner._words_with(["ab"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(pair), EqualTo(pair,ab)]" in plan
    learner.close()


def test_the_plan_does_not_grow_with_the_merges(spark):
    """Nor with the rounds since the base: what a round sends is its own rules."""
    texts = random_texts(19, "abcdefghijkl ", n=80)
    learner = train.MergeLearner(word_counts(docs(spark, texts)))
    sizes = []
    for n in (10, 40, 80):
        learner.learn(n)
        learner._new_base(learner.words())
        learner._apply(learner._next_merges(1))
        sizes.append(len(learner.counts._jdf.queryExecution().optimizedPlan().toString()))
    learner.close()
    assert max(sizes) < 1.2 * min(sizes) + 200


def test_specials_take_part_as_bytes_unless_excluded(spark):
    texts = [f"a{D}b{D}"] * 3
    tok = train_bpe(docs(spark, texts), 256 + 1 + 14, [D])
    assert tok.merge_list == brute.hexes(brute.train(texts, 14, [D]))
    assert train_bpe(docs(spark, texts), 256 + 1 + 14, [D], exclude_specials=True).merge_list == []


def test_small_vocab_gives_no_merges_and_base_vocabulary(spark):
    tok = train_bpe(docs(spark, ["abab"]), 200, [D])
    vocab = {r["token_id"]: r["token_hex"] for r in tok.vocab.collect()}
    assert tok.merge_list == []
    assert vocab == {0: D.encode().hex().upper(), **{i + 1: f"{i:02X}" for i in range(256)}}


def test_empty_corpus(spark):
    assert learn_merges(word_counts(docs(spark, [""], 1)), 5) == []


def test_checkpoints_resume_and_history(spark, tmp_path):
    texts = random_texts(5, "abcd ")
    size = 256 + 1
    path = str(tmp_path / "run")
    whole = train_bpe(docs(spark, texts), size + 12, [D], save_progress=True, progress_interval=5, checkpoint_dir=path)
    history = {
        r["checkpoint"]: (r["merge_count"], r["vocab_size"], r["num_merges"])
        for r in checkpoints.training_history(spark, path).collect()
    }
    assert history == {"step=5": (5, size + 5, 5), "step=10": (10, size + 10, 10), "final": (12, size + 12, 12)}
    for step in (5, 10):
        saved = checkpoints.read_checkpoint(spark, f"{path}/step={step}")
        merges = [(r["l"], r["r"]) for r in saved.merges.orderBy("rank").collect()]
        assert merges == whole.merge_list[:step]
        assert saved.words.agg(F.sum("cnt")).first()[0] == sum(len(brute.pretokens(t)) for t in texts)
    resumed = resume_training(spark, f"{path}/step=5", size + 20, progress_interval=10)
    assert resumed.merge_list == brute.hexes(brute.train(texts, 20))
    done = resume_training(spark, f"{path}/step=10", size + 3)
    assert done.merge_list == whole.merge_list[:10]
