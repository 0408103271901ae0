"""Learning merges from weighted words.

The words and the counts of pairs stay in Spark. A round reads the words that its merges
change, through an index from pairs to words, adds what that changes to the counts of the round
before, and brings the most frequent pairs and triples (at most `TOP_GRAMS` rows) to the driver, which
picks as many merges as are certain. A gram is a pair or a triple of neighbouring symbols.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.symbols import SymbolTable, constant_sql, fold_sql
from pairloom.functions.text import clean_specials
from pairloom.operators.pairs import gram_changes, pair_postings
from pairloom.operators.pretokenize import word_counts
from pairloom.operators.vocab import build_vocab
from pairloom.plans.tokenizer import Tokenizer, merge_table
from pairloom.session import remove_folder, work_dir
from pairloom.sources import checkpoints

TOP_GRAMS = 4096  # rows that a round brings to the driver
HOT_GRAMS = 16384  # rows that a new base brings there; grams below them wait for the next base
MERGES_PER_ROUND = 64
MERGES_PER_BASE = 128
INDEX_SHARE = 4  # the index is read where it holds less than one in so many words

Pair = tuple[str, str]


def certain_merges(
    pairs: Sequence[tuple[int, str, str]],
    triples: dict[tuple[str, str, str], int],
    cut: int,
    known: SymbolTable,
    room: int,
    tied: bool = False,
) -> list[Pair]:
    """The merges that one-at-a-time training would make next, as far as counts alone tell.

    `pairs` holds pairs as (count, left hex, right hex), and `triples` counts of neighbouring triples.
    What is not listed counts `cut` at most. With `tied`, all pairs listed count `cut`, come first in
    order, and no triple is listed.

    Merging (a, b) changes only pairs that end in a or start with b. Such a pair (x, a) loses the
    occurrences of the triple (x, a, b), and as many at most come back as the new pair (x, ab). So every
    pair has a least and a largest count, and every new one a largest. The pair with the largest one
    is certain to be next while its least count still puts it before all others. A pair of one symbol
    with itself, or one whose bytes exist already, breaks the argument and is taken alone.

    With `tied`, a new pair from a pair that is not listed starts with that pair's left symbol, which is not
    after the left symbol of the last pair listed, or with a symbol just made.
    """
    count = {(left, right): n for n, left, right in pairs}
    ending: dict[str, list[str]] = defaultdict(list)
    starting: dict[str, list[str]] = defaultdict(list)
    for left, right in count:
        ending[right].append(left)
        starting[left].append(right)
    largest = dict(count)
    lost = dict.fromkeys(count, 0)  # at most so many occurrences, while largest - count tells the fewest
    order = [(-n, _reversed(left), _reversed(right), left, right) for n, left, right in pairs]
    heapq.heapify(order)

    taken: list[Pair] = []
    made: set[str] = set()
    made_with_left: dict[str, list[str]] = defaultdict(list)
    made_with_right: dict[str, list[str]] = defaultdict(list)
    last = max(order, default=None) if tied else None
    threat = (cut, last[3], "~") if last else (cut, "~", "~") if cut else (0, "", "")  # "~" sorts after any hex

    def first() -> tuple[int, str, str] | None:
        """The first pair in order by its largest count."""
        while order:
            n, _, _, left, right = order[0]
            if largest.get((left, right)) == -n:
                return -n, left, right
            heapq.heappop(order)
        return None

    while len(taken) < room and (best := first()):
        n, left, right = best
        new = left + right
        alone = left == right or new in known
        if taken:
            least = (count[left, right] - lost[left, right], left, right)
            heapq.heappop(order)
            second = first()
            if alone or new in made or least <= threat or (second and least <= second):
                break
        taken.append((left, right))
        if alone:
            break
        whole = lost.pop((left, right)) == 0  # all occurrences counted are merged
        del largest[left, right]
        made.add(new)
        made_with_left[left].append(new)
        made_with_right[right].append(new)
        if tied:
            threat = max(threat, (cut, new, "~"))
        for x in ending[left]:
            t = triples.get((x, left, right), min(cut, count[x, left]))
            threat = max(threat, *((t, l, new) for l in (x, *made_with_right.get(x, ()))))
            _lose(largest, lost, order, count, (x, left), t, whole and (x, left, right) in triples)
        for y in starting[right]:
            t = triples.get((left, right, y), min(cut, count[right, y]))
            threat = max(threat, *((t, new, r) for r in (y, *made_with_left.get(y, ()))))
            _lose(largest, lost, order, count, (right, y), t, whole and (left, right, y) in triples)
    return taken


def _reversed(token_hex: str) -> tuple[int, ...]:
    """A key that sorts hex texts backwards, longer ones before their prefixes."""
    return (*(-ord(c) for c in token_hex), 1)


def _lose(largest: dict, lost: dict, order: list, count: dict, pair: Pair, most: int, exact: bool) -> None:
    """Note that a merge takes at most `most` occurrences of a pair, or just as many if `exact`."""
    if pair not in largest:
        return
    lost[pair] += most
    if exact and count[pair] - most < largest[pair]:
        largest[pair] = count[pair] - most
        heapq.heappush(order, (-largest[pair], _reversed(pair[0]), _reversed(pair[1]), *pair))


class MergeLearner:
    """The state of one training run: words, counts of grams, merges so far.

    A base is the words with all merges up to it applied and the counts of their grams, as tables in the
    shared folder, and, where the chosen pairs are in few words, an index that holds the words of each
    pair, ordered by pair. A round takes the words that the new merges change from the index or the
    words, works out their form before and after, and adds the difference to the counts of the last
    round. Only grams more frequent than the least of the base's `HOT_GRAMS` are counted; grams never
    gain occurrences after they first appear, so the others stay below until the next base. So a
    round's work is that of the words changed and of a bounded list of counts, whatever the number of
    rounds, and a lost executor costs a read of its part. Tables take turns in two places.
    """

    def __init__(self, words: DataFrame, merges: Sequence[Pair] = ()):
        self.spark: SparkSession = words.sparkSession
        self.merges = list(merges)
        self.symbols = SymbolTable(self.merges)
        self.dir = work_dir(self.spark, "learn")
        self.rounds = 0
        self.bases = 0
        self.base_words: DataFrame | None = None
        self._new_base(words.select("word", "cnt"))

    def _stored(self, df: DataFrame, name: str, turn: int) -> DataFrame:
        path = f"{self.dir}/{name}-{turn % 2}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _new_base(self, words: DataFrame) -> None:
        old = self.base_words
        self.bases += 1
        self.base_words = self._stored(words, "words", self.bases).persist()
        if old is not None:
            old.unpersist()
        self.since_base: list[str] = []
        self.parts: dict[str, str] = {}  # of each symbol made since: its symbols in the base
        self.index: DataFrame | None = None
        changes = gram_changes(self.base_words.selectExpr("cnt", "word AS new", "'' AS old"))
        grams = changes.groupBy("gram").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("places"))
        self.base_grams = self._stored(grams, "grams", self.bases)
        hot = self.base_grams.orderBy(F.desc("n")).limit(HOT_GRAMS).collect()
        self.n_words = self.base_words.count()
        self.floor = hot[-1]["n"] if len(hot) == HOT_GRAMS else 0
        self.places = {r["gram"]: r["places"] for r in hot if len(r["gram"]) == 2}
        self.counts = self.base_grams.select("gram", "n").where(F.col("n") > self.floor)
        rows = [(r["gram"], r["n"]) for r in hot if r["n"] > self.floor]
        self.top: list[tuple[str, int]] | None = rows[:TOP_GRAMS]

    def words(self) -> DataFrame:
        """(word, cnt) with all merges so far applied."""
        return self.base_words.selectExpr(f"{fold_sql('word', self.since_base)} AS word", "cnt")

    # -- one round

    def _next_merges(self, room: int) -> list[Pair]:
        """The merges that are certain; none if no pair is left."""
        if self.top is None:
            self._new_base(self.words())
        while True:
            cut = max(self.floor, self.top[-1][1] if len(self.top) == TOP_GRAMS else 0)
            hexes = [([self.symbols.hex(c) for c in gram], n) for gram, n in self.top]
            pairs = [(n, *h) for h, n in hexes if len(h) == 2]
            if any(n > cut for n, *_ in pairs):
                triples = {tuple(h): n for h, n in hexes if len(h) == 3}
                return certain_merges(pairs, triples, cut, self.symbols, room)
            if not cut:
                return []
            if self.since_base:
                self._new_base(self.words())
            else:
                return self._tied_merges(room)

    def _tied_merges(self, room: int) -> list[Pair]:
        """More grams than a round lists have the count of the first pair: the first pairs in order, by
        a join with the symbols."""
        symbols = self.spark.createDataFrame(self.symbols.items(), "symbol string, hex string")
        pairs = self.base_grams.where("length(gram) = 2")
        best = pairs.agg(F.max("n")).first()[0]
        if best is None:
            return []
        for at, side in ((1, "l"), (2, "r")):
            names = symbols.select(F.col("symbol").alias(f"{side}_symbol"), F.col("hex").alias(side))
            pairs = pairs.withColumn(f"{side}_symbol", F.substring("gram", at, 1)).join(names, f"{side}_symbol")
        first = pairs.where(F.col("n") == best).orderBy(F.desc("l"), F.desc("r")).select("n", "l", "r").limit(TOP_GRAMS + 1)
        rows = [tuple(r) for r in first.collect()]
        return certain_merges(rows[:TOP_GRAMS], {}, best, self.symbols, room, tied=True)

    def _base_pair(self, left: str, right: str) -> str:
        """A pair of the base that every word with the pair (left, right) has; the rarest there is."""
        symbols = self.parts.get(left, left) + self.parts.get(right, right)
        return min((symbols[i : i + 2] for i in range(len(symbols) - 1)), key=lambda p: self.places.get(p, self.n_words))

    def _words_with(self, pairs: list[str]) -> DataFrame:
        """(word, cnt) of the base, each word once: those that hold one of the pairs."""
        held = f"filter({constant_sql(pairs)}, p -> contains(word, p))"
        if INDEX_SHARE * sum(self.places.get(p, self.n_words) for p in pairs) >= self.n_words:
            return self.base_words.where(f"size({held}) > 0")
        if self.index is None:
            self.index = self._stored(pair_postings(self.base_words), "index", self.bases)
        one = F.lit(False)
        for p in pairs:  # equality of each, so that the scan skips the rest of the index
            one = one | (F.col("pair") == F.lit(p))
        # a word that holds several comes with each; the first one counts
        return self.index.where(one).where(f"pair = get({held}, 0)").select("word", "cnt")

    def _apply(self, taken: list[Pair]) -> None:
        clash = any(left + right in self.symbols for left, right in taken)
        rules = [self.symbols.rule(left, right) for left, right in taken]
        pairs = list(dict.fromkeys(self._base_pair(rule[0], rule[1]) for rule in rules))
        before, self.since_base = self.since_base, self.since_base + rules
        self.merges += taken
        self.rounds += 1
        for left, right, new in rules:
            self.parts[new] = self.parts.get(left, left) + self.parts.get(right, right)
        if clash or len(self.since_base) >= MERGES_PER_BASE:
            self._new_base(self.words())
            return
        changed = (
            self._words_with(pairs)
            .selectExpr("cnt", f"{fold_sql('word', before)} AS old")
            .selectExpr("cnt", "old", f"{fold_sql('old', rules)} AS new")
            .where("old <> new")
        )
        counts = (
            self.counts.unionByName(gram_changes(changed))
            .groupBy("gram")
            .agg(F.sum("n").alias("n"))
            .where(F.col("n") > self.floor)
        )
        self.counts = self._stored(counts, "counts", self.rounds)
        self.top = [tuple(r) for r in self.counts.orderBy(F.desc("n")).limit(TOP_GRAMS).collect()]

    def learn(self, num_merges: int, on_step: Callable[[], None] | None = None, step: int = 0) -> None:
        """Learn until there are `num_merges` merges or no pair is left.

        With `step`, no round passes a multiple of it and `on_step` runs at each one.
        """
        while len(self.merges) < num_merges:
            room = min(num_merges - len(self.merges), MERGES_PER_ROUND)
            if step:
                room = min(room, step - len(self.merges) % step)
            taken = self._next_merges(room)
            if not taken:
                break
            if len(self.merges) + len(taken) == num_merges:  # nothing needs the counts after the last round
                self.since_base += [self.symbols.rule(left, right) for left, right in taken]
                self.merges += taken
                self.rounds += 1
                self.top = None
            else:
                self._apply(taken)
            if step and on_step and len(self.merges) % step == 0:
                on_step()

    def close(self) -> None:
        self.base_words.unpersist()
        remove_folder(self.spark, self.dir)


def learn_merges(words: DataFrame, num_merges: int) -> list[tuple[str, str]]:
    """The first `num_merges` merges for (word, cnt), as hex pairs in rank order."""
    learner = MergeLearner(words)
    learner.learn(num_merges)
    learner.close()
    return learner.merges


def _finish(
    learner: MergeLearner,
    specials: list[str],
    num_merges: int,
    checkpoint_dir: str | None,
    progress_interval: int,
    final: bool,
) -> Tokenizer:
    spark = learner.spark

    def save(name: str) -> None:
        merges = merge_table(spark, learner.merges)
        checkpoints.write_checkpoint(
            f"{checkpoint_dir}/{name}",
            learner.words(),
            merges,
            build_vocab(spark, merges, specials),
            specials,
            merge_count=len(learner.merges),
            vocab_size=256 + len(specials) + len(learner.merges),
        )

    if checkpoint_dir:
        learner.learn(num_merges, lambda: save(f"step={len(learner.merges)}"), progress_interval)
        if final:
            save("final")
    else:
        learner.learn(num_merges)
    learner.close()
    merges = merge_table(spark, learner.merges)
    return Tokenizer(build_vocab(spark, merges, specials), merges, tuple(specials))


def train_bpe(
    docs: DataFrame,
    vocab_size: int,
    special_tokens: Sequence[str] | None = None,
    *,
    text: str = "text",
    exclude_specials: bool = False,
    save_progress: bool = False,
    progress_interval: int = 100,
    checkpoint_dir: str | None = None,
) -> Tokenizer:
    """Learn a tokenizer of `vocab_size` entries (specials and the 256 bytes included)."""
    specials = clean_specials(special_tokens)
    words = word_counts(docs, text, specials, exclude_specials)
    if save_progress and checkpoint_dir is None:
        checkpoint_dir = work_dir(docs.sparkSession, "training")
    return _finish(
        MergeLearner(words),
        specials,
        vocab_size - 256 - len(specials),
        checkpoint_dir if save_progress else None,
        progress_interval,
        final=True,
    )


def resume_training(
    spark: SparkSession,
    checkpoint_path: str,
    target_vocab_size: int,
    *,
    progress_interval: int = 100,
    save_progress: bool = True,
) -> Tokenizer:
    """Go on from a checkpoint; the result equals training without the stop.

    New checkpoints go beside the one given.
    """
    saved = checkpoints.read_checkpoint(spark, checkpoint_path)
    specials = list(saved.specials)
    if saved.vocab_size >= target_vocab_size:
        return Tokenizer(saved.vocab, saved.merges, tuple(specials))
    merges = Tokenizer(saved.vocab, saved.merges).merge_list
    parent = checkpoint_path.rstrip("/").rsplit("/", 1)[0]
    return _finish(
        MergeLearner(saved.words, merges),
        specials,
        target_vocab_size - 256 - len(specials),
        parent if save_progress else None,
        progress_interval,
        final=False,
    )
