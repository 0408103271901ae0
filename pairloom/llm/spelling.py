"""Spelling variants by pivotal grams.

Two words are near if one inserted, deleted or replaced code point makes them equal. All bigrams have
one order, the rare ones first; a word's prefix is its three first bigrams, and its pivots are two of
them that do not overlap, the pair with the fewest words by dynamic programming. One edit touches at
most one of two bigrams apart, and at most two bigrams at all, so of two near words one has a pivot
that lies untouched in the other's prefix.

So pivots are joined with prefixes, under limits on the position. As the bigram is untouched, the edit
lies on one side of it: the other side is equal, letter by letter, and gives the bigram's place. The
side of the edit, cut in halves, has an equal half too. Place, equal side and equal half are the join's
key, so words meet only those that share all of it. What meets is verified by the edit distance.

The order needs one row for each bigram of the alphabet, 90 * 90 at most, which is broadcast. Words
with no word near them take part in nothing after the join. Forms only lead to words at least twice as
frequent, so chains end, after at most log2 of the largest count steps; their ends are found by
doubling. The joins have no group that must fit into a task.

Nulls: a null text has no words; a null id counts as an empty one. Repeated rows count again. Ties go to
the smaller word. Very long texts are one row, as everywhere; a very long word only makes long keys.
Other columns are not looked at. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import stored

# The letters of words, and the letters that are lower-cased.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DELETED_OF = 97
PREFIX = 3  # bigrams that one edit touches, and one more


def noisy_runs(docs: DataFrame, shortest: int = 5) -> DataFrame:
    """(run) for each run of `shortest` letters or more: lower-cased, and with one letter deleted where
    the checksum of id and run says so."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))).alias("run"),
    ).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    checked = runs.select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return checked.select(F.when(F.col("h") % DELETED_OF == 0, cut).otherwise(F.col("run")).alias("run"))


def word_counts(runs: DataFrame, shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, n) of the runs long and frequent enough."""
    return (
        runs.groupBy(F.col("run").alias("word"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.length("word") >= shortest) & (F.col("n") >= least))
    )


# A fold over the prefix by place: `last` is the bigram just seen, `free` the first in order of those
# before it, `best` the lightest pair so far. All but `last` end before the next one starts.
_GRAM = "struct<f:bigint,g:string,p:int>"
_PAIR = f"struct<weight:bigint,a:{_GRAM},b:{_GRAM}>"
_APART = "if(s.last.p + 2 <= x.p, least(s.free, s.last), s.free)"
PIVOTS = f"""aggregate(sort_array(transform(prefix, x -> struct(x.p AS at, x AS gram))).gram,
    named_struct('free', CAST(NULL AS {_GRAM}), 'last', CAST(NULL AS {_GRAM}), 'best', CAST(NULL AS {_PAIR})),
    (s, x) -> named_struct('free', least(s.free, s.last), 'last', x,
        'best', least(s.best, if({_APART} IS NULL, CAST(NULL AS {_PAIR}),
            named_struct('weight', {_APART}.f + x.f, 'a', {_APART}, 'b', x)))),
    s -> array(s.best.a, s.best.b))"""


def prefixes(words: DataFrame) -> DataFrame:
    """(word, n, prefix, pivots): bigrams as (words that hold it, bigram, place)."""
    grams = words.select(
        "word", "n", F.posexplode(F.expr("transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))")).alias("p", "g")
    )
    common = grams.groupBy("g").agg(F.count(F.lit(1)).alias("f"))
    first = F.slice(F.sort_array(F.collect_list(F.struct("f", "g", "p"))), 1, PREFIX)
    listed = grams.join(F.broadcast(common), "g").groupBy("word", "n").agg(first.alias("prefix"))
    return listed.withColumn("pivots", F.expr(PIVOTS))


# What a word gives for a bigram at place x.p: the side that is equal, the side of the edit, the length
# of the longer word's side, and the half of it that is equal.
KEYS = """
    flatten(transform(prefix, x -> flatten(transform(array(
        struct(0 AS side, substring(word, 1, x.p) AS same, substring(word, x.p + 3) AS rest),
        struct(1 AS side, substring(word, x.p + 3) AS same, substring(word, 1, x.p) AS rest)
    ), y -> flatten(transform(sequence(length(y.rest), length(y.rest) + 1), m -> array(
        struct(xxhash64(x.g, y.side, m, 0, y.same, substring(y.rest, 1, m div 2)) AS key, array_contains(pivots, x) AS pivot),
        struct(xxhash64(x.g, y.side, m, 1, y.same, right(y.rest, m - m div 2)) AS key, array_contains(pivots, x) AS pivot)
    )))))))"""


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of all pairs of near words, each in both directions, once."""
    entries = stored(
        prefixes(words).select("word", "n", F.explode(F.array_distinct(F.expr(KEYS))).alias("x")).select("x.*", "word", "n"),
        "spelling-entries",
    )
    pivots = entries.where("pivot").drop("pivot")
    others = entries.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = pivots.join(others, "key").where(F.levenshtein("word", "near", 1) == 1).drop("key")
    both = found.unionAll(found.select("near", "near_n", "word", "n"))
    return both.distinct()


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of each chain word -> form, by doubling."""
    ends = stored(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(ends.join(further, "root", "left").select("word", "root", "next"), "spelling-roots")
        ends = step.select("word", F.coalesce("next", "root").alias("root"))
        if step.where("next IS NOT NULL").isEmpty():
            return ends


def group_variants(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of `words` (word, n), whose words are all different."""
    words = stored(words.select("word", "n"), "spelling-words")
    near = near_words(words)
    best = near.groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    )
    best = stored(
        best.select("word", "n_near", *(F.when(-F.col("best.m") >= 2 * F.col("n"), c).alias(name)
            for c, name in ((F.col("best.near"), "form"), (-F.col("best.m"), "form_n")))),
        "spelling-forms",
    )
    roots = _roots(best.where("form IS NOT NULL"))
    return words.join(best, "word", "left").join(roots, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        "form",
        "form_n",
        F.coalesce("root", "word").alias("root"),
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """`group_variants` of the words of `docs` (doc_id, text)."""
    return group_variants(word_counts(noisy_runs(docs)))
