"""DuckDB SQL with the same columns, for the queries that SQL can express."""

from pairloom.llm.quality_rules import ALPHA, DELTA, RULES

WORDS = "regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"

NGRAM_JACCARD = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, {WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
    FROM d
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
    FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
    SELECT x, y FROM p JOIN n AS nx ON nx.doc_id = x JOIN n AS ny ON ny.doc_id = y
    WHERE 100 * i >= 90 * (nx.n + ny.n - i)
), r AS (
    SELECT x AS doc_id, y AS c FROM l
    UNION
    SELECT r.doc_id, l.y FROM r JOIN l ON r.c = l.x
), m AS (
    SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.c, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

EXACT_DEDUP = r"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS x, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n
    FROM documents
), k AS (
    SELECT doc_id, n, first_value(doc_id) OVER (PARTITION BY n ORDER BY length(x) DESC, doc_id) AS keep_id,
        count(*) OVER (PARTITION BY n) AS group_size
    FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM k
"""

SUBSTRING_DEDUP = f"""
WITH d AS (
    SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents
), g AS (
    SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS h FROM d, unnest(range(1, len(w) - 48)) AS u(s)
), f AS (
    SELECT h, min(doc_id) AS first FROM g GROUP BY h
), r AS (
    SELECT DISTINCT g.doc_id, s + k AS p FROM g JOIN f USING (h), range(50) AS t(k) WHERE first < g.doc_id
), c AS (
    SELECT doc_id, list(p) AS gone FROM r GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
    sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)), ' ')) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""

HARD_NEGATIVES = """
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
        list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
    FROM r a JOIN r b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 50 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
    (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""

LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SPELLING = f"""
WITH RECURSIVE tab AS (
    -- the table of the checksum, one entry for each byte
    SELECT list(list_reduce(list_concat([i::BIGINT], range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END) ORDER BY i) AS t
    FROM range(256) AS r(i)
), runs AS (
    SELECT doc_id, {LOWER.format(text="unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+'))")} AS run FROM documents
), long_runs AS (
    SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL
), bytes AS (
    SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM long_runs
), checked AS (
    SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT],
            list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::BIGINT, 2))::BIGINT)),
        lambda c, k: xor(c // 256, t[xor(c % 256, k) + 1])), 4294967295::BIGINT) AS h
    FROM bytes, tab
), noisy AS (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM checked
), w AS (
    SELECT word, sum(n)::BIGINT AS n FROM noisy WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
    SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM w, LATERAL unnest(range(0, length(word))) AS u(i)
), shorter AS (
    SELECT DISTINCT cut.word AS a, w.word AS b FROM cut JOIN w ON rest = w.word
), near AS (
    SELECT a, b FROM shorter UNION SELECT b, a FROM shorter
    UNION SELECT x.word, y.word FROM cut x JOIN cut y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
), best AS (
    SELECT a AS word, count(*) AS n_near, arg_min(b, (-v.n, b)) AS b, max(v.n) AS m
    FROM near JOIN w v ON v.word = b GROUP BY a
), f AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
        CASE WHEN m >= 2 * w.n THEN b END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n
    FROM w LEFT JOIN best USING (word)
), chain AS (
    SELECT word, word AS last FROM f
    UNION ALL
    SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.last WHERE f.form IS NOT NULL
)
SELECT f.*, last AS root FROM f JOIN chain USING (word) JOIN f e ON e.word = last WHERE e.form IS NULL
"""

QUALITY_RULES = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce('=' || lang, '-') AS stratum, coalesce(text, '') AS text,
        {WORDS.format(text="coalesce(text, '')")} AS w
    FROM documents
), windows AS (
    SELECT doc_id, s, array_to_string(w[s:s + 7], ' ') AS g FROM d, LATERAL unnest(range(1, len(w) - 6)) AS u(s)
), twice AS (
    SELECT doc_id, s FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), repeats AS (
    SELECT doc_id, count(DISTINCT s + k) AS n FROM twice, range(8) AS r(k) GROUP BY doc_id
), lines AS (
    SELECT doc_id, count(*) AS n, count(DISTINCT line) AS different
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), v AS (
    SELECT d.doc_id, stratum, len(w)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(l.n, 0)::BIGINT AS n_lines,
        coalesce(l.n - l.different, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
    FROM d LEFT JOIN lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id)
), x AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        [{', '.join(f"coalesce({r.value.replace('DIV', '//')}, 0)" for r in RULES)}] AS val
    FROM v
), cutoffs(rule, place, cutoff) AS (
    VALUES {', '.join(f"({r + 1}, {place}, {c})" for r, rule in enumerate(RULES) for place, c in enumerate(rule.cutoffs))}
), known AS (
    SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), l AS (
    SELECT doc_id, stratum, good, substr(md5(doc_id::VARCHAR), 1, 1) < '8' AS holdout, val
    FROM x JOIN known USING (doc_id) WHERE NOT base_failed
), hits AS (
    SELECT doc_id, stratum, good, holdout, rule, place FROM l JOIN cutoffs ON val[rule] > cutoff
), sizes AS (
    SELECT stratum, count_if(good = 1) AS goods, count_if(good = 0) AS bads FROM l WHERE NOT holdout GROUP BY stratum
), pairs AS (
    SELECT stratum, rule, place, count_if(good = 1) AS good, count_if(good = 0) AS bad
    FROM hits WHERE NOT holdout GROUP BY stratum, rule, place
), ladder AS (
    SELECT stratum, rule, place, row_number() OVER (
        PARTITION BY stratum ORDER BY (1000000 * bad) // (bad + good) DESC, bad DESC, rule, place) AS t
    FROM pairs JOIN sizes USING (stratum) WHERE bad * goods > good * bads
), holdouts AS (
    SELECT stratum, count(*) AS n FROM l WHERE holdout AND good = 1 GROUP BY stratum
), steps AS (
    SELECT stratum, doc_id, min(t) AS t FROM hits JOIN ladder USING (stratum, rule, place)
    WHERE holdout AND good = 1 GROUP BY stratum, doc_id
), rejected AS (
    SELECT stratum, rule, place, (SELECT count(*) FROM steps s WHERE s.stratum = ladder.stratum AND s.t <= ladder.t) AS k FROM ladder
), tails AS (
    SELECT stratum, k, sum(exp(lgamma(n + 1) - CASE WHEN k = 0 THEN 0 ELSE lgamma(k + 1) END
        - CASE WHEN k = n THEN 0 ELSE lgamma(n - k + 1) END + k * ln({ALPHA}) + (n - k) * ln(1 - {ALPHA})))
        OVER (PARTITION BY stratum ORDER BY k) AS tail
    FROM holdouts, LATERAL unnest(range(0, n + 1)) AS u(k)
), allowed AS (
    SELECT stratum, max(k) AS most FROM tails WHERE tail <= {DELTA} / (SELECT count(*) FROM holdouts) GROUP BY stratum
), chosen AS (
    SELECT stratum, rule, min(cutoff) AS cutoff
    FROM rejected JOIN allowed USING (stratum) JOIN cutoffs USING (rule, place) WHERE k <= most GROUP BY stratum, rule
), gone AS (
    SELECT DISTINCT doc_id FROM x JOIN chosen USING (stratum) WHERE val[rule] > cutoff
)
SELECT x.doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
    CASE WHEN stratum <> '-' THEN substr(stratum, 2) END AS stratum,
    base_failed, NOT base_failed AND gone.doc_id IS NULL AS kept
FROM x LEFT JOIN gone USING (doc_id)
"""

ORACLES = {
    "op4_ngram_jaccard": NGRAM_JACCARD,
    "op6_exact_dedup": EXACT_DEDUP,
    "op11_quality_rules": QUALITY_RULES,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_spelling_variants": SPELLING,
    "op9_substring_dedup": SUBSTRING_DEDUP,
}
