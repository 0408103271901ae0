"""DuckDB SQL for the registered queries, written apart from the Spark side: words are delimited hex
(`|74||68|`), specials are split with a marker character, and training is a recursive query."""

from __future__ import annotations

from pairloom.functions.text import DELIMITER
from pairloom.plans.examples import (
    ABSENT_BYTES,
    EDGES,
    KNOWN_MERGES,
    LONG_MERGES,
    MERGES,
    SHORT_MERGES,
    SPECIALS,
    TRAIN_MERGES,
    TRAIN_STEP,
)

WS = r"\t-\r\x{85}\p{Z}"
# RE2 has no lookahead: a marker goes before the last of several spaces that precede a word.
PATTERN = (
    rf"''(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{WS}\p{{L}}\p{{N}}\x{{E000}}]+|[{WS}]+"
)
N_SPECIALS = len(SPECIALS)


def pretoken_list(text: str) -> str:
    marked = rf"regexp_replace({text}, '([{WS}])([{WS}][^{WS}])', '\1' || chr(57344) || '\2', 'g')"
    return f"regexp_extract_all({marked}, '{PATTERN}')"


def row_tokens(table: str, key: str, text: str) -> str:
    return f"""
    doc_lists AS (SELECT {key} AS doc_id, {pretoken_list(text)} AS list FROM {table}),
    tokens AS (SELECT doc_id, unnest(list) AS pretoken,
                      generate_subscripts(list, 1) - 1 AS pos FROM doc_lists),
    counts AS (SELECT pretoken, count(*)::BIGINT AS n FROM tokens GROUP BY pretoken)"""


DOC_TOKENS = row_tokens("documents", "doc_id", "text")

_QUOTED = ", ".join(f"'{s}'" for s in SPECIALS)
_ALTERNATION = "|".join(
    s.replace("|", r"\|") for s in sorted(SPECIALS, key=len, reverse=True)
)
CHAT = f"""
    chat AS (SELECT conv_id * 100000 + turn AS chat_id,
                    '<|' || role || '|>' || text || CASE WHEN turn % 3 = 0
                        THEN '{DELIMITER}{DELIMITER}' ELSE '{DELIMITER}' END AS text
             FROM conversations)"""
CHAT_SEGMENTS = f"""{CHAT},
    parts AS (SELECT chat_id, string_split(regexp_replace(text, '({_ALTERNATION})',
                        chr(57344) || '\\1' || chr(57344), 'g'), chr(57344)) AS list
              FROM chat),
    split AS (SELECT chat_id, unnest(list) AS segment, generate_subscripts(list, 1) AS i FROM parts),
    segments AS (SELECT chat_id, segment,
                        row_number() OVER (PARTITION BY chat_id ORDER BY i) - 1 AS seg_pos
                 FROM split WHERE segment <> '')"""
CHAT_TOKENS = f"""{CHAT_SEGMENTS},
    seg_lists AS (SELECT chat_id, seg_pos, CASE WHEN segment IN ({_QUOTED}) THEN [segment]
                         ELSE {pretoken_list("segment")} END AS list FROM segments),
    tokens AS (SELECT chat_id, seg_pos, unnest(list) AS pretoken,
                      generate_subscripts(list, 1) - 1 AS pos FROM seg_lists),
    counts AS (SELECT pretoken, count(*)::BIGINT AS n FROM tokens GROUP BY pretoken)"""

HEX = "hex(encode(pretoken))"
WORDS = f"""
    words AS (SELECT regexp_replace({HEX}, '(..)', '|\\1|', 'g') AS word, n AS cnt FROM counts)"""
SYMBOLS = "string_split(substring(word, 2, length(word) - 2), '||')"
PAIRS = f"""
    positions AS (SELECT word, cnt, list, unnest(range(1, len(list))) AS i
                  FROM (SELECT word, cnt, {SYMBOLS} AS list FROM words)),
    pairs AS (SELECT list[i] AS l, list[i + 1] AS r, sum(cnt)::BIGINT AS n
              FROM positions GROUP BY 1, 2),
    ranked AS (SELECT (row_number() OVER (ORDER BY n DESC, l DESC, r DESC) - 1)::INT AS rank, l, r
               FROM pairs)"""


def with_(*parts: str, select: str) -> str:
    return f"WITH RECURSIVE {', '.join(parts)}\n{select}"


def training(n: int = TRAIN_MERGES) -> str:
    """`rounds` holds the words after each merge; `merges` is (rank, l, r)."""
    return f"""
    rounds AS (
        SELECT 0 AS step, word, cnt, '' AS l, '' AS r FROM words
        UNION ALL
        SELECT step + 1,
               replace(w.word, '|' || b.l || '||' || b.r || '|', '|' || b.l || b.r || '|'),
               w.cnt, b.l, b.r
        FROM rounds w, (
            SELECT list[i] AS l, list[i + 1] AS r
            FROM (SELECT list, cnt, unnest(range(1, len(list))) AS i
                  FROM (SELECT {SYMBOLS} AS list, cnt FROM rounds))
            GROUP BY 1, 2 ORDER BY sum(cnt) DESC, 1 DESC, 2 DESC LIMIT 1) b
        WHERE step < {n}),
    merges AS (SELECT DISTINCT (step - 1)::INT AS rank, l, r FROM rounds WHERE step > 0)"""


def vocabulary(merges: list[tuple[str, str]], specials: list[str] = ()) -> str:
    """(token_id, token_hex) for a given merge list."""
    base = len(specials)
    rows = [f"({i}, '{s.encode().hex().upper()}')" for i, s in enumerate(specials)]
    rows += [f"({base + b}, '{b:02X}')" for b in range(256)]
    rows += [f"({base + 256 + i}, '{left}{right}')" for i, (left, right) in enumerate(merges)]
    return f"vocab(token_id, token_hex) AS (VALUES {', '.join(rows)})"


def folded(merges: list[tuple[str, str]]) -> str:
    """`folds`: each different pretoken with its symbols after all merges."""
    word = f"regexp_replace({HEX}, '(..)', '|\\1|', 'g')"
    for left, right in merges:
        word = f"replace({word}, '|{left}||{right}|', '|{left}{right}|')"
    return f"""
    folds AS (SELECT pretoken, n, word, {SYMBOLS} AS list FROM
              (SELECT pretoken, n, {word} AS word FROM counts)),
    symbols AS (SELECT pretoken, unnest(list) AS token_hex,
                       generate_subscripts(list, 1) AS sym_pos FROM folds)"""


# ids of each pretoken; a symbol without an id falls apart into its bytes
PIECES = """
    pieces AS (
        SELECT pretoken, sym_pos, 0 AS sub_pos, token_id FROM symbols JOIN vocab USING (token_hex)
        UNION ALL
        SELECT pretoken, sym_pos, sub_pos, token_id FROM (
            SELECT pretoken, sym_pos, unnest(range(len(token_hex) // 2)) AS sub_pos,
                   token_hex[2 * sub_pos + 1 : 2 * sub_pos + 2] AS byte_hex
            FROM symbols WHERE token_hex NOT IN (SELECT token_hex FROM vocab)) s
        JOIN vocab v ON v.token_hex = s.byte_hex)"""
PIECE_LISTS = """
    lists AS (SELECT pretoken, string_agg(token_id::VARCHAR, ',' ORDER BY sym_pos, sub_pos) AS ids
              FROM pieces GROUP BY pretoken)"""
DOC_IDS = """
    SELECT d.doc_id, coalesce(e.ids, '') AS ids FROM documents d LEFT JOIN (
        SELECT doc_id, string_agg(ids, ',' ORDER BY pos) AS ids
        FROM tokens JOIN lists USING (pretoken) GROUP BY doc_id) e USING (doc_id)"""
DOC_ROWS = """
    doc_rows AS (SELECT doc_id, token_id, (row_number() OVER (
                     PARTITION BY doc_id ORDER BY pos, sym_pos, sub_pos) - 1)::INT AS pos
                 FROM tokens JOIN pieces USING (pretoken))"""

PARTIAL_VOCAB = vocabulary(SHORT_MERGES).replace("vocab(token_id", "every(token_id") + f""",
    vocab AS (SELECT * FROM every WHERE token_id < {256 + KNOWN_MERGES}
              AND token_hex NOT IN {ABSENT_BYTES})"""
# a special stays whole, so its only symbol is itself
SPECIAL_FOLDS = folded(SHORT_MERGES).replace(
    "AS list FROM\n", f"AS list0, CASE WHEN pretoken IN ({_QUOTED}) THEN [{HEX}] ELSE list0 END AS list FROM\n"
)
STEPS = [*range(TRAIN_STEP, TRAIN_MERGES + 1, TRAIN_STEP)]
TRAINED_VOCAB = f"""
    SELECT token_id, token_hex FROM vocab
    UNION ALL SELECT (rank + {N_SPECIALS + 256})::INT, l || r FROM merges"""
# the trained tokenizer on its own words
TRAINED_FOLDS = f"""
    folds AS (SELECT pretoken, n, word, {SYMBOLS} AS list FROM counts
              JOIN (SELECT word, replace(word, '|', '') AS bytes FROM rounds WHERE step = {TRAIN_MERGES})
              ON bytes = {HEX}),
    symbols AS (SELECT pretoken, unnest(list) AS token_hex,
                       generate_subscripts(list, 1) AS sym_pos FROM folds)"""
_EDGES = ", ".join("'" + e.replace("'", "''").replace("\0", "' || chr(0) || '") + "'" for e in EDGES)
EDGE_TEXTS = f"""
    chat AS (SELECT item_id AS chat_id, text || ([{_EDGES}])[item_id % {len(EDGES)} + 1] AS text
             FROM benchmark)"""
COUNTED_CHAT = f"""
    {CHAT_TOKENS}, {WORDS}"""

ORACLES: dict[str, str] = {
    "corpus_scan": "SELECT md5(text) AS text_md5, count(*)::BIGINT AS n FROM documents GROUP BY 1",
    "corpus_counts": with_(
        DOC_TOKENS,
        select=f"""SELECT pretoken, n FROM counts
                   UNION ALL SELECT '{DELIMITER}', count(*)::BIGINT FROM documents""",
    ),
    "corpus_decode": "SELECT doc_id, text FROM documents",
    "special_split": with_(
        CHAT_SEGMENTS,
        select=f"""SELECT chat_id, seg_pos::INT AS seg_pos, segment,
                          segment IN ({_QUOTED}) AS is_special FROM segments""",
    ),
    "pretoken_stream": with_(DOC_TOKENS, select="SELECT doc_id, pos::INT AS pos, pretoken FROM tokens"),
    "pretoken_counts": with_(DOC_TOKENS, select="SELECT pretoken, n FROM counts"),
    "pretoken_counts_special": with_(CHAT_TOKENS, select="SELECT pretoken, n FROM counts"),
    "corpus_stats": with_(
        DOC_TOKENS,
        select="""SELECT count(*)::BIGINT AS distinct_pretokens, sum(n)::BIGINT AS pretokens,
                         sum(n * strlen(pretoken))::BIGINT AS bytes,
                         max(strlen(pretoken))::BIGINT AS longest_pretoken FROM counts""",
    ),
    "byte_symbols": with_(
        DOC_TOKENS,
        WORDS,
        select="""SELECT replace(word, '||', '|') AS symbols, (length(word) // 4)::INT AS n_symbols, cnt
                  FROM words""",
    ),
    "pair_counts": with_(DOC_TOKENS, WORDS, PAIRS, select="SELECT l, r, n FROM pairs"),
    "pair_index": with_(
        DOC_TOKENS,
        WORDS,
        PAIRS,
        select="""SELECT list[i] AS l, list[i + 1] AS r, replace(word, '|', '') AS word,
                         string_agg((i - 1)::VARCHAR, ',' ORDER BY i) AS positions
                  FROM positions GROUP BY 1, 2, 3""",
    ),
    "best_pair": with_(
        DOC_TOKENS,
        WORDS,
        PAIRS,
        select="SELECT l, r, n FROM pairs ORDER BY n DESC, l DESC, r DESC LIMIT 1",
    ),
    "merge_once": with_(
        DOC_TOKENS,
        WORDS,
        select="""SELECT replace(word, '|', '') AS word,
                         replace(replace(word, '|{0}||{1}|', '|{0}{1}|'), '||', '|') AS merged, cnt
                  FROM words WHERE contains(word, '|{0}||{1}|')""".format(*SHORT_MERGES[0]),
    ),
    "train_bpe": with_(DOC_TOKENS, WORDS, training(), select="SELECT rank, l, r FROM merges"),
    "train_resume": with_(DOC_TOKENS, WORDS, training(), select="SELECT rank, l, r FROM merges"),
    "train_long": with_(
        row_tokens("benchmark", "item_id", "text"),
        WORDS,
        training(LONG_MERGES),
        select="SELECT rank, l, r FROM merges",
    ),
    "train_encode_decode": with_(
        DOC_TOKENS,
        WORDS,
        training(),
        vocabulary([], SPECIALS).replace("vocab(", "bytes_only("),
        f"vocab AS ({TRAINED_VOCAB.replace('FROM vocab', 'FROM bytes_only')})",
        TRAINED_FOLDS,
        PIECES,
        PIECE_LISTS,
        select=DOC_IDS.replace("d.doc_id,", "d.doc_id, d.text,"),
    ),
    "train_special": with_(COUNTED_CHAT, training(), select="SELECT rank, l, r FROM merges"),
    "train_without_special": with_(
        CHAT_TOKENS,
        WORDS.replace("FROM counts", f"FROM counts WHERE pretoken NOT IN ({_QUOTED})"),
        training(),
        select="SELECT rank, l, r FROM merges",
    ),
    "vocab_build": with_(
        DOC_TOKENS, WORDS, training(), vocabulary([], SPECIALS), select=TRAINED_VOCAB
    ),
    "checkpoint_write": with_(
        COUNTED_CHAT,
        training(),
        select=f"""SELECT replace(word, '||', '|') AS symbols, cnt FROM rounds
                   WHERE step = {TRAIN_MERGES}""",
    ),
    "training_history": with_(
        COUNTED_CHAT,
        training(),
        select=f"""SELECT 'step=' || s AS checkpoint, count(*)::INT AS merge_count,
                          (count(*) + {256 + N_SPECIALS})::INT AS vocab_size, count(*)::INT AS num_merges
                   FROM (SELECT unnest({STEPS}) AS s) JOIN merges ON rank < s GROUP BY s
                   UNION ALL
                   SELECT 'final', count(*)::INT, (count(*) + {256 + N_SPECIALS})::INT, count(*)::INT
                   FROM merges""",
    ),
    "save_load_roundtrip": with_(
        DOC_TOKENS,
        WORDS,
        PAIRS,
        vocabulary([], SPECIALS),
        select=f"""SELECT token_id, token_hex, NULL::VARCHAR AS l, NULL::VARCHAR AS r FROM vocab
                   UNION ALL
                   SELECT (rank + {256 + N_SPECIALS})::INT, l || r, l, r FROM ranked""",
    ),
    "load_merges": with_(DOC_TOKENS, WORDS, PAIRS, select="SELECT rank, l, r FROM ranked"),
    "load_gpt2_merges": with_(DOC_TOKENS, WORDS, PAIRS, select="SELECT rank, l, r FROM ranked"),
    "load_vocab": with_(
        DOC_TOKENS,
        WORDS,
        PAIRS,
        select="SELECT rank AS token_id, l || r AS token_hex, rank AS ins_order FROM ranked",
    ),
    "load_gpt2_vocab": with_(
        DOC_TOKENS,
        WORDS,
        PAIRS,
        vocabulary([], SPECIALS),
        select=f"""SELECT rank AS token_id, l || r AS token_hex, rank AS ins_order FROM ranked
                   UNION ALL
                   SELECT (size + token_id)::INT, token_hex, (size + token_id)::INT
                   FROM vocab, (SELECT count(*) AS size FROM ranked)
                   WHERE token_id < {N_SPECIALS}""",
    ),
    "vocab_add_specials": with_(
        DOC_TOKENS,
        WORDS,
        PAIRS,
        vocabulary([], SPECIALS),
        select=f"""SELECT rank AS token_id, l || r AS token_hex FROM ranked
                   UNION ALL
                   SELECT (size + token_id)::INT, token_hex
                   FROM vocab, (SELECT count(*) AS size FROM ranked)
                   WHERE token_id < {N_SPECIALS}""",
    ),
    "vocab_reverse": with_(
        DOC_TOKENS,
        WORDS,
        PAIRS,
        select="SELECT l || r AS token_hex, (-1 - rank)::INT AS token_id FROM ranked",
    ),
    "vocab_stats": with_(
        DOC_TOKENS,
        WORDS,
        PAIRS,
        vocabulary([], SPECIALS),
        select="""SELECT count(*)::BIGINT AS vocab_size,
                         count(DISTINCT token_hex)::BIGINT AS distinct_tokens,
                         max(length(token_hex) // 2)::INT AS longest_token,
                         (SELECT count(*) FROM ranked)::BIGINT AS num_merges
                  FROM (SELECT token_hex FROM vocab UNION ALL SELECT l || r FROM ranked)""",
    ),
    "special_list": with_(
        CHAT,
        select=f"""SELECT (i - 1)::INT AS pos, special,
                          (SELECT count(*) FROM chat WHERE contains(text, special))::BIGINT AS n_texts
                   FROM (SELECT unnest([{_QUOTED}]) AS special, unnest(range(1, {N_SPECIALS + 1})) AS i)""",
    ),
    "encode_words": with_(
        DOC_TOKENS,
        folded(MERGES),
        vocabulary(MERGES),
        select="""SELECT pretoken, any_value(n) AS n,
                         '|' || string_agg(token_hex, '|' ORDER BY sym_pos) || '|' AS symbols,
                         string_agg(token_id::VARCHAR, ',' ORDER BY sym_pos) AS ids
                  FROM (SELECT pretoken, n, unnest(list) AS token_hex,
                               generate_subscripts(list, 1) AS sym_pos FROM folds)
                  JOIN vocab USING (token_hex) GROUP BY pretoken""",
    ),
    "encode_docs": with_(
        DOC_TOKENS, folded(MERGES), vocabulary(MERGES), PIECES, PIECE_LISTS, select=DOC_IDS
    ),
    "encode_stream": with_(
        DOC_TOKENS, folded(SHORT_MERGES), vocabulary(SHORT_MERGES), PIECES, PIECE_LISTS, select=DOC_IDS
    ),
    "encode_tokens": with_(
        DOC_TOKENS,
        folded(SHORT_MERGES),
        vocabulary(SHORT_MERGES),
        PIECES,
        DOC_ROWS,
        select="SELECT doc_id, pos, token_id FROM doc_rows",
    ),
    "encode_special": with_(
        CHAT_TOKENS,
        SPECIAL_FOLDS,
        vocabulary(SHORT_MERGES, SPECIALS),
        PIECES,
        PIECE_LISTS,
        select="""SELECT chat_id, string_agg(ids, ',' ORDER BY seg_pos, pos) AS ids
                  FROM tokens JOIN lists USING (pretoken) GROUP BY chat_id""",
    ),
    "encode_fallback": with_(
        DOC_TOKENS, folded(SHORT_MERGES), PARTIAL_VOCAB, PIECES, PIECE_LISTS, select=DOC_IDS
    ),
    "encode_pages": with_(
        row_tokens("pages", "page_id", "html"),
        folded(MERGES),
        vocabulary(MERGES),
        PIECES,
        PIECE_LISTS,
        select=f"""SELECT doc_id AS page_id, ids FROM ({DOC_IDS.replace(
            "documents d", "(SELECT page_id AS doc_id FROM pages) d")})""",
    ),
    "encode_edges": with_(
        CHAT_TOKENS.replace(CHAT, EDGE_TEXTS),
        SPECIAL_FOLDS,
        vocabulary(SHORT_MERGES, SPECIALS),
        PIECES,
        PIECE_LISTS,
        select="""SELECT chat_id AS item_id, string_agg(ids, ',' ORDER BY seg_pos, pos) AS ids,
                         any_value(chat.text) AS text
                  FROM tokens JOIN lists USING (pretoken) JOIN chat USING (chat_id) GROUP BY chat_id""",
    ),
    "special_counts": with_(
        CHAT_SEGMENTS,
        select=f"""SELECT special, count(segment)::BIGINT AS n
                   FROM (SELECT unnest([{_QUOTED}]) AS special) LEFT JOIN segments ON segment = special
                   GROUP BY special""",
    ),
    "decode_docs": "SELECT doc_id, text FROM documents",
    "decode_tokens": "SELECT doc_id, text FROM documents",
    "decode_unknown": "SELECT doc_id, replace(text, chr(10), '') AS text FROM documents",
    "unknown_ids": with_(
        DOC_TOKENS,
        folded(SHORT_MERGES),
        vocabulary(SHORT_MERGES),
        PIECES,
        select=f"""SELECT token_id, sum(n)::BIGINT AS n FROM pieces JOIN counts USING (pretoken)
                   WHERE token_id >= {256 + KNOWN_MERGES} GROUP BY token_id""",
    ),
    "token_pieces": with_(
        DOC_TOKENS,
        folded(SHORT_MERGES),
        vocabulary(SHORT_MERGES),
        PIECES,
        select="""SELECT token_id, sum(n)::BIGINT AS n,
                         CASE WHEN token_hex = '20C3' THEN ' ' || chr(65533)
                              WHEN length(token_hex) = 2 AND token_hex >= '80' THEN chr(65533)
                              ELSE decode(unhex(token_hex)) END AS piece
                  FROM pieces JOIN counts USING (pretoken) JOIN vocab USING (token_id)
                  GROUP BY token_id, token_hex""",
    ),
    "roundtrip_audit": """SELECT lang, count(*)::BIGINT AS n_texts, count(*)::BIGINT AS n_equal,
                                 0::BIGINT AS n_different FROM documents GROUP BY lang""",
    "pretoken_counts_stream": with_(DOC_TOKENS, select="SELECT pretoken, n FROM counts"),
}
