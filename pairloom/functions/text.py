"""Splitting text into special tokens and pretokens, and bytes back into text.

Everything is a built-in Spark expression, so it runs inside the scan stage and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DELIMITER = "<|endoftext|>"

# The pretoken pattern. Java's own \s knows ASCII only, so the Unicode white-space
# class is spelled out as WS.
WS = r"\t-\r\x{85}\p{Z}"
PRETOKEN_PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)"
    r"| ?\p{L}+"
    r"| ?\p{N}+"
    rf"| ?[^{WS}\p{{L}}\p{{N}}]+"
    rf"|[{WS}]+(?![^{WS}])"
    rf"|[{WS}]+"
)

REPLACEMENT = "�"
REPLACEMENT_AS_BYTES = REPLACEMENT.encode("utf-8").decode("latin-1")


def clean_specials(specials: Sequence[str] | None) -> list[str]:
    """The special tokens in list order, each once."""
    out = list(dict.fromkeys(specials or ()))
    if "" in out:
        raise ValueError("a special token must not be empty")
    return out


def _quote(token: str) -> str:
    return "".join(c if c.isalnum() or ord(c) > 127 else "\\" + c for c in token)


def special_alternation(specials: Sequence[str]) -> str:
    """Regex of the specials as a trie, the longest first where several match.

    A place of the text is compared with one character of the trie after another, and a node with many
    branches is searched by halves, so the cost grows with the length of a match and hardly with the
    number of specials.
    """
    trie: dict = {}
    for special in specials:
        node = trie
        for c in special:
            node = node.setdefault(c, {})
        node[""] = {}
    return _trie_pattern(trie)


def _trie_pattern(node: dict) -> str:
    chain = ""
    while len(node) == 1 and "" not in node:
        ((c, node),) = node.items()
        chain += _quote(c)
    branches = sorted((c, child) for c, child in node.items() if c)
    if not branches:
        return chain
    return f"{chain}{_branches_pattern(branches)}{'?' if '' in node else ''}"


def _branches_pattern(branches: list[tuple[str, dict]]) -> str:
    if len(branches) <= 4:
        return f"(?:{'|'.join(_quote(c) + _trie_pattern(child) for c, child in branches)})"
    low, high = branches[: len(branches) // 2], branches[len(branches) // 2 :]
    within = rf"[\x{{{ord(low[0][0]):x}}}-\x{{{ord(low[-1][0]):x}}}]"
    return f"(?:(?={within}){_branches_pattern(low)}|{_branches_pattern(high)})"


def _holds_special(text: Column, specials: Sequence[str]) -> Column:
    return F.regexp_like(text, F.lit(special_alternation(specials)))


def segments(text: Column, specials: Sequence[str] | None = None) -> Column:
    """ARRAY<STRING>: the specials and the text between them, in order, without empty parts.

    One leftmost scan: take a special where one starts, else run up to the next special or the end.
    The substring test keeps ordinary text off that scan.
    """
    specials = clean_specials(specials)
    text = F.coalesce(text, F.lit(""))
    whole = F.filter(F.array(text), lambda s: s != "")
    if not specials:
        return whole
    alt = special_alternation(specials)
    scan = F.regexp_extract_all(text, F.lit(rf"(?s)(?:{alt})|.+?(?=(?:{alt})|\z)"), F.lit(0))
    return F.when(_holds_special(text, specials), scan).otherwise(whole)


def pretokens(text: Column, specials: Sequence[str] | None = None) -> Column:
    """ARRAY<STRING>: all pretokens of a text in order; a special token is one element.

    The pattern runs on each segment alone, so white space before a special counts as trailing.
    An ordinary pretoken never equals a special, since segments hold none.
    """
    specials = clean_specials(specials)
    text = F.coalesce(text, F.lit(""))
    plain = F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), F.lit(0))
    if not specials:
        return plain
    split = F.flatten(
        F.transform(
            segments(text, specials),
            lambda s: F.when(s.isin(specials), F.array(s)).otherwise(
                F.regexp_extract_all(s, F.lit(PRETOKEN_PATTERN), F.lit(0))
            ),
        )
    )
    return F.when(_holds_special(text, specials), split).otherwise(plain)


def lenient_decode(data: Column) -> Column:
    """BINARY to STRING, dropping bytes that are not UTF-8.

    `make_valid_utf8` marks bad bytes with U+FFFD. U+FFFD characters that were in the data are
    cut out before and put back after, so only the marks are dropped. Valid rows are a plain cast.
    """
    as_text = data.cast("string")
    parts = F.split(F.decode(data, "ISO-8859-1"), REPLACEMENT_AS_BYTES)
    mended = F.transform(
        parts,
        lambda p: F.replace(
            F.make_valid_utf8(F.encode(p, "ISO-8859-1").cast("string")),
            F.lit(REPLACEMENT),
            F.lit(""),
        ),
    )
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(F.array_join(mended, REPLACEMENT))


def hex_to_text(token_hex: Column) -> Column:
    """Hex bytes to STRING; bytes that are not UTF-8 become U+FFFD."""
    return F.make_valid_utf8(F.unhex(token_hex).cast("string"))
