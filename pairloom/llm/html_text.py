"""Main text of web pages, with a host-wide suffix array against boilerplate.

A page is cut into blocks. Blocks inside an article (or main) element are main text; menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader comments, known by element,
role, or a whole class or id, are not. A class or id does not hide a page's longest article. All blocks outside articles are joined to one token stream per page, and
the streams of a host to one array of suffixes: only common prefixes of `RUN` tokens or more matter,
so suffixes are grouped by their first `RUN` tokens (by hash, which splits any host over all tasks) and
neighbours on distinct pages mark repeated substrings. Pages with the same stream are one page there.
On pages without an article, runs that are on a good part of the host's pages go, blocks that
consist of such on half of them too, and the rest stays; a page of nothing else keeps its text. An article
beside unique text of more than `LONGER` times its words is one block of many, and that text stays too.

The suffix array alone cannot decide: article lines recur on a host's pages too, and must stay. So an
article element protects its blocks.

Nulls: null or empty html gives an empty text; a null url is a host of its own; a page without an id
takes no part in the suffix array and keeps its blocks. Repeated rows are pages with one stream. Other
columns are not looked at. Unclosed elements and broken markup never fail, and very long pages take time in
proportion to their length. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.common import WordHasher, by_bytes, gram_hashes, mixed, stored, text_bytes
from pairloom.llm.windows import Streams, shared_windows

RUN = 6
PART = 3
OFTEN, OFTEN_PAGES = 0.1, 4  # share of a host's different pages, and how many at least, that make a run boilerplate
LONGER = 2  # times the words of the articles that unique text outside them must have to be main text too
LETTERS = {"main": "m", "other": "o", "out": "x"}
BROADCAST_PLACES = 1_000_000

MARKUP = re.compile(r"<!--|<[!?]|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)")
TAG_END = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
WORD = re.compile(r"[a-z]+")
# Element names and the words that name page furniture.
BLOCKS = set(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe label legend li main menu nav noscript ol option p"
    " pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "template", "noscript", "iframe", "textarea", "title", "svg", "math")
FURNITURE = set("head nav menu aside footer form dialog select button option datalist object audio video canvas".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies disqus footer login masthead menu modal nav navbar navigation newsletter notice notices pagination"
    " popup promo promoted promotion recommended related replies reply share sharing sidebar signup social sponsor"
    " sponsored subscribe toolbar".split()
)
# Whole class or id values that have other words than these.
COMPOUNDS = set(
    "comment-list comment-respond comments-area main-nav main-navigation nav-links page-footer post-navigation"
    " related-articles related-posts share-buttons sharing-buttons site-footer site-header site-nav"
    " site-navigation social-links".split()
)
# Elements that hold text themselves; inside an article, no class or id hides them.
TEXT_LEVEL = set("p h1 h2 h3 h4 h5 h6 blockquote pre dd dt td th caption figcaption".split())
MAIN = ("article", "main")
ROOTS = ("html", "body")
END_OF_RAW = {tag: re.compile(rf"</{tag}\b[^>]*+(?:>|\Z)", re.I) for tag in RAW}


def _furniture(tag: str, attrs: dict[str, str], in_main: bool) -> bool:
    """Known by element, role or hiding attribute."""
    if tag in FURNITURE or tag == "header" and not in_main or attrs.get("role") in ROLES:
        return True
    hides = "hidden" in attrs or attrs.get("aria-hidden") == "true"
    return hides or bool(re.search(r"display\s*:\s*none", attrs.get("style", "")))


def _named(attrs: dict[str, str]) -> bool:
    """A class or id is a furniture word, or several joined; has-sidebar says another thing."""
    tokens = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
    return any(t in COMPOUNDS or bool(words := WORD.findall(t)) and NAMES.issuperset(words) for t in tokens)


def _attributes(attrs: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(attrs) if attrs.strip() else ():
        found.setdefault(name.lower(), value.strip("\"'").lower())
    return found


class _Open:
    """An open element that decides something, or may enclose such."""

    __slots__ = ("tag", "hidden", "named", "main", "words", "up", "depth")

    def __init__(self, tag: str, hidden: bool, named: bool, main: bool, around: _Open | None):
        self.tag, self.hidden, self.named, self.main = tag, hidden, named, main
        self.words = 0  # of a main element: those not in a hidden or named element or a main one inside
        self.up = around  # the nearest named element around it
        self.depth = around.depth + named if around else int(named)  # named ones around it, itself included

    @property
    def decides(self) -> bool:
        return self.hidden or self.named or self.main

    @property
    def nearest(self) -> _Open | None:
        """The nearest named element, itself included."""
        return self if self.named else self.up


class _Tags:
    """Where tags end. Quotes may hold a >, until a tag would not end that way: from then on, the first
    > ends a tag. So a page is read once, or twice if it is broken."""

    def __init__(self, html: str):
        self.html, self.quotes = html, True

    def end(self, at: int) -> int:
        """The place after the tag whose name ends at `at`; -1 if it does not end."""
        start = at
        while self.quotes:
            hit = TAG_END.search(self.html, at)
            if hit is not None and hit.group() == ">":
                return hit.end()
            at = self.html.find(hit.group(), hit.end()) + 1 if hit is not None else 0
            self.quotes = at > 0
        return self.html.find(">", start) + 1 or -1


def blocks(html: str) -> list[tuple[str, str]]:
    """(text, zone) in page order; zone is main, other (outside articles) or out (page furniture).

    A class or id never hides html or body, nor an article (or main) element or what is around one,
    unless another article of the page that is not named so is longer; nor, inside an article, a
    paragraph, heading or other element that holds text itself. The time is linear in the page."""
    cut: list[tuple[str, bool, _Open | None, bool]] = []  # text, hidden, nearest named element, in main
    mains_seen: list[_Open] = []
    parts: list[str] = []
    open_: list[_Open] = []
    n_open: Counter[str] = Counter()
    mains: list[_Open] = []  # those open
    hidden = 0  # elements open that hide
    named: _Open | None = None  # the nearest open one
    tags = _Tags(html)
    at = 0

    def flush() -> None:
        text = " ".join(unescape("".join(parts)).split())
        if text:
            if mains and not hidden and (named.depth if named else 0) == mains[-1].depth:
                mains[-1].words += text.count(" ") + 1
            cut.append((text, hidden > 0, named, bool(mains)))
        parts.clear()

    def close() -> _Open:
        nonlocal hidden, named
        last = open_[-1]
        if last.decides:
            flush()
            hidden -= last.hidden
            if last.main:
                mains.pop()
            if last.named:
                named = last.up
        n_open[last.tag] -= 1
        return open_.pop()

    while at < len(html):
        hit = MARKUP.search(html, at)
        if hit is None:
            parts.append(html[at:])
            break
        parts.append(html[at : hit.start()])
        if not hit["tag"]:
            closing = "-->" if hit.group() == "<!--" else ">"
            end = html.find(closing, hit.end())
            at = end + len(closing) if end >= 0 else len(html)
            continue
        at = tags.end(hit.end())
        if at < 0:  # no tag ends any more: the rest is text
            parts.append(html[hit.start() :])
            break
        tag, attributes = hit["tag"].lower(), html[hit.end() : at - 1]
        if hit["end"]:
            if tag in BLOCKS:
                flush()
            if n_open[tag]:
                while close().tag != tag:
                    pass
            continue
        if tag in RAW:
            if tag in BLOCKS:
                flush()
            end_of_raw = END_OF_RAW[tag].search(html, at)
            at = end_of_raw.end() if end_of_raw else len(html)
            continue
        if tag in BLOCKS:
            flush()
            if open_ and open_[-1].tag == "p":  # a paragraph ends where the next block starts
                close()
        if tag in VOID or attributes.endswith("/"):
            continue
        attrs = _attributes(attributes)
        is_main = tag in MAIN or attrs.get("role") == "main"
        if tag in ROOTS:
            element = _Open(tag, False, False, is_main, named)
        else:
            is_named = not (mains and tag in TEXT_LEVEL) and _named(attrs)
            element = _Open(tag, _furniture(tag, attrs, bool(mains)), is_named, is_main, named)
        # only elements that decide something, or that may enclose such, need to be matched
        if element.decides or tag in BLOCKS and tag != "p":
            if element.decides:
                flush()
                hidden += element.hidden
                named = element.nearest
            open_.append(element)
            n_open[tag] += 1
            if is_main:
                mains.append(element)
                mains_seen.append(element)
    flush()

    longest = max((m.words for m in mains_seen if not m.depth), default=0)
    shown: set[int] = set()
    for m in mains_seen:
        around = m.nearest if m.words and m.words >= longest else None
        while around is not None and id(around) not in shown:
            shown.add(id(around))
            around = around.up
    covered: dict[int, bool] = {}  # whether a named element, or one around it, is not shown

    def is_covered(element: _Open | None) -> bool:
        chain = []
        while element is not None and id(element) not in covered:
            chain.append(element)
            element = element.up
        below = element is not None and covered[id(element)]
        for e in reversed(chain):
            below = covered[id(e)] = below or id(e) not in shown
        return below

    return [
        (text, "out" if is_hidden or is_covered(around) else "main" if in_main else "other")
        for text, is_hidden, around, in_main in cut
    ]


def _is_open(words: list[int], zones: list[str]) -> bool:
    """No article has text, or the text outside of articles and furniture is much longer."""
    main, other = (sum(n for n, z in zip(words, zones) if z == zone) for zone in "mo")
    return other > LONGER * main


def _parsed_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, page_id, url, content, is_open, zones, text): a line of text and a letter of zones (m, o, x) for
    each block. Content tells different streams of a host apart; without a page id there is none. Open pages
    are those whose repeated runs matter."""
    hasher = WordHasher()
    for part in by_bytes(batches, 3):
        found = [blocks(h.decode("utf-8")) for h in text_bytes(part.column(3))]
        streams = [" ".join(text for text, zone in page if zone != "main").encode("utf-8") for page in found]
        hosts = part.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        keys = [gram_hashes(t, len(t)) if len(t) else t for t in hasher.each(streams)]
        contents = mixed(np.array([k[0] if len(k) else 0 for k in keys], np.uint64) ^ mixed(hosts)).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                part.column(1),
                part.column(2),
                pc.if_else(pc.is_valid(part.column(1)), pa.array(contents), pa.scalar(None, pa.int64())),
                pa.array([_is_open([t.count(" ") + 1 for t, _ in page], [LETTERS[z] for _, z in page]) for page in found]),
                pa.array(["".join(LETTERS[zone] for _, zone in page) for page in found], pa.string()),
                pa.array(["\n".join(text for text, _ in page) for page in found], pa.string()),
            ],
            names=["host", "page_id", "url", "content", "is_open", "zones", "text"],
        )


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[Streams]:
    """The outside streams of (host, content, zones, text)."""
    hasher = WordHasher()
    for part in by_bytes(batches, 3):
        scopes, contents = (part.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        texts = [
            b" ".join(line for line, z in zip(text.split(b"\n"), zones) if z != "m")
            for text, zones in zip(text_bytes(part.column(3)), part.column(2).to_pylist())
        ]
        yield Streams(scopes, contents, np.zeros(len(texts), np.int32), contents, hasher.each(texts))


def page_text(text: str, zones: str, often: list[int], half: list[int], run: int = RUN) -> str:
    """The page's main text; `often` and `half` are the starts of repeated runs in its outside stream:
    words of the first go, and blocks that consist of either."""
    lines = text.split("\n") if zones else []
    main = [line for line, z in zip(lines, zones) if z == "m"]
    if main and not _is_open([line.count(" ") + 1 for line in lines], zones):
        return "\n".join(main)
    gone = {p for start in often for p in range(start, start + run)}
    in_blocks = gone | {p for start in half for p in range(start, start + run)}
    kept, at, unique = [], 0, 0
    for line, z in zip(lines, zones):
        if z == "m":
            kept.append(line)
            continue
        # the stream's words are those between ASCII spaces, and a block has no other of those
        words = line.split(" ")
        if z == "o" and not all(i in in_blocks for i in range(at, at + len(words))):
            stay = [w for i, w in enumerate(words, at) if i not in gone]
            if stay:
                kept.append(" ".join(stay))
                unique += len(stay)
        at += len(words)
    if main and unique <= LONGER * sum(line.count(" ") + 1 for line in main):
        return "\n".join(main)
    # a page that is repeated whole keeps its text
    return "\n".join(kept or [line for line, z in zip(lines, zones) if z == "o"])


@F.arrow_udf(T.StringType())
def _texts(texts: pa.Array, zones: pa.Array, often: pa.Array, half: pa.Array) -> pa.Array:
    rows = zip(text_bytes(texts), zones.to_pylist(), often.to_pylist(), half.to_pylist())
    return pa.array([page_text(t.decode("utf-8"), z, a or [], b or []) for t, z, a, b in rows], pa.string())


def boilerplate(parsed: DataFrame) -> DataFrame:
    """(content, often, half), stored: where in each content repeated runs of the host start. Different
    contents are counted, so copies of a page are one. Often: in `OFTEN` of the host's contents, and
    `OFTEN_PAGES`; half: in half of them, where there are more than two. Fewer may share a quotation."""
    streams = parsed.where("content is not null").select("host", "content", "zones", "text")
    windows = shared_windows(streams, _streams, size=RUN, part=PART)
    on_host = parsed.where("content is not null").groupBy("host").agg(F.count_distinct("content").alias("contents"))
    host_of = parsed.where("content is not null").select(F.col("content").alias("owner"), "host").distinct()
    shared = (
        windows.select("h1", "h2", "owner").distinct()
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("pages"), F.min("owner").alias("owner"))
        .where("pages > 1")
    )
    enough = (
        shared.join(host_of, "owner").join(on_host, "host")
        .select(
            "h1",
            "h2",
            ((F.col("pages") >= OFTEN_PAGES) & (F.col("pages") >= OFTEN * F.col("contents"))).alias("is_often"),
            ((2 * F.col("pages") >= F.col("contents")) & (F.col("contents") > 2)).alias("is_half"),
        )
        .where("is_often or is_half")
    )
    wanted = parsed.where("is_open").select(F.col("content").alias("owner")).distinct()
    return stored(
        windows.join(wanted, "owner", "left_semi").join(enough, ["h1", "h2"])
        .groupBy(F.col("owner").alias("content"))
        .agg(*[F.collect_set(F.when(F.col(f"is_{c}"), F.col("at"))).alias(c) for c in ("often", "half")]),
        "repeated-runs",
    )


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    rows = pages.select(
        F.xxhash64(F.lower(F.regexp_extract("url", r"^.*?://([^/?#]*)", 1))).alias("host"),
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    schema = "host bigint, page_id bigint, url string, content bigint, is_open boolean, zones string, text string"
    parsed = stored(rows.mapInArrow(_parsed_task, schema), "pages", compression="zstd")
    gone = boilerplate(parsed)
    if (gone.agg(F.sum(F.size("often") + F.size("half") + 4)).first()[0] or 0) <= BROADCAST_PLACES:
        gone = F.broadcast(gone)
    return parsed.join(gone, "content", "left").select("page_id", "url", _texts("text", "zones", "often", "half").alias("text"))
