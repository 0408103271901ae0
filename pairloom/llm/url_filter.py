"""URL filter by rules and a path-template tree with labelled purity.

Rules (host suffix and path prefix) come first; the longest that fits decides, and the pages they
decide are the labelled examples. All other pages are judged by the tree of their host: path segments
get a shape (numbers, hex words). Branches of one node are merged to a wildcard if they are rare (few
pages, and surely a small share of the node's) and statistically similar, that is if their shares of
blocked pages and of pages that end there do not differ from the node's by more than a Hoeffding bound.
Frequent segments stay apart, however many there are. A template is rejected if its purity, the share
of all its pages that a rule blocks, smoothed by the overall block rate (a half at most), is `REJECT`
or more: pages without a label count against it.

The tree is built level by level from counts for (host, shaped path), which are combined before the
shuffle; a hot host is a row for each of its paths, never its pages. Levels end where no two paths share a
node, as a single path has nothing to merge with.

Nulls: a null url, or one without ://, has an empty host and path; no rule fits an empty host. Equal
urls get equal verdicts. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import stored

FREQUENT = 0.1  # share of a node's pages that a variable segment is surely below
SPREAD = 0.2  # a segment with so many pages that their rates are known as well as this stands for itself
SMOOTHING = 4.0
REJECT = 0.7
DOUBT = 0.05  # chance of keeping similar branches apart
BROADCAST_TEMPLATES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls. Rules are (verdict, host/path)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule in sorted(rules, key=lambda r: len(r[1])):
        suffix, _, prefix = rule.partition("/")
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith("/" + prefix)
        name = F.when(fits, rule).otherwise(name)
        verdict = F.when(fits, decision).otherwise(verdict)
    return name, verdict


def shaped(path: Column) -> Column:
    """ARRAY<STRING>: the segments, numbers and hex words by their shape only."""
    return F.transform(
        F.filter(F.split(path, "/"), lambda s: s != ""),
        lambda s: F.regexp_replace(
            F.regexp_replace(s, r"(?<![0-9a-z])(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{8,}(?![0-9a-z])", "{hex}"),
            r"[0-9]+",
            "{n}",
        ),
    )


def _bound(n: Column) -> Column:
    return F.sqrt(F.lit(float(np.log(2 / DOUBT) / 2)) / n)


def template_tree(counts: DataFrame) -> DataFrame:
    """(host, shape, template) for each (host, shape, pages, labelled, blocked)."""
    start = counts.withColumn("template", F.array().cast("array<string>"))
    done, left, level = [start.where(F.size("shape") == 0)], start.where(F.size("shape") > 0), 0
    while not left.isEmpty():
        here = F.get("shape", F.lit(level))
        child = left.groupBy("host", "template", here.alias("segment")).agg(
            *[F.sum(c).alias(c) for c in ("pages", "blocked")],
            F.sum(F.when(F.size("shape") == level + 1, F.col("pages")).otherwise(0)).alias("ends"),
            F.count(F.lit(1)).alias("paths"),
        )
        node = child.groupBy("host", "template").agg(*[F.sum(c).alias(f"all_{c}") for c in ("pages", "blocked", "ends", "paths")])
        pages, all_pages = F.col("pages"), F.col("all_pages")
        same = lambda of: F.abs(F.col(of) / pages - F.col(f"all_{of}") / all_pages) <= _bound(pages) + _bound(all_pages)
        # the upper limit of a Poisson count, about 97.5 %
        rare = (_bound(pages) > SPREAD) & (pages + 2 + 2 * F.sqrt(pages + 1) < FREQUENT * all_pages)
        becomes = F.when(rare & same("blocked") & same("ends"), "*").otherwise(F.col("segment"))
        step = child.join(node, ["host", "template"]).select(
            "host", "template", "segment", becomes.alias("becomes"), (F.col("all_paths") == 1).alias("alone")
        )
        joined = left.withColumn("segment", here).join(step, ["host", "template", "segment"])
        rest = F.slice("shape", F.lit(level + 1), F.size("shape"))
        grown = F.concat("template", F.when(F.col("alone"), rest).otherwise(F.array("becomes")))
        finished = F.col("alone") | (F.size("shape") == level + 1)
        tree = stored(joined.select(*counts.columns, grown.alias("template"), finished.alias("finished")), "url-tree")
        done.append(tree.where("finished").drop("finished"))
        left, level = tree.where("not finished").drop("finished"), level + 1
    return reduce(DataFrame.unionByName, done)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every page."""
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, decision = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.select("*", rule.alias("rule"), decision.alias("decision"), shaped(F.col("path")).alias("shape"))
    counts = stored(
        ruled.groupBy("host", "shape").agg(
            F.count(F.lit(1)).alias("pages"),
            F.count("decision").alias("labelled"),
            F.count_if(F.col("decision") == "block").alias("blocked"),
        ),
        "url-counts",
    )
    total = counts.agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("blocked")).first()
    # a template without examples must not be rejected because most other pages are
    prior = min(total["blocked"] / total["n"], 0.5) if total["n"] else 0.0
    tree = template_tree(counts)
    purity = tree.groupBy("host", "template").agg(
        ((F.sum("blocked") + SMOOTHING * prior) / (F.sum("pages") + SMOOTHING)).alias("purity")
    )
    judged = stored(
        tree.join(purity, ["host", "template"]).select(
            "host", "shape", F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity"
        ),
        "url-templates",
    )
    if judged.count() <= BROADCAST_TEMPLATES:
        judged = F.broadcast(judged)
    verdict = F.coalesce("decision", F.when(F.col("purity") >= REJECT, "block").otherwise("allow"))
    return ruled.join(judged, ["host", "shape"]).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity"
    )
