"""URL filters: rules by host and path, and for what no rule covers the trust that links hand on.

A rule fits the urls of its host and of all subdomains whose path starts with the rule's path; the longest rule
wins (longest `host/path` text; of two equally long ones the blocking one). Pages that a rule decides are the
seeds: a host gets one unit of trust per allowed and one unit of distrust per blocked page. Both spread over the
edges between hosts, which the absolute links in the pages give: trust along the links (personalised PageRank
from the trusted seeds: who is linked by good hosts is good), distrust against them (who links to bad hosts is
bad). A host is blocked if its distrust is above `threshold` times its trust, otherwise allowed.

In one round a host keeps (1 - damping) of its seed and receives from each neighbour damping times its share of
the neighbour's value, shares being the number of linking pages. Values are whole numbers of 1 / SCALE units and
each contribution is rounded down by itself, so sums do not depend on their order and reruns agree. Hosts without
links hand nothing on. Rounds end after `rounds` or when nothing changes.

Scale: pages meet in aggregates that combine map-side (links to host pairs, seeds to hosts); each round joins two
written tables, host values and edges, whose hot partitions adaptive execution splits, and sums per host. Rules
are joined on the host's own suffixes, so their number may grow. Verdicts return to pages by a join of checked
size. The hosts of the graph are never collected.

Edge cases: a null url or one without `://` has empty host and path, fits no rule, and is allowed (no host, no
links); a null html has no links; links of a host with itself are ignored; repeated rows are judged alike and
count again as seeds, their links only once per page text; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scale import small_side
from .common import Scratch

#: Whole units in one unit of trust.
SCALE = 1 << 20
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: An absolute link of an anchor or area: what follows `//` up to the end of the value.
LINK = r"""(?is)<a(?:rea)?\s[^<>]*?\bhref\s*=\s*["']?\s*((?:https?:)?//[^\s"'<>]+)"""


@dataclass(frozen=True)
class GraphRules:
    damping: float = 0.85
    rounds: int = 20
    threshold: float = 1.0


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, with A-Z in lower case; '' without it."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), CAPITALS, CAPITALS.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; '' for none."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffixes_of(host: Column) -> Column:
    """The host and all its parent domains: a.b.c, b.c, c."""
    parts = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def match_rules(urls: DataFrame, rules: DataFrame, scratch: Scratch) -> DataFrame:
    """urls: host, path. rules: rule_host, rule_path, action. Returns distinct host, path with rule and action."""
    distinct = scratch.store(urls.filter("host <> ''").select("host", "path").distinct())
    fits = distinct.withColumn("rule_host", F.explode(suffixes_of(F.col("host")))).join(
        small_side(rules.select("rule_host", "rule_path", "action")), "rule_host").filter("startswith(path, rule_path)")
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("size"), (F.col("action") == "block").alias("blocks"),
                          rule.alias("rule"), "action")).alias("best")
    return scratch.store(fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.action"))


def host_links(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """pages: host, html. Edges src, dst between different hosts, with n, the number of different linking page texts."""
    # The same target in many links of a page counts once.
    targets = F.array_distinct(F.transform(
        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)),
        lambda link: host_of(F.concat(F.lit("http:"), F.regexp_replace(link, r"(?i)^https?:", "")))))
    told = pages.filter("host <> '' AND html LIKE '%//%'").select(
        F.col("host").alias("src"), F.xxhash64("html").alias("page"), F.explode(targets).alias("dst"))
    told = told.filter("src <> dst AND dst <> ''").dropDuplicates(["src", "dst", "page"])
    return scratch.store(told.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def _shares(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Edges as source, target, n, total (n of all edges of the source)."""
    turned = edges.select(F.col(source).alias("source"), F.col(target).alias("target"), "n")
    totals = turned.groupBy("source").agg(F.sum("n").alias("total"))
    return turned.join(totals, "source")


def _spread(seeds: DataFrame, edges: DataFrame, rules: GraphRules, scratch: Scratch) -> DataFrame:
    """seeds: host, seed (whole units). Values host, value after the rounds along edges source -> target."""
    own = F.floor(F.col("seed") * (1 - rules.damping)).cast("bigint")
    kept = scratch.store(seeds.select("host", own.alias("value")))
    values = kept
    for _ in range(rules.rounds):
        given = F.floor(F.col("value") * (rules.damping * F.col("n") / F.col("total"))).cast("bigint")
        sent = values.join(edges, values["host"] == edges["source"]).groupBy("target").agg(F.sum(given).alias("value"))
        new = scratch.store(kept.unionByName(sent.select(F.col("target").alias("host"), "value")).groupBy("host").agg(
            F.sum("value").alias("value")))
        same = values.exceptAll(new).isEmpty() and new.exceptAll(values).isEmpty()
        if values is not kept:
            scratch.drop(values)
        values = new
        if same:
            break
    return values


def host_scores(seeds: DataFrame, edges: DataFrame, rules: GraphRules, scratch: Scratch) -> DataFrame:
    """seeds: host, allowed, blocked (pages). Returns host, trust, distrust (units of one page) of all reached hosts."""
    unit = lambda c: (F.col(c) * SCALE).cast("bigint").alias("seed")
    forward, back = (scratch.store(_shares(edges, *ends)) for ends in (("src", "dst"), ("dst", "src")))
    trust = _spread(seeds.filter("allowed > 0").select("host", unit("allowed")), forward, rules, scratch)
    distrust = _spread(seeds.filter("blocked > 0").select("host", unit("blocked")), back, rules, scratch)
    both = trust.select("host", F.col("value").alias("t"), F.lit(0).cast("bigint").alias("d")).unionByName(
        distrust.select("host", F.lit(0).cast("bigint").alias("t"), F.col("value").alias("d")))
    return both.groupBy("host").agg((F.sum("t") / SCALE).alias("trust"), (F.sum("d") / SCALE).alias("distrust"))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (action, host, path)."""
    return spark.createDataFrame([tuple(r) for r in rules], "action string, rule_host string, rule_path string")


def judge_urls(pages: DataFrame, rules: DataFrame, keep: list[str], graph: GraphRules = GraphRules(),
               url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: `keep`, host, path, rule, verdict, trust and distrust of the host (null: not reached)."""
    scratch = Scratch(pages.sparkSession)
    names = {c: f"__keep{i}" for i, c in enumerate(keep)}
    address = F.col(f"`{url}`")
    urls = scratch.store(pages.select(
        *(F.col(f"`{c}`").alias(n) for c, n in names.items()), host_of(address).alias("host"), path_of(address).alias("path")))
    matched = match_rules(urls, rules, scratch).withColumnsRenamed({"host": "rule_of", "path": "rule_at"})
    ruled = urls.join(matched, (F.col("host") == F.col("rule_of")) & (F.col("path") == F.col("rule_at")), "left")
    ruled = scratch.store(ruled.drop("rule_of", "rule_at"))
    seeds = scratch.store(ruled.filter("rule IS NOT NULL").groupBy("host").agg(
        F.count_if(F.col("action") == "allow").alias("allowed"), F.count_if(F.col("action") == "block").alias("blocked")))
    edges = host_links(pages.select(host_of(address).alias("host"), F.col(f"`{html}`").alias("html")), scratch)
    scores = scratch.store(host_scores(seeds, edges, graph, scratch)).withColumnRenamed("host", "scored")
    judged = ruled.join(small_side(scores, written=True), F.col("host") == F.col("scored"), "left")
    bad = F.coalesce(F.col("distrust") > graph.threshold * F.col("trust"), F.lit(False))
    verdict = F.coalesce("action", F.when(bad, "block").otherwise("allow"))
    return judged.select(*(F.col(n).alias(c) for c, n in names.items()), "host", "path", "rule",
                         verdict.alias("verdict"), "trust", "distrust")
