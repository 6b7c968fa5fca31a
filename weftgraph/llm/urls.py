"""Operator 7: URL filters with link-graph propagation.

Rules on (host suffix, path prefix) decide the urls they fit, the longest rule
first.  All other urls are judged by their host: trust flows along hyperlinks
from hosts whose pages a rule allows (personalised PageRank), distrust flows
against them from hosts whose pages a rule blocks (who links to a blocked host
is distrusted), and a host whose distrust exceeds ``threshold`` times its trust
is blocked.

* Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
  lower-cased; path: from there up to ``?``, ``#`` or the end.  A null url or one
  without ``://`` has empty host and path, fits no rule and is allowed (an empty
  host is never scored).  A null page links nowhere.  Repeated pages count as
  often as they stand.  Extra columns are ignored.
* Edges come from absolute and protocol-relative links; links within a host are
  dropped.  They are aggregated to one row per host pair before anything else
  uses them, and scores to one row per host and direction, both with map-side
  partial sums, so a popular host is one row per task.
* Steps go on until the summed error of all scores is below ``BOUND``, so hosts at
  any distance from a seed get their score.  One sum every ``CUT_EVERY`` steps
  goes to the driver.
* Scores are rounded to 9 places before the comparison, since sums of doubles
  depend on their order.
* The SQL takes ``ROUNDS`` steps: its verdicts are the same where no longer walk
  counts.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, read, stash

#: Fixed values of the contract: (verdict, host, path prefix).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?i)(?:href|src)\s*=\s*[\"']?((?:https?:)?//[^\"'\s>]+)"
LINK_HOST = r"^(?:[A-Za-z]+:)?//([^/?#]*)"
DAMPING, ROUNDS, CUT_EVERY = 0.85, 8, 4
BOUND = 1e-10


def split_url(url):
    """(host, path) columns of a url column."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    return ascii_lower(F.regexp_extract(u, URL, 1)), F.regexp_extract(u, URL, 2)


def rule_of(host, path, rules=RULES):
    """(rule, verdict) columns: of the fitting rules the longest; a block goes before an allow of the same length."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block", r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """src, dst, n: links from host to other host."""
    links = pages.select(split_url(F.col(url))[0].alias("src"),
                         F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1))).alias("link"))
    return links.select("src", ascii_lower(F.regexp_extract("link", LINK_HOST, 1)).alias("dst")) \
        .where("src <> '' and dst <> '' and src <> dst") \
        .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, bound: float = BOUND) -> DataFrame:
    """Scores within ``bound`` of their limit in all: kind ('trust', 'distrust'), host, score.

    ``seeds``: kind, host, score.  ``edges``: src, dst, n.  Trust moves src to
    dst in proportion to the links out of src, distrust dst to src in proportion
    to the links into dst.  A host without links passes nothing on.
    """
    out = edges.groupBy("src").agg(F.sum("n").alias("s"))
    into = edges.groupBy("dst").agg(F.sum("n").alias("s"))
    flow = stash(edges.join(out, "src").select(F.lit("trust").alias("kind"), F.col("src").alias("host"),
                                               F.col("dst").alias("to"), (F.col("n") / F.col("s")).alias("share"))
                 .unionByName(edges.join(into, "dst").select(
                     F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"),
                     (F.col("n") / F.col("s")).alias("share"))), "flow")
    start = stash(seeds.select("kind", "host", (F.col("score") * (1 - damping)).alias("score")), "start")
    mass = start.agg(F.sum("score")).first()[0] or 0.0
    state, left = start, damping * mass / (1 - damping)  # a step leaves at most ``damping`` of the summed error
    shrink = damping ** CUT_EVERY
    for _ in range(math.ceil(math.log(max(left / bound, 1.0)) / -math.log(shrink))):
        before = state
        for _ in range(CUT_EVERY):
            moved = state.join(flow, ["kind", "host"]) \
                .select("kind", F.col("to").alias("host"), (F.col("score") * F.col("share") * damping).alias("score"))
            state = start.unionByName(moved).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        state = stash(state, "scores")
        gap = state.unionByName(before.withColumn("score", -F.col("score"))).groupBy("kind", "host") \
            .agg(F.abs(F.sum("score")).alias("gap")).agg(F.sum("gap")).first()[0] or 0.0
        if gap * shrink / (1 - shrink) < bound:
            break
    return state


def judge(pages: DataFrame, rules=RULES, threshold: float = 1.0, page_id: str = "page_id", url: str = "url",
          html: str = "html") -> DataFrame:
    """page_id, host, path, rule (null: none fits), verdict."""
    host, path = split_url(F.col(url))
    split = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = split.withColumn("rule", rule).withColumn("ruled", verdict)
    shares = ruled.where("host <> ''").groupBy("host").agg(
        (F.count_if(F.col("ruled") == "allow") / F.count(F.lit(1))).alias("trust"),
        (F.count_if(F.col("ruled") == "block") / F.count(F.lit(1))).alias("distrust"))
    seeds = stash(shares.select("host", F.explode(F.create_map(
        F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust"))).alias("kind", "score"))
        .where("score > 0").select("kind", "host", "score"), "seeds")
    scores = propagate(seeds, stash(host_edges(pages, url, html), "edges"))
    blocked = scores.groupBy("host").agg(
        F.round(F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)), 9).alias("t"),
        F.round(F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)), 9).alias("d")) \
        .where(F.col("d") > F.col("t") * threshold).select("host", F.lit(True).alias("bad"))
    return ruled.join(blocked, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"))


def _oracle() -> str:
    az = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    rounds = ",\n".join(
        f"s{i} AS MATERIALIZED (SELECT kind, host, sum(score) score FROM ("
        f"SELECT kind, host, score * {1 - DAMPING} score FROM seeds UNION ALL "
        f"SELECT s.kind, f.dst, s.score * f.share * {DAMPING} FROM s{i - 1} s JOIN flow f "
        "ON s.kind = f.kind AND s.host = f.src) GROUP BY ALL)" for i in range(1, ROUNDS + 1))
    return rf"""
WITH p AS (SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '{URL}', 1), {az}) host,
                  regexp_extract(coalesce(url, ''), '{URL}', 2) path FROM pages),
r AS (SELECT *, CASE
   WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND prefix(path, '/en/1') THEN 'example.org/en/1'
   WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND prefix(path, '/es/') THEN 'example.org/es/'
   WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/fr/') THEN 'com/fr/'
   WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/de/') THEN 'com/de/'
   WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/') THEN 'org/' END AS rule FROM p),
v AS (SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END ruled FROM r),
seeds AS MATERIALIZED (SELECT k.kind, host, sum(CASE WHEN ruled = k.verdict THEN 1.0 ELSE 0.0 END)::DOUBLE / count(*) score
   FROM v, (VALUES ('trust', 'allow'), ('distrust', 'block')) k(kind, verdict)
   WHERE host <> '' GROUP BY ALL HAVING score > 0),
l AS (SELECT host src, unnest(regexp_extract_all(html, '{LINK.replace("'", "''")}', 1)) link FROM p),
e AS MATERIALIZED (SELECT src, translate(regexp_extract(link, '{LINK_HOST}', 1), {az}) dst, count(*)::DOUBLE n FROM l
   GROUP BY ALL HAVING src <> '' AND dst <> '' AND src <> dst),
flow AS MATERIALIZED (SELECT 'trust' kind, src, dst, n / sum(n) OVER (PARTITION BY src) share FROM e UNION ALL
   SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM e),
s0 AS (SELECT * FROM seeds),
{rounds},
b AS (SELECT host FROM s{ROUNDS} GROUP BY host
   HAVING round(coalesce(sum(score) FILTER (kind = 'distrust'), 0), 9) > round(coalesce(sum(score) FILTER (kind = 'trust'), 0), 9))
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN host IN (SELECT host FROM b) THEN 'block' ELSE 'allow' END) AS verdict
FROM v
"""


ORACLE = _oracle()
