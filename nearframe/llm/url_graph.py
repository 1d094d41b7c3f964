"""URL filters by link-graph propagation.

Rules decide the urls they fit. Every other url goes by its host: trust spreads
from hosts whose pages are allowed along links (personalised PageRank), and
distrust from hosts whose pages are blocked against the links; a host is
blocked where distrust exceeds trust by a threshold. Column expressions and
joins only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearframe.llm.common import materialize, spread_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Host of an absolute link of a page.
LINK = "(?i)<a\\s[^>]*?href\\s*=\\s*[\"']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/\"'?#\\s<>]+)"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, F.lit("://"))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*", 0)
    path = F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*([^?#]*)", 1)
    return F.translate(raw, UPPER, LOWER), path


def fitting_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, rules``: the rules (rule, path, verdict) of each host and of the
    domains above it. Hosts are cut into their suffixes and meet the rules by
    an equi-join, whatever the number of rules."""
    parts = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    pairs = hosts.select("host", F.explode(suffixes).alias("rule_host")).join(rules, "rule_host")
    rule = F.struct(F.length("rule").alias("size"), F.col("rule"), F.col("rule_path").alias("path"), "verdict")
    return pairs.groupBy("host").agg(F.collect_set(rule).alias("rules"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-3, most: int = 500) -> DataFrame:
    """``seeds(host, trust, distrust)`` spread over ``edges(src, dst, n)``:
    trust along the links, distrust against them, each host sharing its score
    among its links by their number.

    What a round adds is at most ``damping`` of what the round before added, in
    sum over all hosts, so all later rounds together add at most
    ``damping / (1 - damping)`` of it. Rounds go on until that bound is below
    ``tolerance``, hence no host's score is farther from the settled one; beyond
    ``most`` rounds it fails. Joins cut the links of a hub into salts."""
    edges = materialize(edges, "url-edges")
    both = edges.select(F.lit(0).alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n").unionByName(
        edges.select(F.lit(1).alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n")
    )
    key = ["kind", "host"]
    total = materialize(both.groupBy(*key).agg(F.sum("n").alias("total"), F.count("*").alias("n")), "url-hubs")
    n_moves = 2 * edges.count()
    moves = spread_join(both.withColumnRenamed("n", "links"), total.drop("n"), key, total.drop("total"), n_moves)
    moves = materialize(moves.select("kind", "host", "to", (F.col("links") / F.col("total")).alias("w")), "url-moves")
    two = F.array(F.struct(F.lit(0).alias("kind"), F.col("trust").alias("seed")), F.struct(F.lit(1).alias("kind"), F.col("distrust").alias("seed")))
    start = seeds.select("host", F.explode(two).alias("s")).select("host", "s.*").where("seed > 0")
    added = materialize(start.select("kind", "host", (F.col("seed") * (1 - damping)).alias("x")), "url-added")
    parts = [added]
    for _ in range(most):
        left = added.agg(F.sum("x")).first()[0] or 0.0
        if not n_moves or left * damping / (1 - damping) <= tolerance:
            break
        sent = spread_join(moves, added, key, total.drop("total"), n_moves).select("kind", F.col("to").alias("host"), (F.col("x") * F.col("w") * damping).alias("x"))
        added = materialize(sent.groupBy(*key).agg(F.sum("x").alias("x")), "url-added")
        parts.append(added)
        if len(parts) > 16:
            parts = [materialize(_summed(parts), "url-score"), added.limit(0)]
    else:
        raise RuntimeError(f"scores did not settle in {most} rounds")
    score = _summed(parts)
    wide = score.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("x"))).alias("trust"), F.sum(F.when(F.col("kind") == 1, F.col("x"))).alias("distrust")
    )
    return wide.na.fill(0.0, ["trust", "distrust"])


def _summed(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("kind", "host").agg(F.sum("x").alias("x"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], page_id: str = "page_id", url: str = "url", html: str = "html", threshold: float = 0.05, damping: float = 0.85) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` per row.

    ``rules`` are (host, path, allow or block). A rule fits its host and all
    subdomains if the path starts with the rule's; the longest (host and path
    together) wins. Without a fitting rule the host's propagated score decides:
    block if distrust - trust > ``threshold``. A host's seeds are the shares of
    its pages that rules allow and block.

    Defined results: null urls and urls without ``://`` have an empty host and
    path and are allowed (nothing links to the empty host); null html has no
    links; rows that repeat are judged alike; an empty table gives an empty
    result; other columns are ignored.
    """
    spark = pages.sparkSession
    table = spark.createDataFrame([(h, p, h + p, v) for h, p, v in rules], "rule_host string, rule_path string, rule string, verdict string")
    host, path = host_path(F.col("u"))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("u"), F.col(html).cast("string").alias("h"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"), "h")
    # one host may hold a third of all pages: its rows are spread over salts
    known, n_pages = rows.groupBy("host").agg(F.count("*").alias("n")), pages.count()
    fits = fitting_rules(known, table)
    slim = spread_join(rows.drop("h"), fits, ["host"], known, n_pages, "left")
    best = F.array_max(F.filter(F.coalesce("rules", F.array()), lambda r: F.col("path").startswith(r["path"])))
    slim = materialize(slim.withColumn("best", best).select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("ruled")), "url-ruled")
    share = slim.groupBy("host").agg(F.count("*").alias("n"), F.count(F.when(F.col("ruled") == "allow", 1)).alias("a"), F.count(F.when(F.col("ruled") == "block", 1)).alias("b"))
    seeds = share.where("host <> ''").select("host", (F.col("a") / F.col("n")).alias("trust"), (F.col("b") / F.col("n")).alias("distrust"))
    links = F.transform(F.regexp_extract_all(F.coalesce("h", F.lit("")), F.lit(LINK), F.lit(1)), lambda x: F.translate(x, UPPER, LOWER))
    edges = rows.where("host <> ''").select(F.col("host").alias("src"), F.explode(links).alias("dst")).where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    score = propagate(edges, seeds, damping)
    out = spread_join(slim, score, ["host"], share, n_pages, "left").na.fill(0.0, ["trust", "distrust"])
    method = F.when(F.col("distrust") - F.col("trust") > threshold, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "trust", "distrust")
