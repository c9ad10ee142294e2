"""A bounded breadth-first crawl over a table of pages, a level a round."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import absolute, canonical_url, host_key, in_scope, path, raw_links
from ..storage import stash


def links(pages: DataFrame) -> DataFrame:
    """(url, target): canonical, distinct links of pages (url, html)."""
    raw = pages.select(F.col("url").alias("page"), F.explode(raw_links(F.col("html"))).alias("link"))
    target = F.regexp_replace(absolute(F.col("page"), F.trim("link")), "#.*$", "")
    return raw.select(canonical_url(F.col("page")).alias("url"), canonical_url(target).alias("target")).filter(in_scope(F.col("target"))).distinct()


def crawl(pages: DataFrame, seeds: DataFrame, max_depth: int = 3, max_pages: int | None = None, robots: DataFrame | None = None, agent: str = "*") -> DataFrame:
    """(url, depth): pages reached from seeds (url) in at most ``max_depth`` hops, the nearest first, without those
    that robots files (host, text) keep ``agent`` from.

    Each level joins the frontier with the links and leaves out what was visited; the frontier is written to the
    shared folder, so a level never recomputes the ones before."""
    known = pages.select(canonical_url(F.col("url")).alias("url")).distinct()
    known = known if robots is None else stash(permitted(known, robot_rules(robots, agent)))
    edges = stash(links(pages).join(known.withColumnRenamed("url", "target"), "target", "left_semi"))
    visited = stash(seeds.select(canonical_url(F.col("url")).alias("url")).distinct().join(known, "url", "left_semi").withColumn("depth", F.lit(0)))
    frontier = visited
    for depth in range(1, max_depth + 1):
        reached = frontier.select("url").join(edges, "url").select(F.col("target").alias("url")).distinct()
        frontier = stash(reached.join(visited, "url", "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    return visited.orderBy("depth", "url").limit(max_pages) if max_pages else visited


def _groups(text: str) -> Iterator[tuple[list[str], list[tuple[str, str]]]]:
    """(agents, [(field, value)]) of each group of a robots file."""
    agents, rules, open_ = [], [], False
    for line in text.splitlines():
        name, colon, value = line.split("#", 1)[0].partition(":")
        name, value = name.strip().lower(), value.strip()
        if not colon:
            continue
        if name == "user-agent":
            if not open_ and agents:
                yield agents, rules
                agents, rules = [], []
            agents, open_ = [*agents, value.lower()], True
        elif name in ("allow", "disallow", "crawl-delay"):
            open_ = False
            rules.append((name, value))
    if agents:
        yield agents, rules


def robot_rules(robots: DataFrame, agent: str = "*") -> DataFrame:
    """(host, ord, field, value): what robots files (host, text) say to ``agent``: the first group that names it, else the
    first for all.  Unreadable or missing files say nothing."""
    me = agent.lower().split("/")[0]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = []
            for host, text in zip(part["host"], part["text"].fillna(""), strict=True):
                groups = list(_groups(text))
                mine = next((r for a, r in groups if any(x != "*" and x in me for x in a)), None)
                mine = next((r for a, r in groups if "*" in a), []) if mine is None else mine
                rows += [(host, i, f, v) for i, (f, v) in enumerate(mine)]
            yield pd.DataFrame(rows, columns=["host", "ord", "field", "value"])

    return robots.select("host", "text").mapInPandas(read, "host string, ord int, field string, value string")


def permitted(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls (url) that the rules allow: of a host's allow and disallow prefixes, the first that fits decides; an empty
    disallow allows, and hosts without rules allow everything."""
    some = rules.filter("field IN ('allow', 'disallow')").select("host", "ord", ((F.col("field") == "allow") | (F.col("value") == "")).alias("_ok"), F.col("value").alias("_v"))
    asked = urls.withColumns({"host": host_key(F.col("url")), "_w": F.when(path(F.col("url")) == "", F.lit("/")).otherwise(path(F.col("url")))})
    fits = F.startswith("_w", "_v")
    said = asked.select("url", "host", "_w").distinct().join(some, "host").filter(fits).groupBy("url").agg(F.min_by("_ok", "ord").alias("_ok"))
    return urls.join(said.filter("NOT _ok"), "url", "left_anti")


def crawl_delays(rules: DataFrame) -> DataFrame:
    """(host, seconds) of hosts that ask for a delay between two fetches."""
    return rules.filter("field = 'crawl-delay'").groupBy("host").agg(F.min_by(F.expr("try_cast(value AS DOUBLE)"), "ord").alias("seconds")).filter("seconds > 0")


def sitemap_urls(files: DataFrame, roots: DataFrame, max_depth: int = 2) -> DataFrame:
    """(url): pages that sitemap files (url, text) list, from the roots (url) through at most ``max_depth`` further levels
    of index files; only pages in scope."""
    # All that needs the text is taken before the rows multiply, since an expression beside explode is evaluated for every
    # row it makes; the address is then sought in the piece before each closing tag.
    closed = F.split("text", r"(?i)</(?:\w+:)?loc\s*>")
    read = files.select("url", F.rlike("text", F.lit(r"(?i)<(?:\w+:)?sitemapindex\b")).alias("_index"), F.slice(closed, 1, F.size(closed) - 1).alias("_p"))
    pieces = read.select("url", "_index", F.explode("_p").alias("_p"))
    loc = F.replace(F.regexp_extract("_p", r"(?is)<(?:\w+:)?loc\s*>\s*(.*?)\s*\z", 1), F.lit("&amp;"), F.lit("&"))
    listed = stash(pieces.select("url", "_index", loc.alias("_to")).filter("_to <> ''"))
    level, found = roots.select("url").distinct(), []
    seen = level
    for _ in range(max_depth + 1):
        opened = listed.join(level, "url", "left_semi")
        found.append(opened.filter("NOT _index").select(F.col("_to").alias("url")))
        level = stash(opened.filter("_index").select(F.col("_to").alias("url")).distinct().join(seen, "url", "left_anti"))
        if level.isEmpty():
            break
        seen = seen.unionByName(level)
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out.filter(in_scope(F.col("url"))).distinct()


def fingerprint(seeds: list[str], **scope: object) -> str:
    """Names what is crawled, not how far: a saved frontier may be taken up again only under the same fingerprint."""
    return hashlib.sha1(json.dumps({"seeds": sorted(seeds), **scope}, sort_keys=True, default=sorted).encode()).hexdigest()[:16]
