"""Urls: canonical forms, filters, the crawl frontier and robots rules.

Null urls give null or false throughout.
"""

from __future__ import annotations

import urllib.robotparser
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sarangi.session import stored

# Query parameters that only track visitors, for the strict and the crawler's form.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "yclid", "_ga", "_gid", "ref", "referrer", "source")
CRAWL_TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "msclkid", "mc_cid", "mc_eid", "_ga", "_gl", "ref", "source")
# Where an article's number stands in a url, in order.
ARTICLE_IDS = (r"/(\d{6,})/", r"/story/(\d+)", r"/news/(\d+)", r"/articles/([a-z0-9]+)", r"/(\d{4}/\d{2}/\d{2})/([^/]+)$")

_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _part(url: Column, n: int) -> Column:
    return F.regexp_extract(url, _PARTS, n)


def _decode(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(x), x)


def _encode(x: Column) -> Column:
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _query(url: Column, drop: tuple[str, ...], keep_blank: bool) -> Column:
    """(key, value) pairs without those dropped, decoded."""
    pairs = F.filter(F.split(_part(url, 4), "&"), lambda p: p.contains("=") | F.lit(keep_blank) & (p != ""))
    pairs = F.transform(pairs, lambda p: F.struct(_decode(F.substring_index(p, "=", 1)).alias("k"), F.when(p.contains("="), _decode(F.regexp_replace(p, "^[^=]*=", ""))).otherwise("").alias("v")))
    names = F.array(*map(F.lit, drop))
    return F.filter(pairs, lambda p: ~F.array_contains(names, F.lower(p["k"])) & (F.lit(keep_blank) | (p["v"] != "")))


def _join_query(pairs: Column) -> Column:
    text = F.array_join(F.transform(pairs, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")
    return F.when(text != "", F.concat(F.lit("?"), text)).otherwise("")


def normalize_strict(url: Column) -> Column:
    """https, lower-case host, no trailing slashes, no fragment, no `;params`, no blank or tracking
    parameters; null for other schemes."""
    url = F.trim(url)
    path = F.regexp_replace(_part(url, 3), r";[^/]*$", "")
    path = F.when(path == "", "/").when((path != "/") & path.endswith("/"), F.regexp_replace(path, "/+$", "")).otherwise(path)
    out = F.concat(F.lit("https://"), F.lower(_part(url, 2)), path, _join_query(_query(url, TRACKING, False)))
    return F.when(F.lower(_part(url, 1)).isin("http", "https"), out)


def normalize(url: Column) -> Column:
    """The crawler's form: scheme kept, default ports dropped, one trailing slash dropped, parameters
    sorted, blank ones kept, tracking ones dropped, no fragment; null for other schemes."""
    scheme, host, path = F.lower(_part(url, 1)), F.lower(_part(url, 2)), _part(url, 3)
    host = F.when((scheme == "http") & host.endswith(":80"), F.regexp_replace(host, ":80$", "")).when((scheme == "https") & host.endswith(":443"), F.regexp_replace(host, ":443$", "")).otherwise(host)
    path = F.when((F.length(path) > 1) & path.endswith("/"), F.regexp_replace(path, "/$", "")).otherwise(path)
    # Values of one name keep their order: names sort alone.
    pairs = _query(url, CRAWL_TRACKING, True)
    keyed = F.array_sort(F.transform(pairs, lambda p, i: F.struct(p["k"].alias("k"), i.alias("i"), p["v"].alias("v"))))
    return F.when(scheme.isin("http", "https"), F.concat(scheme, F.lit("://"), host, path, _join_query(keyed)))


def host(url: Column) -> Column:
    return _part(url, 2)


def in_domains(url: Column, domains: Column) -> Column:
    h = host(url)
    return _part(url, 1).startswith("http") & F.exists(domains, lambda d: (h == d) | h.endswith(F.concat(F.lit("."), d)))


def matches_any(url: Column, patterns: Column) -> Column:
    return F.exists(patterns, lambda p: F.regexp_like(url, p))


def allowed(url: Column, domains: Column, exclude: Column) -> Column:
    return F.coalesce(in_domains(url, domains) & ~F.coalesce(matches_any(url, exclude), F.lit(False)), F.lit(False))


def is_article(url: Column, patterns: Column) -> Column:
    """Any pattern found; without patterns every url may be an article."""
    return (F.size(patterns) <= 0) | F.coalesce(matches_any(url, patterns), F.lit(False))


def article_id(url: Column) -> Column:
    """The first pattern's number with slashes as hyphens, else twelve characters of the url's MD5."""
    found = [F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in ARTICLE_IDS]
    return F.coalesce(F.replace(F.coalesce(*found), F.lit("/"), F.lit("-")), F.substring(F.md5(url), 1, 12))


def category(url: Column) -> Column:
    """The first of the two leading path segments that is longer than two and no number."""
    segments = F.slice(F.split(_part(url, 3), "/"), 2, 2)
    return F.get(F.filter(segments, lambda s: (F.length(s) > 2) & ~s.rlike(r"^\d+$")), F.lit(0))


def with_sites(urls: DataFrame, sites: DataFrame, url_col: str = "url") -> DataFrame:
    """Each url with the settings of the site whose domain its host is."""
    domains = sites.select(F.explode("allowed_domains").alias("__host"), *[c for c in sites.columns if c not in urls.columns])
    return urls.withColumn("__host", F.lower(host(F.col(url_col)))).join(domains, "__host", "left").drop("__host")


def frontier_stats(urls: DataFrame) -> DataFrame:
    """One row: total, visited, pending, articles; 0 for an empty table."""
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).alias
    return urls.agg(F.count("*").alias("total"), n(F.col("visited") == 1)("visited"), n(F.col("visited") == 0)("pending"), n(F.col("is_article") == 1)("articles"))


def next_urls(urls: DataFrame, limit: int = 1) -> DataFrame:
    """The next urls to visit, by depth; the url settles ties."""
    return urls.filter("visited = 0").orderBy("depth", "url").limit(limit)


def enqueue(urls: DataFrame, found: DataFrame) -> DataFrame:
    """The frontier with new urls at their least depth; urls already there stay as they are."""
    fresh = found.filter("url is not null").groupBy("url").agg(F.min("depth").alias("depth"), F.max("is_article").alias("is_article"))
    fresh = fresh.join(urls.select("url"), "url", "left_anti").withColumn("visited", F.lit(0))
    return urls.unionByName(fresh, allowMissingColumns=True)


def mark_visited(urls: DataFrame, visits: DataFrame) -> DataFrame:
    """Set visited and status_code from (url, status_code)."""
    v = visits.groupBy("url").agg(F.max("status_code").alias("__status"), F.lit(1).alias("__hit"))
    out = urls.join(v, "url", "left")
    out = out.withColumn("visited", F.when(F.col("__hit") == 1, 1).otherwise(F.col("visited")))
    return out.withColumn("status_code", F.when(F.col("__hit") == 1, F.col("__status")).otherwise(F.col("status_code"))).drop("__status", "__hit")


def depth_counts(urls: DataFrame) -> DataFrame:
    return urls.groupBy("depth").agg(F.count("*").alias("urls"))


def crawl_status(urls: DataFrame, now: Column, by: str = "host", active_minutes: int = 10) -> DataFrame:
    """Per host: counts, share visited, last activity and COMPLETE, ACTIVE, STALLED or QUEUED."""
    rows = urls.withColumn(by, F.lower(host(F.col("url")))) if by == "host" else urls
    out = rows.groupBy(by).agg(
        F.count("*").alias("total"), F.sum(F.when(F.col("visited") == 1, 1).otherwise(0)).alias("visited"), F.sum(F.when(F.col("visited") == 0, 1).otherwise(0)).alias("pending"),
        F.max("depth").alias("max_depth"), F.max(F.when(F.col("visited") == 1, F.col("discovered_at"))).alias("last_activity"),
    )
    idle = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("last_activity").cast("timestamp"))
    status = F.when((F.col("pending") == 0) & (F.col("visited") > 0), "COMPLETE").when(F.col("last_activity").isNull(), "QUEUED").when(idle < active_minutes * 60, "ACTIVE").otherwise("STALLED")
    return out.withColumn("percent", F.round(100.0 * F.col("visited") / F.col("total"), 1)).withColumn("status", status)


def age(seconds: Column) -> Column:
    """Seconds as '5s ago', '3m ago', '2h 5m ago' or '4d 3h ago'."""
    q = lambda n, d: F.floor(n / d).cast("string")
    return (
        F.when(seconds < 60, F.concat(seconds.cast("bigint").cast("string"), F.lit("s ago")))
        .when(seconds < 3600, F.concat(q(seconds, 60), F.lit("m ago")))
        .when(seconds < 86400, F.concat(q(seconds, 3600), F.lit("h "), q(seconds % 3600, 60), F.lit("m ago")))
        .otherwise(F.concat(q(seconds, 86400), F.lit("d "), q(seconds % 86400, 3600), F.lit("h ago")))
    )


def progress_bar(percent: Column, width: int = 30) -> Column:
    full = F.floor(width * percent / 100).cast("int")
    return F.concat(F.lit("["), F.repeat(F.lit("█"), full), F.repeat(F.lit("░"), F.lit(width) - full), F.lit("] "), F.lpad(F.format_string("%.1f", percent), 5, " "), F.lit("%"))


def crawl(seeds: DataFrame, links: DataFrame, max_depth: int) -> DataFrame:
    """Breadth-first levels over (url, target) links from (url) seeds: (url, depth), each at its least
    depth. One join a level; every level is written, so that lineage doesn't grow."""
    seen = stored(seeds.filter("url is not null").select("url").distinct().withColumn("depth", F.lit(0)), "crawl-level")
    level = seen
    for depth in range(1, max_depth + 1):
        nxt = level.join(links, "url").select(F.col("target").alias("url")).filter("url is not null").distinct()
        level = stored(nxt.join(seen.select("url"), "url", "left_anti").withColumn("depth", F.lit(depth)), "crawl-level")
        if level.isEmpty():
            break
        seen = seen.unionByName(level)
    return seen


def robots_allowed(urls: DataFrame, rules: DataFrame, agent: str = "*", fail_open: bool = False) -> DataFrame:
    """`urls` with `robots_ok` by robots.txt texts (host, robots_txt); hosts without one follow `fail_open`."""
    hosts = rules.select(F.lower("host").alias("__host"), "robots_txt")
    joined = urls.withColumn("__host", F.lower(host(F.col("url")))).join(hosts, "__host", "left")
    fields = ", ".join(f"`{n}` {t}" for n, t in urls.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parsers: dict[str, urllib.robotparser.RobotFileParser] = {}
        for pdf in batches:
            ok = []
            for h, text, url in zip(pdf["__host"], pdf["robots_txt"], pdf["url"]):
                if text is None or url is None:
                    ok.append(fail_open and url is not None)
                    continue
                if h not in parsers:
                    parsers[h] = urllib.robotparser.RobotFileParser()
                    parsers[h].parse(text.splitlines())
                ok.append(parsers[h].can_fetch(agent, url))
            yield pdf.drop(columns=["__host", "robots_txt"]).assign(robots_ok=ok)

    return joined.mapInPandas(run, f"{fields}, robots_ok boolean")
