"""Articles from HTML pages: title, body, author, date, category, tags, images.

One pass of the standard library's parser builds a small tree, in Arrow batches. Null pages
give nulls; unclosed paragraphs end where the next begins; what can't be parsed gives what
was read so far.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sarangi.functions.text import nfc, word_count
from sarangi.operators.urls import article_id, category, normalize

# Class names that mark content and authors, tags to leave out, characters to delete.
CONTENT_CLASSES = ("article-content", "entry-content", "post-content", "content", "main-content", "story-content", "news-content", "article-body")
AUTHOR_CLASSES = ("author", "author-name", "by-author", "article-author")
ARTICLE_NOISE, DIV_NOISE = ("script", "style", "iframe", "nav", "aside"), ("script", "style", "iframe")
INVISIBLE = r"[\x{200b}\x{200c}\x{feff}\x{ad}]"
MIN_CONTENT, MAX_TAGS, MAX_IMAGES = 100, 10, 5
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self, skip: tuple[str, ...] = ()) -> Iterator["Node"]:
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            if node.tag in skip:
                continue
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def find(self, tag: str | None = None, skip: tuple[str, ...] = (), **attrs: str) -> "Node | None":
        return next((n for n in self.walk(skip) if (tag is None or n.tag == tag) and all(n.attrs.get(k) == v for k, v in attrs.items())), None)

    def text(self, skip: tuple[str, ...] = ()) -> str:
        out, stack = [], [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                out.append(x)
            elif x is self or x.tag not in skip:
                stack.extend(reversed(x.children))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag == "p" and any(n.tag == "p" for n in self.open):
            self.handle_endtag("p")
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _meta(root: Node, **attrs: str) -> str | None:
    for n in root.walk():
        if n.tag == "meta" and all(n.attrs.get(k) == v for k, v in attrs.items()):
            return n.attrs.get("content", "").strip() or None
    return None


def title(root: Node) -> str | None:
    found = _meta(root, property="og:title") or _meta(root, name="title")
    if found:
        return found
    node = root.find("title")
    if node:
        return re.sub(r"\s*[|\-]\s*[^|]+$", "", node.text().strip())
    node = root.find("h1")
    return node.text().strip() if node else None


def _paragraphs(node: Node, skip: tuple[str, ...]) -> str:
    return "\n\n".join(t for p in node.walk(skip) if p.tag == "p" and (t := p.text(skip).strip()))


def content(root: Node) -> str | None:
    article = root.find("article")
    if article and len(t := _paragraphs(article, ARTICLE_NOISE)) > MIN_CONTENT:
        return t
    for name in CONTENT_CLASSES:
        div = next((n for n in root.walk() if n.tag == "div" and any(name in c.lower() for c in n.attrs.get("class", "").split())), None)
        if div and len(t := _paragraphs(div, DIV_NOISE)) > MIN_CONTENT:
            return t
    text = _paragraphs(root, ())
    return text if len(text) > MIN_CONTENT else None


def author(root: Node) -> str | None:
    found = _meta(root, name="author") or _meta(root, property="article:author")
    if found:
        return found
    for name in AUTHOR_CLASSES:
        node = next((n for n in root.walk() if any(name in c.lower() for c in n.attrs.get("class", "").split())), None)
        if node:
            return node.text().strip()
    return None


def date(root: Node) -> str | None:
    found = _meta(root, property="article:published_time")
    if found:
        return found
    node = root.find("time")
    if node:
        return node.attrs.get("datetime") or node.text().strip()
    return _meta(root, name="publish-date")


def tags(root: Node) -> list[str]:
    """Sorted, at most ten."""
    found = {t.strip() for t in (_meta(root, name="keywords") or "").split(",")}
    found |= {n.attrs.get("content", "").strip() for n in root.walk() if n.tag == "meta" and n.attrs.get("property") == "article:tag"}
    return sorted(found - {""})[:MAX_TAGS]


def images(root: Node) -> list[str]:
    out = [x for x in [_meta(root, property="og:image")] if x]
    article = root.find("article")
    if article:
        for img in [n for n in article.walk() if n.tag == "img"][:MAX_IMAGES]:
            src = img.attrs.get("src") or img.attrs.get("data-src") or ""
            if src.startswith("http"):
                out.append(src)
    return out


def links(root: Node, base: str) -> list[str]:
    return sorted({urljoin(base, n.attrs["href"]) for n in root.walk() if n.tag == "a" and n.attrs.get("href")})


def normalize_text(text: Column) -> Column:
    """Form C, invisible characters but the joiner deleted, white space squeezed; null stays null."""
    from sarangi.functions.text import squeeze, strip

    return strip(squeeze(F.regexp_replace(nfc(text), INVISIBLE, "")))


def extract(pages: DataFrame) -> DataFrame:
    """Articles of pages (url, html): url, article_id, title, content, author, published_date,
    category, tags, images, word_count, char_count."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for url, html in zip(pdf["url"], pdf["html"]):
                root = parse(html or "")
                rows.append((url, title(root), content(root), author(root), date(root), _meta(root, property="article:section"), ",".join(tags(root)) or None, ",".join(images(root)) or None))
            yield pd.DataFrame(rows, columns=["url", "title", "content", "author", "published_date", "section", "tags", "images"])

    out = pages.select("url", "html").mapInPandas(run, "url string, title string, content string, author string, published_date string, section string, tags string, images string")
    out = out.withColumns({c: normalize_text(F.col(c)) for c in ("title", "content", "author", "tags")})
    return out.select(
        "url", article_id(F.col("url")).alias("article_id"), "title", "content", "author", "published_date", F.coalesce(category(F.col("url")), "section").alias("category"), "tags", "images",
        F.coalesce(word_count(F.col("content")), F.lit(0)).alias("word_count"), F.coalesce(F.length("content").cast("bigint"), F.lit(0)).alias("char_count"),
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Distinct (url, target) of pages (url, html), targets in the crawler's canonical form."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(u, t) for u, h in zip(pdf["url"], pdf["html"]) if u for t in links(parse(h or ""), u)], columns=["url", "target"])

    found = pages.select("url", "html").mapInPandas(run, "url string, target string")
    return found.withColumn("target", normalize(F.col("target"))).filter("target is not null").distinct()


def scrape_status(status_code: Column, content_: Column) -> Column:
    """dead_link for 404 and 410, failed for other failures, empty for short content, else success."""
    fetched = status_code == 200
    return (
        F.when(status_code.isin(404, 410), "dead_link")
        .when(status_code.isNull() | ~fetched, "failed")
        .when(content_.isNull() | (F.length(content_) < MIN_CONTENT), "empty")
        .otherwise("success")
    )


def to_scrape(urls: DataFrame, log: DataFrame, max_retries: int = 3) -> DataFrame:
    """Urls without a final log entry: successes and dead links are done, others may be retried."""
    done = log.filter(F.col("status").isin("success", "dead_link") | (F.coalesce("retry_count", F.lit(0)) >= max_retries))
    return urls.join(done.select("url").distinct(), "url", "left_anti")


def update_log(log: DataFrame, attempts: DataFrame) -> DataFrame:
    """The log after attempts (url, article_id, scraped_at, status, error_message): latest wins, the
    retry count of a url goes up with each attempt after its first."""
    last = attempts.groupBy("url").agg(F.max(F.struct("scraped_at", "article_id", "status", "error_message")).alias("v"), F.count("*").alias("tries"))
    new = last.join(log.select("url", F.col("retry_count").alias("before")), "url", "left")
    new = new.select("url", "v.article_id", "v.scraped_at", "v.status", "v.error_message", (F.coalesce(F.col("before") + 1, F.lit(0)) + F.col("tries") - 1).cast("bigint").alias("retry_count"))
    kept = log.join(last.select("url"), "url", "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def scrape_metrics(log: DataFrame) -> DataFrame:
    """One row: processed, succeeded, failed, success_rate in percent."""
    ok = F.coalesce(F.sum(F.when(F.col("status") == "success", 1).otherwise(0)), F.lit(0))
    out = log.agg(F.count("*").alias("processed"), ok.alias("succeeded"))
    rate = F.when(F.col("processed") > 0, 100.0 * F.col("succeeded") / F.col("processed")).otherwise(0.0)
    return out.select("processed", "succeeded", (F.col("processed") - F.col("succeeded")).alias("failed"), F.round(rate, 2).alias("success_rate"))
