"""Articles from MediaWiki dumps: redirects, markup, validation, skip reasons.

Null markup can't be cleaned. Markup is stripped by a single scan that matches braces, with
an own view of odd nesting; the rest is Column expressions.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sarangi.config import WikiConfig
from sarangi.functions.text import SPACE, has_script, is_blank, letter_script_ratio, nfc, ordered_replace, squeeze, strip

# Redirect words, marks of disambiguation pages, punctuation to shorten, namespaces of links without text.
REDIRECTS = ("#redirect", "#पुनर्निर्देशन", "#अनुप्रेषित")
DISAMBIGUATION = ("बहुविकल्पी", "(disambiguation)")
PUNCTUATION = [("।।", "।"), ("॥॥", "॥"), ("...", "…"), ("!!", "!"), ("??", "?"), (",,", ",")]
DROPPED_LINKS = ("category:", "श्रेणी:", "file:", "image:", "चित्र:", "फाइल:")
REASONS = ("wrong_namespace", "no_text", "is_redirect", "all_paragraphs_filtered", "cleaning_failed", "is_disambiguation", "too_short", "too_long", "no_devanagari", "low_devanagari_ratio")

_COMMENT = re.compile(r"<!--.*?-->", re.S)
_REF = re.compile(r"<ref\b[^>/]*/>|<ref\b[^>]*>.*?</ref\s*>", re.S | re.I)
_TABLE = re.compile(r"<table\b.*?</table\s*>", re.S | re.I)
_EXTERNAL = re.compile(r"\[(?:https?:)?//[^\]\n]*\]|\bhttps?://\S+")
_TAG = re.compile(r"</?[a-zA-Z][^>]*>")
_MARK = re.compile(r"\{\{|\}\}|\{\||\|\}|\[\[|\]\]")


def strip_markup(text: str) -> str:
    """Plain text: templates, tables, references, comments and external links go, links leave their label."""
    text = _TABLE.sub("", _REF.sub("", _COMMENT.sub("", text)))
    stack: list[tuple[str, list[str]]] = [("", [])]
    at = 0
    for m in _MARK.finditer(text):
        stack[-1][1].append(text[at : m.start()])
        at = m.end()
        mark = m[0]
        if mark in ("{{", "{|", "[["):
            stack.append((mark, []))
            continue
        opener = {"}}": "{{", "|}": "{|", "]]": "[["}[mark]
        if stack[-1][0] != opener:
            stack[-1][1].append(mark)
            continue
        inner = "".join(stack.pop()[1])
        if opener == "[[":
            link = inner.strip()
            if not link.lower().startswith(DROPPED_LINKS):
                stack[-1][1].append(link.lstrip(":").rsplit("|", 1)[-1])
    stack[-1][1].append(text[at:])
    while len(stack) > 1:  # what was never closed is text
        mark, parts = stack.pop()
        stack[-1][1].append(mark + "".join(parts))
    text = _TAG.sub("", _EXTERNAL.sub("", "".join(stack[0][1])))
    text = re.sub(r"'{2,}", "", text)
    text = re.sub(r"^=+\s*(.*?)\s*=+\s*$", r"\1", text, flags=re.M)
    text = re.sub(r"^[*#:;]+\s*", "", text, flags=re.M)
    return re.sub(r"__[A-Z]+__", "", text)


@F.pandas_udf(T.StringType())
def _strip(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None else strip_markup(t))


def is_redirect(markup: Column) -> Column:
    head = F.lower(strip(F.substring(F.coalesce(markup, F.lit("")), 1, 200)))
    out = F.lit(False)
    for word in REDIRECTS:
        out = out | head.startswith(word)
    return out


def clean_wikitext(markup: Column, config: WikiConfig = WikiConfig()) -> Column:
    """Cleaned text, or null where nothing is left or the script is missing."""
    text = nfc(_strip(markup))
    if config.normalize_punctuation:
        text = ordered_replace(text, PUNCTUATION)
    text = strip(squeeze(text))
    ok = F.length(text) > 0
    if config.require_script:
        ok = ok & has_script(markup)
    return F.when(ok, text)


def filter_paragraphs(text: Column, config: WikiConfig = WikiConfig()) -> Column:
    parts = F.transform(F.split(text, rf"\n[{SPACE}]*\n"), strip)
    return F.filter(parts, lambda p: F.length(p).between(config.min_paragraph_length, config.max_paragraph_length))


def skip_reason(title: Column, markup: Column, cleaned: Column, namespace: Column, config: WikiConfig = WikiConfig()) -> Column:
    """The first reason to leave an article out, or null."""
    out = F.when(~F.coalesce(namespace, F.lit(-1)).isin(*config.allowed_namespaces), "wrong_namespace")
    if config.skip_redirects:
        out = out.when(is_redirect(markup), "is_redirect")
    out = out.when(cleaned.isNull(), "cleaning_failed")
    if config.skip_disambiguation:
        head = F.substring(cleaned, 1, 500)
        marked = F.lit(False)
        for mark in DISAMBIGUATION:
            marked = marked | F.coalesce(title, F.lit("")).contains(mark) | head.contains(mark)
        out = out.when(marked, "is_disambiguation")
    out = out.when(F.length(cleaned) < config.min_article_length, "too_short")
    if config.max_article_length > 0:
        out = out.when(F.length(cleaned) > config.max_article_length, "too_long")
    if config.require_script:
        out = out.when(~has_script(cleaned), "no_devanagari")
    if config.min_script_ratio > 0:
        out = out.when(letter_script_ratio(cleaned) < config.min_script_ratio, "low_devanagari_ratio")
    return out


def articles(pages: DataFrame, config: WikiConfig = WikiConfig()) -> DataFrame:
    """Pages (title, ns, id, timestamp, markup) with cleaned text and skip_reason."""
    # Redirects and other namespaces are told before the costly step.
    cheap = F.col("ns").isin(*config.allowed_namespaces) & ~(is_redirect(F.col("markup")) if config.skip_redirects else F.lit(False))
    out = pages.withColumn("cleaned", clean_wikitext(F.when(cheap, F.col("markup")), config))
    paragraphs = F.array_join(filter_paragraphs(F.col("cleaned"), config), "\n\n")
    out = out.withColumn("__paragraphs", F.when(~is_blank(paragraphs), paragraphs))
    reason = skip_reason(F.col("title"), F.col("markup"), F.col("__paragraphs"), F.col("ns"), config)
    reason = F.when(cheap & F.col("markup").isNull(), "no_text").when(F.col("cleaned").isNotNull() & F.col("__paragraphs").isNull(), "all_paragraphs_filtered").otherwise(reason)
    return out.withColumn("skip_reason", reason).withColumn("cleaned", F.col("__paragraphs")).drop("__paragraphs")


def accepted(pages: DataFrame, config: WikiConfig = WikiConfig()) -> DataFrame:
    """text and the configured fields of the articles that stay; at most max_articles of them if set."""
    out = articles(pages, config).filter("skip_reason is null")
    names = {"title": F.col("title"), "page_id": F.col("id"), "timestamp": F.col("timestamp"), "namespace": F.col("ns")}
    out = out.select(F.col("cleaned").alias("text"), *(names[f].alias(f) for f in config.fields if f in names))
    return out.limit(config.max_articles) if config.max_articles else out


def skip_counts(judged: DataFrame) -> DataFrame:
    """(skip_reason, articles, percent of those skipped), the most frequent first."""
    counts = judged.filter("skip_reason is not null").groupBy("skip_reason").agg(F.count("*").alias("articles"))
    total = F.sum("articles").over(Window.partitionBy())  # over the few reasons
    return counts.withColumn("percent", F.round(100.0 * F.col("articles") / total, 2)).orderBy(F.desc("articles"), "skip_reason")
