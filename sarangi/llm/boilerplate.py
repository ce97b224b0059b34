"""Main content of pages by tag-path ratios, for pages whose markup is gone.

What is left of the tree is the line: its path is host > form > label, where the form is read
off the line itself (sentence, short line, list item, menu, date line, ...) and the label is
what stands before a colon or dash, if that label recurs in the corpus. Per path the length
of all text and of punctuated sentences are added up over all pages; the ratio on a host is
smoothed by that of the same form and label in the corpus, and paths above the threshold are
content. So tags or pointers to other stories are told from updates by the text that follows
such labels, not by a list. Then a page is fused: a line on a weak path (subheading, list
item) is content where it stands among content, up to the heading that begins the tail.
Forms that are furniture by themselves (titles, menus, dates, notices, replies) never are.

Lines that recur on at least MIN_URLS urls and MIN_SHARE of a host's urls, or CORPUS_SHARE
of all urls, are standing text. Null and empty contents have no lines; a page whose every
line is weak has no body; repeated rows give their lines again; a null title matches
nothing; ties at a threshold are content.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarangi.llm.lines import normal_line
from sarangi.session import stored

MIN_URLS, MIN_SHARE, CORPUS_SHARE = 3, 0.02, 0.005
#: A path is content from this share of its text in punctuated sentences; the corpus counts as so many characters of a host.
THRESHOLD, PRIOR_CHARS = 0.5, 500

BLANK, TITLE, MENU, CRUMB, DATE, NOTICE, REPLY, BYLINE, ITEM, SENTENCE, SHORT, RELATED, REPLIES = range(13)
FURNITURE = frozenset((BLANK, TITLE, MENU, CRUMB, DATE, NOTICE, REPLY, RELATED, REPLIES))

# Cues of page furniture, in the languages of the corpus.
RELATED_CUES = ("सम्बन्धित समाचार", "related", "ताजा अपडेट", "यो पनि पढ्नुहोस्", "छुटाउनुभयो कि", "लोकप्रिय", "थप समाचार", "read also", "also read", "more news", "trending", "most read")
REPLY_CUES = ("प्रतिक्रिया", "comment", "कमेन्ट")
DATE_CUES = ("published", "updated", "प्रकाशित", "प्रकाशित मिति", "अपडेट", "अद्यावधिक", "posted")
NOTICE_FORMS = (r"सूचना: .*बोलपत्र आह्वान", r"बिक्रीमा, सम्पर्कका लागि 0")
REPLY_FORMS = (r"\(0 (?:मिनेट|घण्टा|दिन|हप्ता|महिना|min|hour|day)\S* (?:अघि|ago)\)", r"बारे राम्रो खबर, धन्यवाद", r"^\S+ \S+: .* त कहिल्यै .*जस्तो छ")

_MENU = re.compile(r"(?:\s[|•›/»>·]\s|\s{3,}).*(?:\s[|•›/»>·]\s|\s{3,})")
_CRUMB = re.compile(r"\s[»›>]\s")
_ITEM = re.compile(r"^(?:[•*◦▪\-–—]\s|0[.)]\s)")
_END = re.compile(r"[।॥.?!…][”’\"')\]]*$")
_WHEN = re.compile(r"^(?:" + "|".join(map(re.escape, sorted(DATE_CUES, key=len, reverse=True))) + r")\s*[:–-]?\s*[0\-/.: ,]+$")
_LABEL = re.compile(r"^([^:–।]{1,40}?)\s*[:–]\s")
_NOTICE = re.compile("|".join(NOTICE_FORMS))
_REPLY = re.compile("|".join(REPLY_FORMS))
_NAME_PLACE = re.compile(r"^\S+ \S+(?:\s*[,/(]\s*\S+\)?)?$")
_BY = re.compile(r"^(?:by|लेखक)\b|संवाददाता|डेस्क|desk$")
#: Label of a short line that may be a name and a place.
NAME_LIKE = "?"
_TITLE_TAIL = re.compile(r"^\s*(?:\||::|-|–|—)\s*\S+(?:\s\S+)?$")


def form_of(norm: str, title: str, author: str) -> tuple[int, str]:
    """Form and label of a normalised line."""
    if not norm:
        return BLANK, ""
    if title and (norm == title or norm.startswith(title) and _TITLE_TAIL.match(norm[len(title):])):
        return TITLE, ""
    if title and title in norm and _CRUMB.search(norm) or norm.startswith(("गृहपृष्ठ »", "home »")):
        return CRUMB, ""
    if _WHEN.match(norm):
        return DATE, ""
    m = _LABEL.match(norm)
    label = m[1] if m else ""
    if _NOTICE.search(norm):
        return NOTICE, ""
    if _REPLY.search(norm):
        return REPLY, ""
    if norm.rstrip("?:").startswith(RELATED_CUES) and len(norm) < 30:
        return RELATED, ""
    if any(c in norm for c in REPLY_CUES) and len(norm) < 40 and not _END.search(norm):
        return REPLIES, ""
    if _ITEM.match(norm):
        return ITEM, label
    if _MENU.search(norm) and not _END.search(norm):
        return MENU, ""
    if _END.search(norm):
        return SENTENCE, label
    if author and author in norm and len(norm) < 3 * len(author) + 10 or _BY.search(norm) and len(norm) < 60:
        return BYLINE, ""
    if _NAME_PLACE.match(norm) and not label:
        return SHORT, NAME_LIKE
    return SHORT, label


def page_lines(pages: DataFrame, id_col: str = "record_id") -> DataFrame:
    """(id, host, url_key, lines array<struct(no, key, form, label, size, spoken)>), one row per page."""
    pages = pages.filter("content is not null and content != ''")
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:www\.)?([^/?#:]+)", 1))
    pages = pages.select(F.col(id_col).alias("id"), F.coalesce(host, F.col("site"), F.lit("")).alias("host"), F.xxhash64("url").alias("url_key"), "title", "author", "content")
    kind = dict(pages.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        known: dict[str, str] = {}
        for b in batches:
            offsets, cols = [0], [[] for _ in range(6)]
            for text, title, author in zip(b.column("content").to_pylist(), b.column("title").to_pylist(), b.column("author").to_pylist()):
                title, author = normal_line(title or ""), normal_line(author or "")
                for no, line in enumerate(text.split("\n")):
                    norm = known.get(line)
                    if norm is None:
                        norm = normal_line(line)
                        if len(known) > 50_000:
                            known.clear()
                        known[line] = norm
                    if not norm:
                        continue
                    form, label = form_of(norm if "   " not in line.strip() else line.strip().lower(), title, author)
                    size = len(norm)
                    for c, v in zip(cols, (no, digest(norm) - (1 << 63), form, label, size, size if _END.search(norm) else 0)):
                        c.append(v)
                offsets.append(len(cols[0]))
            types = (pa.int32(), pa.int64(), pa.int8(), pa.string(), pa.int32(), pa.int32())
            entry = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["no", "key", "form", "label", "size", "spoken"])
            lines = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entry)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("host"), b.column("url_key"), lines], ["id", "host", "url_key", "lines"])

    shape = f"id {kind}, host string, url_key bigint, lines array<struct<no: int, key: bigint, form: tinyint, label: string, size: int, spoken: int>>"
    return pages.mapInArrow(run, shape)


def standing(hashed: DataFrame) -> tuple[DataFrame, list[int]]:
    """Standing lines: (host, keys) per host, and those of the whole corpus as a list, which the
    share bounds: at most lines per page / CORPUS_SHARE."""
    seen = hashed.select("host", "url_key", F.explode(F.array_distinct(F.transform("lines", lambda x: x["key"]))).alias("key")).distinct()
    counts = stored(seen.groupBy("host", "key").agg(F.count("*").alias("urls")).filter("urls > 1"), "line-urls")
    sizes = hashed.select("host", "url_key").distinct().groupBy("host").agg(F.count("*").alias("host_urls"))
    total = hashed.select("host", "url_key").distinct().count()
    own = counts.filter(F.col("urls") >= MIN_URLS).join(sizes, "host").filter(F.col("urls") >= F.col("host_urls") * MIN_SHARE)
    wide = counts.groupBy("key").agg(F.sum("urls").alias("urls")).filter((F.col("urls") >= total * CORPUS_SHARE) & (F.col("urls") >= MIN_URLS))
    return own.groupBy("host").agg(F.collect_set("key").alias("standing")), [r["key"] for r in wide.select("key").collect()]


def recurring_labels(hashed: DataFrame) -> list[str]:
    """Labels on at least CORPUS_SHARE of all pages; there can't be more than a page's lines divided by that."""
    pages = hashed.count()
    labels = hashed.select(F.explode(F.array_distinct(F.transform("lines", lambda x: x["label"]))).alias("label")).filter(~F.col("label").isin("", NAME_LIKE))
    counts = labels.groupBy("label").agg(F.count("*").alias("n")).filter((F.col("n") >= MIN_URLS) & (F.col("n") >= pages * CORPUS_SHARE))
    return [r["label"] for r in counts.select("label").collect()]


def path_scores(hashed: DataFrame, labels: list[str]) -> DataFrame:
    """(host, form, label, ratio): the smoothed share of punctuated text per path."""
    leaf = F.when(F.col("l.label").isin(*labels), F.col("l.label")).otherwise("") if labels else F.lit("")
    lines = hashed.select("host", F.explode("lines").alias("l")).select("host", "l.form", leaf.alias("label"), "l.size", "l.spoken")
    paths = lines.groupBy("host", "form", "label").agg(F.sum("size").alias("size"), F.sum("spoken").alias("spoken"))
    whole = paths.groupBy("form", "label").agg((F.sum("spoken") / F.sum("size")).alias("prior"))
    ratio = (F.col("spoken") + PRIOR_CHARS * F.col("prior")) / (F.col("size") + PRIOR_CHARS)
    return paths.join(whole, ["form", "label"]).select("host", "form", "label", ratio.alias("ratio"))


def body_flags(lines: list[dict], stand: set[int], strong: set[tuple[int, str]], labels: frozenset[str]) -> list[bool]:
    """Which of a page's non-blank lines are body."""
    n = len(lines)
    form = [x["form"] for x in lines]
    fixed = [x["key"] in stand for x in lines]
    path = [(f, x["label"] if x["label"] in labels else "") for f, x in zip(form, lines)]
    solid = [p in strong and p[0] not in FURNITURE and not s for p, s in zip(path, fixed)]
    first = next((i for i in range(n) if solid[i]), n)
    # The tail begins at a heading of other stories or of replies that follows content.
    end = next((i for i in range(first, n) if form[i] == RELATED or form[i] == REPLIES and fixed[i]), n)
    body = [solid[i] and i < end for i in range(n)]
    # Weak lines take on their neighbours; those whose recurring label marks them don't, nor bylines.
    weak = [form[i] in (ITEM, SHORT) and not fixed[i] and not path[i][1] for i in range(n)]
    for i in range(first + 1, end):
        body[i] = body[i] or weak[i]
    # Subheadings or items straight before the first content, with no other head line between.
    i = first - 1
    while i >= 0 and weak[i] and lines[i]["label"] != NAME_LIKE and first < n:
        body[i] = True
        i -= 1
    return body


def content_flags(pages: DataFrame, id_col: str = "record_id") -> DataFrame:
    """(id_col, line_no, is_body) of every non-blank line."""
    hashed = stored(page_lines(pages, id_col), "page-lines")
    per_host, corpus = standing(hashed)
    found = recurring_labels(hashed)
    strong = path_scores(hashed, found).filter(F.col("ratio") >= THRESHOLD)
    strong = strong.groupBy("host").agg(F.collect_set(F.struct("form", "label")).alias("strong"))
    per_host = per_host.join(strong, "host", "full_outer")
    joined = hashed.select("id", "host", "lines").join(per_host, "host", "left")
    kind = dict(hashed.dtypes)["id"]
    corpus_set, labels = frozenset(corpus), frozenset(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts: dict[str, tuple] = {}
        for b in batches:
            ids, nos, flags = [], [], []
            names = b.column("host").to_pylist()
            for i, (id_, host, lines) in enumerate(zip(b.column("id").to_pylist(), names, b.column("lines").to_pylist())):
                if host not in hosts:
                    hosts[host] = (
                        corpus_set | set(b.column("standing")[i].as_py() or ()),
                        {(w["form"], w["label"]) for w in b.column("strong")[i].as_py() or ()},
                    )
                for x, f in zip(lines, body_flags(lines, *hosts[host], labels)):
                    ids.append(id_)
                    nos.append(x["no"])
                    flags.append(f)
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.column("id").type), pa.array(nos, pa.int64()), pa.array(flags, pa.bool_())], ["id", "line_no", "is_body"])

    return joined.mapInArrow(run, f"id {kind}, line_no bigint, is_body boolean").withColumnRenamed("id", id_col)
