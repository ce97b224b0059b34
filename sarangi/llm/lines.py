"""Lines that a site repeats on many of its pages, kept as incremental counts.

State, as tables in the shared folder: of each (site, line) the number of distinct urls that
hold it, the urls of each site, blank ones too, the lines of each page, all as 64-bit hashes,
the lines that stand and each page's numbers of them.
A new partition of pages is merged as a delta: its (site, line, url) triples are made, and of
those urls that came before, the triples already counted are taken out. Only lines of the delta
and lines that stand can change their standing; a line crosses when its count reaches both
thresholds, or falls below the share as its site grows. Only pages that hold a line whose
standing changed are rebuilt, of whatever partition they are; texts are never read again.

Lines are the same if equal in NFC and lower case, trimmed, with runs of white space as one
space and runs of ASCII or Devanagari digits as one digit. Null contents and sites take no
part, and null urls count for nothing; blank lines are numbered but never cases; a line
repeated on one page counts once; repeated rows of one url count once, and each gives its
lines; pages may have any other columns.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sarangi.session import new_path, stored

MIN_URLS, MIN_SHARE = 3, 0.05
PARTITIONS = 4
_DIGITS = re.compile("[0-9०-९]+")


def normal_line(line: str) -> str:
    """What lines are compared by; '' for a blank line."""
    if not unicodedata.is_normalized("NFC", line):
        line = unicodedata.normalize("NFC", line)
    return _DIGITS.sub("0", " ".join(line.lower().split()))


def line_hashes(pages: DataFrame, id_col: str = "record_id") -> DataFrame:
    """(id, site, url_key, lines array<struct(no, key)>): one row per page, its lines hashed."""
    pages = pages.filter("site is not null and content is not null and content != ''")
    pages = pages.select(F.col(id_col).alias("id"), "site", F.when(F.col("url").isNotNull(), F.xxhash64("url")).alias("url_key"), "content")
    kind = dict(pages.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            offsets, nos, keys = [0], [], []
            for text in b.column("content").to_pylist():
                for no, line in enumerate(text.split("\n")):
                    k = known.get(line)
                    if k is None:
                        norm = normal_line(line)
                        k = digest(norm) - (1 << 63) if norm else 0
                        if len(known) > 50_000:
                            known.clear()
                        known[line] = k
                    if k:
                        nos.append(no)
                        keys.append(k)
                offsets.append(len(nos))
            entries = pa.StructArray.from_arrays([pa.array(nos, pa.int64()), pa.array(keys, pa.int64())], ["no", "key"])
            lines = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("site"), b.column("url_key"), lines], ["id", "site", "url_key", "lines"])

    return pages.mapInArrow(run, f"id {kind}, site string, url_key bigint, lines array<struct<no: bigint, key: bigint>>")


def triples(hashed: DataFrame) -> DataFrame:
    """Distinct (site, key, url_key). A site may hold a third of all rows, but no group is formed
    by site alone: keys spread over the line and the url."""
    keys = F.array_distinct(F.transform("lines", lambda x: x["key"]))
    return hashed.filter("url_key is not null").select("site", "url_key", F.explode(keys).alias("key")).distinct()


def line_counts(seen: DataFrame) -> DataFrame:
    return seen.groupBy("site", "key").agg(F.count("*").alias("urls"))


def site_sizes(hashed: DataFrame) -> DataFrame:
    """Distinct urls with content per site, pre-aggregated by (site, url)."""
    return hashed.filter("url_key is not null").select("site", "url_key").distinct().groupBy("site").agg(F.count("*").alias("site_urls"))


def crossed(counts: DataFrame, sizes: DataFrame, min_urls: int = MIN_URLS, min_share: float = MIN_SHARE) -> DataFrame:
    """(site, key) of the lines that reach both thresholds. They are few for a site: at most the
    lines of its pages divided by the share."""
    # The share as a whole-number comparison, to keep ties exact.
    parts = round(1_000_000 * min_share)
    hot = counts.filter(F.col("urls") >= min_urls).join(sizes, "site")
    return hot.filter(F.col("urls") * 1_000_000 >= F.col("site_urls") * parts).select("site", "key")


def pages_to_rebuild(hashed: DataFrame, changed: DataFrame) -> DataFrame:
    """The pages that hold a line whose standing changed. Those lines are few for a site, and meet
    the pages as an array per site, so that no page's lines are shuffled."""
    turned = changed.groupBy("site").agg(F.collect_set("key").alias("turned"))
    return hashed.join(turned, "site").filter(F.arrays_overlap("lines.key", "turned")).select(hashed.columns)


def page_cases(hashed: DataFrame, standing: DataFrame) -> DataFrame:
    """(part, page, id, nos): each page with the numbers of its lines that stand."""
    hot = standing.groupBy("site").agg(F.collect_set("key").alias("hot"))
    nos = F.filter("lines", lambda x: F.array_contains(F.col("hot"), x["key"])).getField("no")
    return hashed.join(hot, "site", "left").select("part", "page", "id", nos.alias("nos"))


@dataclass
class LineCounts:
    """Incremental state over partitions of pages. What a merge adds is a run; runs are folded
    into one when there are more than max_runs."""

    min_urls: int = MIN_URLS
    min_share: float = MIN_SHARE
    max_runs: int = 8
    parts: int = 0
    runs: list[DataFrame] = field(default_factory=list)
    urls: DataFrame | None = None
    sizes: DataFrame | None = None
    pages: DataFrame | None = None
    standing: DataFrame | None = None
    cases: DataFrame | None = None

    @property
    def counts(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.runs).groupBy("site", "key").agg(F.sum("urls").alias("urls"))

    def merge(self, pages: DataFrame, id_col: str = "record_id") -> tuple[DataFrame, DataFrame]:
        """Merge a new partition; returns its hashed pages and the lines whose standing changed,
        as (site, key, now boolean)."""
        return self.merge_hashed(stored(line_hashes(pages, id_col).withColumn("page", F.monotonically_increasing_id()), "line-hashes"))

    def merge_hashed(self, hashed: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The same for stored pages that are hashed, with a number `page` that is theirs alone in the partition."""
        part = self.parts
        hashed = hashed.select("id", "site", "url_key", "lines", "page", F.lit(part).alias("part"))
        fresh, urls = triples(hashed), hashed.filter("url_key is not null").select("site", "url_key").distinct()
        if not part:
            self.urls, self.pages, self.sizes = urls.limit(0), hashed.limit(0), site_sizes(hashed).limit(0)
            self.standing = fresh.select("site", "key").limit(0)
            self.cases = page_cases(hashed, self.standing).limit(0)

        # Not by the lines, since a url whose lines are all blank has none.
        urls = stored(urls.join(self.urls.withColumn("known", F.lit(True)), ["site", "url_key"], "left"), "line-urls")
        again, new_urls = urls.filter("known").drop("known"), urls.filter("known is null").drop("known")
        counted = triples(self.pages.join(again, ["site", "url_key"], "left_semi"))
        delta = stored(line_counts(fresh.join(counted, ["site", "key", "url_key"], "left_anti")), "line-counts")
        more = new_urls.groupBy("site").agg(F.count("*").alias("site_urls"))
        sizes = stored(self.sizes.unionByName(more).groupBy("site").agg(F.sum("site_urls").alias("site_urls")), "line-sites")

        # A line that neither is in the delta nor stands keeps its count, and sites only grow.
        open_ = delta.select("site", "key").unionByName(self.standing)
        older = reduce(DataFrame.unionByName, self.runs, delta.limit(0)).join(open_, ["site", "key"], "left_semi")
        counts = older.unionByName(delta).groupBy("site", "key").agg(F.sum("urls").alias("urls"))
        now = crossed(counts, sizes, self.min_urls, self.min_share).withColumn("now", F.lit(True))
        both = now.join(self.standing.withColumn("was", F.lit(True)), ["site", "key"], "full_outer")
        both = stored(both.select("site", "key", F.col("now").isNotNull().alias("now"), F.col("was").isNotNull().alias("was")), "line-standing")
        standing, changed = both.filter("now").select("site", "key"), both.filter("now != was").select("site", "key", "now")

        # Rebuilt pages are written even if no line is left, to take the place of their old rows.
        todo = hashed.unionByName(pages_to_rebuild(self.pages, changed))
        built = stored(page_cases(todo, standing).filter((F.col("part") < part) | (F.size("nos") > 0)), "line-cases")
        rebuilt = built.filter(F.col("part") < part).select("part", "page")

        # All at the end, so that a merge that failed can be tried again.
        self.parts, self.runs, self.sizes, self.standing = part + 1, [*self.runs, delta], sizes, standing
        self.urls, self.pages = self.urls.unionByName(new_urls), self.pages.unionByName(hashed)
        self.cases = self.cases.join(rebuilt, ["part", "page"], "left_anti").unionByName(built)
        if len(self.runs) > self.max_runs:
            self._fold()
        return hashed, changed

    def _fold(self) -> None:
        self.runs = [stored(self.counts, "line-counts")]
        self.urls, self.pages, self.cases = stored(self.urls, "line-urls"), stored(self.pages, "line-hashes"), stored(self.cases, "line-cases")

    def found(self, id_col: str = "record_id") -> DataFrame:
        """(id_col, line_no) of every line that its site repeats, in all pages merged so far."""
        return self.cases.select(F.col("id").alias(id_col), F.explode("nos").alias("line_no"))


def repeated_lines(pages: DataFrame, id_col: str = "record_id", min_urls: int = MIN_URLS, min_share: float = MIN_SHARE, partitions: int = PARTITIONS) -> DataFrame:
    """(id_col, line_no) of every line that its site repeats: the pages are hashed and stored once,
    dealt out by a hash of their ids, and each partition is merged into the state in turn."""
    spark = pages.sparkSession
    path = new_path(spark, "line-hashes")
    hashed = line_hashes(pages, id_col).withColumns({"page": F.monotonically_increasing_id(), "part": F.pmod(F.xxhash64("id"), F.lit(partitions)).cast("int")})
    hashed.write.option("compression", "zstd").partitionBy("part").parquet(path)
    dealt = spark.read.schema(hashed.schema).parquet(path)
    state = LineCounts(min_urls, min_share)
    for k in range(partitions):
        state.merge_hashed(dealt.filter(F.col("part") == k))
    return state.found(id_col)


def without_lines(content: Column, numbers: Column) -> Column:
    """The content without the lines of the given numbers."""
    kept = F.filter(F.split(content, "\n", -1), lambda _, i: ~F.array_contains(numbers, i.cast("long")))
    return F.array_join(kept, "\n")
