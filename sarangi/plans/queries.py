"""The catalogue of queries over whole tables, and the same in SQL where it can be said."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sarangi.config import ExactDedupConfig, NearDedupConfig, WikiConfig
from sarangi.functions import text as X
from sarangi.operators import cleaning, exact_dedup, html, language, near_dedup, segmentation, urls, wiki
from sarangi.session import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

# Pieces of SQL that several queries share.
S = X.SPACE
D = X.DEVANAGARI
STRIP = lambda x: f"regexp_replace({x}, '^[{S}]+|[{S}]+$', '', 'g')"
WORDS = lambda x: f"len(regexp_extract_all({x}, '[^{S}]+'))"
RATIO = lambda x: f"(CASE WHEN length({x}) > 0 THEN length(regexp_replace({x}, '[^{D}]', '', 'g')) / length({x})::DOUBLE ELSE 0.0 END)"
LEXICON = ", ".join(f"'{w}'" for w in language.LEXICON)


def _marks(x: str) -> str:
    """Runs of one mark cut to two: a replacement per mark, where back references are missing."""
    for c in cleaning.MARKS:
        mark = "\\" + c if c in ".?" else c
        x = f"regexp_replace({x}, '{mark}{{3,}}', '{c}{c}', 'g')"
    return x


def _clean_sql(select: str, source: str = "documents", text: str = "text") -> str:
    x = f"nfc_normalize({text})"
    for pattern in (cleaning.HTML, cleaning.URLS, cleaning.EMAILS, cleaning.CONTROL):
        x = f"regexp_replace({x}, '{pattern}', '', 'g')"
    x = _marks(STRIP(f"regexp_replace({x}, '[{S}]+', ' ', 'g')"))
    return (
        f"WITH raw AS (SELECT * FROM {source} WHERE {text} IS NOT NULL AND regexp_matches({text}, '[^{S}]') AND regexp_matches({text}, '[{D}]')), "
        f"steps AS (SELECT * REPLACE ({x} AS {text}) FROM raw), "
        f"cleaned AS (SELECT * FROM steps WHERE length({text}) >= 10 AND regexp_matches({text}, '[{D}]')) {select}"
    )


def query(sql: str | None = None):
    """Register a query under its name, with its SQL."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


# Cleaning


@query(_clean_sql("SELECT doc_id, text FROM cleaned"))
def clean_documents(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean(_documents(spark, d)).select("doc_id", "text")


@query(
    _clean_sql(
        ", a AS (SELECT source, count(*) AS rows_in FROM documents GROUP BY source), b AS (SELECT source, count(*) AS rows_out FROM cleaned GROUP BY source) "
        "SELECT a.source, rows_in, coalesce(rows_out, 0) AS rows_out, 0 AS is_total, rows_in - coalesce(rows_out, 0) AS rows_filtered FROM a LEFT JOIN b ON a.source IS NOT DISTINCT FROM b.source "
        "UNION ALL SELECT NULL, (SELECT count(*) FROM documents), (SELECT count(*) FROM cleaned), 1, (SELECT count(*) FROM documents) - (SELECT count(*) FROM cleaned)"
    )
)
def clean_stats_by_source(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d)
    return cleaning.counters(docs, cleaning.clean(docs), "source")


@query(_clean_sql("SELECT record_id, content FROM cleaned", "scraped_articles", "content"))
def clean_scraped_articles(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean(table(spark, d, "scraped_articles"), "content").select("record_id", "content")


# Language

_DETECT = f"""WITH t AS (SELECT *, coalesce(text, '') AS x FROM documents), r AS (SELECT *, {RATIO('x')} AS ratio FROM t),
k AS (SELECT *, CASE WHEN ratio >= 0.3 THEN regexp_extract_all(x, '[{D}]{{2,}}') END AS toks FROM r),
h AS (SELECT *, len(list_filter(toks, lambda w: w IN ({LEXICON})))::BIGINT AS hits, len(toks)::BIGINT AS words FROM k),
c AS (SELECT *, CASE WHEN ratio < 0.3 OR words = 0 THEN ratio ELSE least(1.0, ratio + 0.3 * hits / words) END AS confidence FROM h),
det AS (SELECT *, ratio >= 0.3 AND x <> '' AND confidence >= 0.5 AS is_match FROM c)"""


@query(_DETECT + " SELECT doc_id, is_match, round(CASE WHEN x = '' THEN 0.0 ELSE confidence END, 9) AS confidence, CASE WHEN x = '' THEN 'empty_text' WHEN ratio < 0.3 THEN 'low_script_ratio' ELSE 'confidence' END AS reason_code, round(ratio, 9) AS script_ratio, hits, words FROM det")
def lang_detect(spark: SparkSession, d: str) -> DataFrame:
    out = language.detect(_documents(spark, d)).select("doc_id", "detection.*")
    return out.withColumns({c: F.round(c, 9) for c in ("confidence", "script_ratio")})


@query(_DETECT + " SELECT doc_id, text, round(confidence, 9) AS language_confidence, round(ratio, 9) AS devanagari_ratio FROM det WHERE is_match")
def lang_filter(spark: SparkSession, d: str) -> DataFrame:
    out = language.filter_language(_documents(spark, d))
    return out.select("doc_id", "text", F.round("language_confidence", 9).alias("language_confidence"), F.round("devanagari_ratio", 9).alias("devanagari_ratio"))


@query(_DETECT + " SELECT CASE WHEN NOT is_match THEN 'rejected' WHEN confidence >= 0.8 THEN 'high' WHEN confidence >= 0.6 THEN 'medium' ELSE 'low' END AS band, count(*) AS rows FROM det GROUP BY 1")
def lang_bands(spark: SparkSession, d: str) -> DataFrame:
    return language.bands(_documents(spark, d))


@query(f"SELECT word, count(*) AS hits FROM (SELECT unnest(regexp_extract_all(text, '[{D}]{{2,}}')) AS word FROM documents) WHERE word IN ({LEXICON}) GROUP BY word")
def lexicon_hits(spark: SparkSession, d: str) -> DataFrame:
    return language.lexicon_hits(_documents(spark, d))


@query(f"SELECT doc_id, round({RATIO('text')}, 9) AS ratio, round(CASE WHEN length(l) > 0 THEN length(regexp_replace(text, '[^{D}]', '', 'g')) / length(l)::DOUBLE ELSE 0.0 END, 9) AS letter_ratio FROM (SELECT *, regexp_replace(text, '[^\\p{{L}}\\p{{N}}_]|\\p{{Nd}}', '', 'g') AS l FROM documents WHERE text IS NOT NULL)")
def script_ratios(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d).filter("text is not null")
    return docs.select("doc_id", F.round(X.script_ratio(F.col("text")), 9).alias("ratio"), F.round(X.letter_script_ratio(F.col("text")), 9).alias("letter_ratio"))


# Segmentation

_T = segmentation.TERMINATORS
_SENTENCES = f"list_filter(list_transform(regexp_extract_all(text, '[^{_T}]*[{_T}]|[^{_T}]+$'), lambda s: {STRIP('s')}), lambda s: {WORDS('s')} BETWEEN 5 AND 100)"
_PARAGRAPHS = f"list_filter(list_transform(regexp_split_to_array(text, '\\n[{S}]*\\n'), lambda p: {STRIP('p')}), lambda p: length(p) >= 50)"


@query(f"WITH s AS (SELECT doc_id, {_SENTENCES} AS s FROM documents WHERE text IS NOT NULL), p AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS pos FROM s) SELECT doc_id, pos::BIGINT AS pos, sentence FROM p")
def fixed_sentences(spark: SparkSession, d: str) -> DataFrame:
    return segmentation.explode_sentences(_documents(spark, d), "doc_id")


@query(f"WITH s AS (SELECT doc_id, {_PARAGRAPHS} AS s FROM documents WHERE text IS NOT NULL), p AS (SELECT doc_id, unnest(s) AS paragraph, generate_subscripts(s, 1) - 1 AS pos FROM s) SELECT doc_id, pos::BIGINT AS pos, paragraph FROM p")
def fixed_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    out = _documents(spark, d).select("doc_id", F.posexplode(segmentation.paragraphs(F.col("text"))).alias("pos", "paragraph"))
    return out.withColumn("pos", F.col("pos").cast("bigint"))


_SEGMENTED = f"""WITH s AS (SELECT doc_id, source, coalesce({_SENTENCES}, []) AS s, coalesce({_PARAGRAPHS}, []) AS p FROM documents),
n AS (SELECT *, coalesce(list_sum(list_transform(s, lambda x: {WORDS('x')})), 0)::BIGINT AS w, coalesce(list_sum(list_transform(p, lambda x: length(x))), 0)::BIGINT AS c FROM s)"""


@query(_SEGMENTED + " SELECT doc_id, len(s)::BIGINT AS sentence_count, len(p)::BIGINT AS paragraph_count, round(CASE WHEN len(s) > 0 THEN w / len(s)::DOUBLE ELSE 0 END, 6) AS avg_sentence_length, round(CASE WHEN len(p) > 0 THEN c / len(p)::DOUBLE ELSE 0 END, 6) AS avg_paragraph_length FROM n")
def segment_stats(spark: SparkSession, d: str) -> DataFrame:
    out = segmentation.segment(_documents(spark, d))
    return out.select("doc_id", "sentence_count", "paragraph_count", F.round("avg_sentence_length", 6).alias("avg_sentence_length"), F.round("avg_paragraph_length", 6).alias("avg_paragraph_length"))


@query(_SEGMENTED + " SELECT source, count(*) AS documents, sum(len(s))::BIGINT AS sentences, sum(len(p))::BIGINT AS paragraphs, round(CASE WHEN sum(len(s)) > 0 THEN sum(w) / sum(len(s))::DOUBLE ELSE 0 END, 6) AS avg_sentence_length, round(CASE WHEN sum(len(p)) > 0 THEN sum(c) / sum(len(p))::DOUBLE ELSE 0 END, 6) AS avg_paragraph_length FROM n GROUP BY source")
def corpus_segment_stats(spark: SparkSession, d: str) -> DataFrame:
    segmented = segmentation.segment(_documents(spark, d).select("doc_id", "source", "text"))
    out = segmentation.corpus_stats(segmented, "source")
    return out.withColumns({c: F.round(c, 6) for c in ("avg_sentence_length", "avg_paragraph_length")})


# Exact duplicates

_SHA256 = ExactDedupConfig(store_digests=("sha256",))


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS k FROM documents WHERE text IS NOT NULL) WHERE k = 1")
def exact_dedup_strict(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.first_seen(_documents(spark, d), ["doc_id"]).select("doc_id", "source")


@query("SELECT doc_id FROM (SELECT *, dense_rank() OVER (PARTITION BY sha256(coalesce(text, 'None')) ORDER BY dataset_name NULLS FIRST, doc_id // 500) AS k FROM documents) WHERE k = 1")
def exact_dedup_chunked(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d).select("doc_id", "text", "dataset_name")
    return exact_dedup.first_seen(docs, ["dataset_name", "doc_id"], "text", ExactDedupConfig("chunked", 500, True)).select("doc_id")


@query("SELECT doc_id FROM preprocessed WHERE text IS NOT NULL AND sha256(text) NOT IN (SELECT lower(hash) FROM hashes WHERE hash IS NOT NULL)")
def exact_dedup_incremental(spark: SparkSession, d: str) -> DataFrame:
    """By SHA-256 alone, as its SQL has it; exact_dedup_incremental_any takes the MD5 rows too."""
    return exact_dedup.unseen(table(spark, d, "preprocessed"), table(spark, d, "hashes"), config=_SHA256).select("doc_id")


@query("SELECT doc_id FROM preprocessed WHERE text IS NOT NULL AND sha256(text) NOT IN (SELECT lower(hash) FROM hashes WHERE hash IS NOT NULL) AND md5(text) NOT IN (SELECT lower(hash) FROM hashes WHERE hash IS NOT NULL)")
def exact_dedup_incremental_any(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.unseen(table(spark, d, "preprocessed"), table(spark, d, "hashes")).select("doc_id")


@query("SELECT sha256(text) AS hash, arg_min(dataset_name, doc_id) AS dataset_name FROM preprocessed WHERE text IS NOT NULL AND sha256(text) NOT IN (SELECT lower(hash) FROM hashes WHERE hash IS NOT NULL) GROUP BY 1")
def hash_store_delta(spark: SparkSession, d: str) -> DataFrame:
    """By SHA-256 alone, as its SQL has it; hash_store_delta_any takes the MD5 rows too."""
    return exact_dedup.new_hashes(table(spark, d, "preprocessed"), table(spark, d, "hashes"), "dataset_name", "doc_id", config=_SHA256)


@query("SELECT sha256(text) AS hash, arg_min(dataset_name, doc_id) AS dataset_name FROM preprocessed WHERE text IS NOT NULL AND sha256(text) NOT IN (SELECT lower(hash) FROM hashes WHERE hash IS NOT NULL) AND md5(text) NOT IN (SELECT lower(hash) FROM hashes WHERE hash IS NOT NULL) GROUP BY 1")
def hash_store_delta_any(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.new_hashes(table(spark, d, "preprocessed"), table(spark, d, "hashes"), "dataset_name", "doc_id")


@query("SELECT sha256(text) AS hash, count(*) AS copies, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.duplicate_groups(_documents(spark, d), "doc_id")


@query("SELECT count(*) AS total_rows, count(DISTINCT text) AS unique_rows, count(*) - count(DISTINCT text) AS duplicate_rows, round(100.0 * (count(*) - count(DISTINCT text)) / count(*), 2) AS duplicate_rate FROM documents WHERE text IS NOT NULL")
def dedup_stats(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.dedup_stats(_documents(spark, d))


@query("SELECT doc_id FROM (SELECT *, dense_rank() OVER (PARTITION BY sha256(text) ORDER BY dataset_name NULLS FIRST, doc_id // 900) AS k FROM documents WHERE text IS NOT NULL) WHERE k = 1")
def micro_batch_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.micro_batches(_documents(spark, d), "dataset_name", "doc_id").select("doc_id")


@query("SELECT doc_id FROM (SELECT *, first_value(dataset_name) OVER w AS owner, row_number() OVER w AS k FROM documents WHERE text IS NOT NULL WINDOW w AS (PARTITION BY sha256(text) ORDER BY doc_id)) WHERE dataset_name <> owner OR k = 1")
def owned_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.owned(_documents(spark, d), "dataset_name", "doc_id").select("doc_id")


@query(f"WITH s AS (SELECT doc_id, {_SENTENCES} AS s FROM documents WHERE text IS NOT NULL), p AS (SELECT doc_id, unnest(s) AS sentence FROM s) SELECT sentence, count(*) AS copies, count(DISTINCT doc_id) AS documents FROM p GROUP BY sentence HAVING count(*) > 1")
def sentence_duplicates(spark: SparkSession, d: str) -> DataFrame:
    rows = segmentation.explode_sentences(_documents(spark, d), "doc_id")
    return rows.groupBy("sentence").agg(F.count("*").alias("copies"), F.countDistinct("doc_id").alias("documents")).filter("copies > 1")


# Near duplicates

_KEPT = re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", near_dedup.KEPT).replace("'", "''")
_NORMAL = STRIP(f"regexp_replace(regexp_replace(nfc_normalize(coalesce(text, '')), '[^{_KEPT}{S}]', ' ', 'g'), '[{S}]+', ' ', 'g')")
_SHINGLES = f"""WITH n AS (SELECT doc_id, {_NORMAL} AS normal FROM preprocessed), p AS (SELECT doc_id, string_split(normal, ' ') AS ws FROM n WHERE normal <> ''),
w AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM p),
g AS (SELECT doc_id, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
ch AS (SELECT doc_id, normal, unnest(range(1, greatest(length(normal) - 1, 1))) AS i FROM n WHERE normal <> '' AND NOT contains(normal, ' ')),
sh AS (SELECT doc_id, a || ' ' || b AS s FROM g WHERE b IS NOT NULL UNION SELECT doc_id, a || ' ' || b || ' ' || c FROM g WHERE c IS NOT NULL UNION SELECT doc_id, substr(normal, i::INT, 3) FROM ch),
x AS (SELECT DISTINCT doc_id, ('0x' || substr(md5(s), 1, 8))::BIGINT AS x FROM sh)"""


@query(_SHINGLES + " SELECT doc_id, count(*) AS shingles, min(x) AS least_hash FROM x GROUP BY doc_id")
def shingle_counts(spark: SparkSession, d: str) -> DataFrame:
    out = table(spark, d, "preprocessed").select("doc_id", near_dedup.base_hashes(F.col("text")).alias("s"))
    return out.select("doc_id", F.size("s").cast("bigint").alias("shingles"), F.array_min("s").alias("least_hash")).filter("shingles > 0")


_SMALL = NearDedupConfig(permutations=16, bands=4)
_PERMUTED = ", ".join(f"min(({a} * (x % {near_dedup.PRIME}) + {b}) % {near_dedup.PRIME})::BIGINT" for a, b in map(near_dedup.permutation, range(16)))


@query(_SHINGLES + f" SELECT doc_id, array_to_string([{_PERMUTED}], ',') AS signature FROM x GROUP BY doc_id")
def minhash_signature(spark: SparkSession, d: str) -> DataFrame:
    out = near_dedup.signatures(table(spark, d, "preprocessed"), "doc_id", "text", _SMALL)
    return out.select(F.col("id").alias("doc_id"), F.array_join(F.col("signature").cast("array<string>"), ",").alias("signature"))


_PERMUTED_FULL = ", ".join(f"min(({a} * (x % {near_dedup.PRIME}) + {b}) % {near_dedup.PRIME})::BIGINT" for a, b in map(near_dedup.permutation, range(NearDedupConfig().permutations)))


@query(_SHINGLES + f" SELECT doc_id, array_to_string([{_PERMUTED_FULL}], ',') AS signature FROM x GROUP BY doc_id")
def minhash_signature_full(spark: SparkSession, d: str) -> DataFrame:
    """All permutations that lsh_pairs and the pipeline use; minhash_signature has the first 16."""
    out = near_dedup.signatures(table(spark, d, "preprocessed"), "doc_id")
    return out.select(F.col("id").alias("doc_id"), F.array_join(F.col("signature").cast("array<string>"), ",").alias("signature"))


@query()
def lsh_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs as the duplicates table holds them, by 128 permutations in 16 bands."""
    signed = stored(near_dedup.signatures(table(spark, d, "preprocessed"), "doc_id"), "signatures")
    return near_dedup.record_pairs(*near_dedup.lsh_links(signed))


@query()
def lsh_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """The candidate links with their measured similarity."""
    docs = table(spark, d, "preprocessed")
    links, _ = near_dedup.lsh_links(stored(near_dedup.signatures(docs, "doc_id"), "signatures"))
    return near_dedup.jaccard(links, docs, "doc_id")


@query("SELECT canonical_doc_id AS doc_id, duplicate_doc_id AS other FROM duplicates UNION SELECT duplicate_doc_id, canonical_doc_id FROM duplicates")
def recorded_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.neighbours(table(spark, d, "duplicates"))


@query("SELECT canonical_doc_id, duplicate_doc_id, max(detected_at) AS detected_at FROM duplicates GROUP BY 1, 2")
def upserted_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Half of the records, told by a hash, upserted into the state that the other half left, so that
    pairs are kept, replaced and added."""
    pairs = table(spark, d, "duplicates").withColumn("late", F.pmod(F.xxhash64("canonical_doc_id", "duplicate_doc_id", "similarity", "detected_at"), F.lit(2)) == 1)
    early, late = (pairs.filter(F.col("late") == x).drop("late") for x in (False, True))
    old = near_dedup.upsert_pairs(early.limit(0), early)
    return near_dedup.upsert_pairs(old, late).select("canonical_doc_id", "duplicate_doc_id", "detected_at")


@query("SELECT doc_id FROM preprocessed WHERE doc_id NOT IN (SELECT duplicate_doc_id FROM duplicates WHERE duplicate_doc_id IS NOT NULL)")
def recorded_survivors(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.survivors(table(spark, d, "preprocessed"), table(spark, d, "duplicates"), "doc_id").select("doc_id")


# Urls and the frontier

_U = r"'^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$'"
_PART = lambda n: f"regexp_extract(url, {_U}, {n})"
_ENC = lambda x: f"replace(url_encode({x}), '%20', '+')"
_DEC = lambda x: f"url_decode(replace({x}, '+', ' '))"


def _url_sql(drop: tuple[str, ...], blank: bool, order: str) -> str:
    names = ", ".join(f"'{x}'" for x in drop)
    keep = "p <> ''" if blank else "contains(p, '=')"
    value = "" if blank else " AND v <> ''"
    key = "k, i" if order == "sort" else "i"
    return f"""WITH q AS (SELECT url, unnest(string_split({_PART(4)}, '&')) AS p, generate_subscripts(string_split({_PART(4)}, '&'), 1) AS i FROM urls),
    kv AS (SELECT url, i, {_DEC("split_part(p, '=', 1)")} AS k, CASE WHEN contains(p, '=') THEN {_DEC("regexp_replace(p, '^[^=]*=', '')")} ELSE '' END AS v FROM q WHERE {keep}),
    j AS (SELECT url, '?' || string_agg({_ENC('k')} || '=' || {_ENC('v')}, '&' ORDER BY {key}) AS query FROM kv WHERE lower(k) NOT IN ({names}){value} GROUP BY url),
    u AS (SELECT urls.*, coalesce(query, '') AS query, lower({_PART(1).replace('url', 'urls.url', 1)}) AS scheme, lower({_PART(2).replace('url', 'urls.url', 1)}) AS host, {_PART(3).replace('url', 'urls.url', 1)} AS path FROM urls LEFT JOIN j ON j.url = urls.url)"""


@query(_url_sql(urls.TRACKING, False, "keep") + " SELECT url, CASE WHEN scheme IN ('http', 'https') THEN 'https://' || host || CASE WHEN path = '' THEN '/' WHEN path <> '/' AND path LIKE '%/' THEN regexp_replace(path, '/+$', '') ELSE path END || query END AS canonical FROM (SELECT * REPLACE (regexp_replace(path, ';[^/]*$', '') AS path) FROM u)")
def url_normalize_strict(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "urls").select("url", urls.normalize_strict(F.col("url")).alias("canonical"))


@query(_url_sql(urls.CRAWL_TRACKING, True, "sort") + " SELECT url, CASE WHEN scheme IN ('http', 'https') THEN scheme || '://' || CASE WHEN scheme = 'http' THEN regexp_replace(host, ':80$', '') ELSE regexp_replace(host, ':443$', '') END || CASE WHEN length(path) > 1 THEN regexp_replace(path, '/$', '') ELSE path END || query END AS canonical FROM u")
def url_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "urls").select("url", urls.normalize(F.col("url")).alias("canonical"))


_SITED = f"WITH h AS (SELECT unnest(allowed_domains) AS host, * FROM sites), s AS (SELECT u.*, h.* EXCLUDE (host) FROM urls u LEFT JOIN h ON lower({_PART(2)}) = h.host)"


@query(_SITED + f" SELECT url, site, coalesce({_PART(1)} LIKE 'http%' AND len(list_filter(allowed_domains, lambda d: {_PART(2)} = d OR {_PART(2)} LIKE '%.' || d)) > 0 AND len(list_filter(coalesce(exclude_patterns, []), lambda p: regexp_matches(url, p))) = 0, false) AS allowed, len(coalesce(article_patterns, [])) = 0 OR len(list_filter(article_patterns, lambda p: regexp_matches(url, p))) > 0 AS article FROM s")
def url_filters(spark: SparkSession, d: str) -> DataFrame:
    rows = urls.with_sites(table(spark, d, "urls"), table(spark, d, "sites"))
    return rows.select("url", "site", urls.allowed(F.col("url"), F.col("allowed_domains"), F.col("exclude_patterns")).alias("allowed"), urls.is_article(F.col("url"), F.coalesce("article_patterns", F.array().cast("array<string>"))).alias("article"))


_ID = ", ".join(f"nullif(regexp_extract(url, '{p}', 1), '')" for p in urls.ARTICLE_IDS)


@query(f"SELECT record_id, coalesce(replace(coalesce({_ID}), '/', '-'), substr(md5(url), 1, 12)) AS article_id, list_filter(string_split({_PART(3)}, '/')[2:3], lambda s: length(s) > 2 AND NOT regexp_matches(s, '^[0-9]+$'))[1] AS category FROM scraped_articles")
def article_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "scraped_articles").select("record_id", urls.article_id(F.col("url")).alias("article_id"), urls.category(F.col("url")).alias("category"))


@query("SELECT count(*) AS total, coalesce(sum((visited = 1)::INT), 0)::BIGINT AS visited, coalesce(sum((visited = 0)::INT), 0)::BIGINT AS pending, coalesce(sum((is_article = 1)::INT), 0)::BIGINT AS articles FROM urls")
def frontier_stats(spark: SparkSession, d: str) -> DataFrame:
    return urls.frontier_stats(table(spark, d, "urls"))


@query("SELECT * FROM urls WHERE visited = 0 ORDER BY depth, url LIMIT 1")
def frontier_next(spark: SparkSession, d: str) -> DataFrame:
    return urls.next_urls(table(spark, d, "urls"))


@query("SELECT depth, count(*) AS urls FROM urls GROUP BY depth")
def frontier_depths(spark: SparkSession, d: str) -> DataFrame:
    return urls.depth_counts(table(spark, d, "urls"))


@query("SELECT url FROM urls WHERE is_article = 1 ORDER BY url")
def frontier_export(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "urls").filter("is_article = 1").select("url").orderBy("url")


@query(f"""WITH h AS (SELECT lower({_PART(2)}) AS host, * FROM urls), g AS (SELECT host, count(*) AS total, sum((visited = 1)::INT)::BIGINT AS visited, sum((visited = 0)::INT)::BIGINT AS pending, max(depth) AS max_depth, max(CASE WHEN visited = 1 THEN discovered_at END) AS last_activity FROM h GROUP BY host)
SELECT *, round(100.0 * visited / total, 1) AS percent, CASE WHEN pending = 0 AND visited > 0 THEN 'COMPLETE' WHEN last_activity IS NULL THEN 'QUEUED' WHEN epoch(TIMESTAMP '2025-04-01 00:00:00')::BIGINT - floor(epoch(last_activity))::BIGINT < 600 THEN 'ACTIVE' ELSE 'STALLED' END AS status FROM g""")
def crawl_status(spark: SparkSession, d: str) -> DataFrame:
    return urls.crawl_status(table(spark, d, "urls"), F.lit("2025-04-01 00:00:00").cast("timestamp"))


# Scraped articles


@query("SELECT url, CASE WHEN status_code IN (404, 410) THEN 'dead_link' WHEN status_code IS NULL OR status_code <> 200 THEN 'failed' WHEN content IS NULL OR length(content) < 100 THEN 'empty' ELSE 'success' END AS status FROM (SELECT u.url, u.status_code, max(a.content) AS content FROM urls u LEFT JOIN scraped_articles a ON a.url = u.url GROUP BY 1, 2)")
def scrape_status(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "scraped_articles").groupBy("url").agg(F.max("content").alias("content"))
    rows = table(spark, d, "urls").select("url", "status_code").join(found, "url", "left")
    return rows.select("url", html.scrape_status(F.col("status_code"), F.col("content")).alias("status"))


@query(f"SELECT record_id, {STRIP(f'''regexp_replace(regexp_replace(nfc_normalize(title), '{html.INVISIBLE}', '', 'g'), '[{S}]+', ' ', 'g')''')} AS title, coalesce({WORDS('content')}, 0)::BIGINT AS words, coalesce(length(content), 0)::BIGINT AS chars FROM scraped_articles")
def article_text(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "scraped_articles")
    return rows.select("record_id", html.normalize_text(F.col("title")).alias("title"), F.coalesce(X.word_count(F.col("content")), F.lit(0)).alias("words"), F.coalesce(X.length(F.col("content")), F.lit(0)).alias("chars"))


@query("SELECT url FROM urls WHERE is_article = 1 AND url NOT IN (SELECT url FROM scraped_articles WHERE content IS NOT NULL AND length(content) >= 100 AND url IS NOT NULL)")
def scrape_pending(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "scraped_articles").select("url", html.scrape_status(F.lit(200), F.col("content")).alias("status"), F.lit(0).alias("retry_count"))
    return html.to_scrape(table(spark, d, "urls").filter("is_article = 1"), log).select("url")


@query("SELECT count(*) AS processed, sum((content IS NOT NULL AND length(content) >= 100)::INT)::BIGINT AS succeeded, (count(*) - sum((content IS NOT NULL AND length(content) >= 100)::INT))::BIGINT AS failed, round(100.0 * sum((content IS NOT NULL AND length(content) >= 100)::INT) / count(*), 2) AS success_rate FROM scraped_articles")
def scrape_metrics(spark: SparkSession, d: str) -> DataFrame:
    return html.scrape_metrics(table(spark, d, "scraped_articles").select(html.scrape_status(F.lit(200), F.col("content")).alias("status")))


@query("SELECT * EXCLUDE (k) FROM (SELECT url, record_id, scraped_at, row_number() OVER (PARTITION BY url ORDER BY scraped_at DESC NULLS LAST, record_id DESC) AS k FROM scraped_articles) WHERE k = 1")
def latest_scrapes(spark: SparkSession, d: str) -> DataFrame:
    """The last scrape of each url, by a partial aggregate."""
    last = table(spark, d, "scraped_articles").groupBy("url").agg(F.max(F.struct("scraped_at", "record_id")).alias("v"))
    return last.select("url", "v.record_id", "v.scraped_at")


# Wiki rules, on the corpus


_WIKI_CONFIG = WikiConfig(min_script_ratio=0.6, max_article_length=5_000)
_REASON = f"""WITH n AS (SELECT doc_id, text, nullif({STRIP(f"regexp_replace(nfc_normalize(text), '[{S}]+', ' ', 'g')")}, '') AS c FROM documents),
l AS (SELECT *, length(regexp_replace(c, '[^\\p{{L}}\\p{{N}}_]|\\p{{Nd}}', '', 'g')) AS letters, lower({STRIP("coalesce(text, '')[1:200]")}) AS head FROM n),
j AS (SELECT doc_id, CASE WHEN {" OR ".join(f"starts_with(head, '{w}')" for w in wiki.REDIRECTS)} THEN 'is_redirect' WHEN c IS NULL THEN 'cleaning_failed' WHEN {" OR ".join(f"contains(c[1:500], '{m}')" for m in wiki.DISAMBIGUATION)} THEN 'is_disambiguation' WHEN length(c) < 100 THEN 'too_short' WHEN length(c) > 5000 THEN 'too_long' WHEN NOT regexp_matches(c, '[{D}]') THEN 'no_devanagari' WHEN CASE WHEN letters > 0 THEN length(regexp_replace(c, '[^{D}]', '', 'g')) / letters::DOUBLE ELSE 0 END < 0.6 THEN 'low_devanagari_ratio' END AS skip_reason FROM l)"""


def _judged(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d).select("doc_id", "text")
    cleaned = X.strip(X.squeeze(X.nfc(F.col("text"))))
    docs = docs.withColumn("c", F.nullif(cleaned, F.lit("")))
    return docs.select("doc_id", wiki.skip_reason(F.lit(""), F.col("text"), F.col("c"), F.lit(0), _WIKI_CONFIG).alias("skip_reason"))


@query(_REASON + " SELECT doc_id, skip_reason FROM j")
def wiki_validation(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d)


@query(_REASON + " SELECT skip_reason, count(*) AS articles, round(100.0 * count(*) / (SELECT count(*) FROM j WHERE skip_reason IS NOT NULL), 2) AS percent FROM j WHERE skip_reason IS NOT NULL GROUP BY skip_reason")
def wiki_skip_counts(spark: SparkSession, d: str) -> DataFrame:
    return wiki.skip_counts(_judged(spark, d))


@query(f"SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\\n[{S}]*\\n'), lambda p: {STRIP('p')}), lambda p: length(p) BETWEEN 20 AND 10000) AS paragraphs FROM documents WHERE text IS NOT NULL")
def wiki_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).filter("text is not null").select("doc_id", wiki.filter_paragraphs(F.col("text")).alias("paragraphs"))


@query("SELECT doc_id, " + "replace(" * len(wiki.PUNCTUATION) + "text" + "".join(f", '{a}', '{b}')" for a, b in wiki.PUNCTUATION) + " AS text FROM documents WHERE text IS NOT NULL")
def wiki_punctuation(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).filter("text is not null").select("doc_id", X.ordered_replace(F.col("text"), wiki.PUNCTUATION).alias("text"))


# Sets and streams of counts


@query("SELECT doc_id FROM (SELECT url FROM documents UNION ALL SELECT url FROM preprocessed) x JOIN (SELECT doc_id::VARCHAR AS doc_id, url FROM documents UNION SELECT doc_id, url FROM preprocessed) y USING (url) GROUP BY doc_id")
def corpus_union(spark: SparkSession, d: str) -> DataFrame:
    """Distinct union of two corpora with their ids, semi-joined to their urls."""
    a, b = _documents(spark, d).select(F.col("doc_id").cast("string").alias("doc_id"), "url"), table(spark, d, "preprocessed").select("doc_id", "url")
    both = a.unionByName(b).distinct()
    return both.join(a.select("url").unionByName(b.select("url")), "url", "left_semi").select("doc_id").distinct()


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY 1, 2")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    from sarangi.streaming.incremental import windowed_counts

    return windowed_counts(table(spark, d, "events"), "ts", "event_type")


# Timestamps


@query()
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """One row per record and field that denotes an instant."""
    from sarangi.operators.timestamps import Calendar, normalise_article_times

    months = table(spark, d, "bs_months").collect()  # the fixed calendar table, a row a month
    return normalise_article_times(table(spark, d, "scraped_articles"), table(spark, d, "sites"), Calendar.from_rows(months))
