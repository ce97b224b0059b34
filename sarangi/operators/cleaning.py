"""Text cleaning: ordered steps, then the filters that drop a row.

Null, non-text and blank rows are dropped; columns that the stage keeps but the input lacks
get defaults, while nulls in columns that exist stay null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sarangi.config import CleanConfig
from sarangi.functions.text import DEVANAGARI, SPACE, has_script, is_blank, nfc, squeeze, strip

# What the steps remove.
HTML = r"<[^>]+>"
URLS = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
EMAILS = rf"[^{SPACE}]+@[^{SPACE}]+"
CONTROL = r"[\x{00}-\x{1f}\x{7f}-\x{9f}]"
MARKS = "।॥!?.,:;"
REPEATED = rf"([{MARKS}])\1{{2,}}"
DEFAULTS = {"source": "unknown", "url": "", "title": "", "date": ""}


def steps(text: Column, config: CleanConfig = CleanConfig()) -> Column:
    """The text after all steps, before the filters; the text is expected in form C already."""
    if config.remove_html:
        text = F.regexp_replace(text, HTML, "")
    if config.remove_urls:
        text = F.regexp_replace(text, URLS, "")
    if config.remove_emails:
        text = F.regexp_replace(text, EMAILS, "")
    if config.remove_control_chars:
        text = F.regexp_replace(text, CONTROL, config.control_char_replacement)
    if config.clean_whitespace:
        text = strip(squeeze(text))
    if config.normalize_punctuation:
        text = F.regexp_replace(text, REPEATED, "$1$1")
    return text


def clean(df: DataFrame, text_col: str = "text", config: CleanConfig = CleanConfig()) -> DataFrame:
    """Rows that survive, with the text cleaned in place and all other columns kept.

    The cheap tests come first, so that the normaliser sees no row that must be dropped.
    """
    if text_col not in df.columns:
        raise ValueError(f"no column {text_col}")
    raw = F.col(text_col)
    keep = ~is_blank(raw)
    if config.require_script:
        keep = keep & has_script(raw, DEVANAGARI)
    out = df.filter(keep)
    if config.unicode_normalize:
        out = out.withColumn(text_col, nfc(raw))
    out = out.withColumn(text_col, steps(F.col(text_col), config))
    out = out.filter(F.length(text_col) >= config.min_text_length)
    return out.filter(has_script(F.col(text_col), DEVANAGARI)) if config.require_script else out


def with_defaults(df: DataFrame, defaults: dict = DEFAULTS) -> DataFrame:
    """Add columns that are absent; a null in a column that exists stays."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def cleaned_schema(df: DataFrame, dataset: str | None = None) -> DataFrame:
    """Project to the stage's columns."""
    df = with_defaults(df)
    if dataset is not None or "dataset_name" not in df.columns:
        df = df.withColumn("dataset_name", F.lit(dataset or "unknown"))
    return df.select("text", "source", "url", "title", "date", "dataset_name")


def counters(before: DataFrame, after: DataFrame, by: str) -> DataFrame:
    """Rows in, out and filtered per group and, with a null group, in total."""
    a = before.groupBy(by).agg(F.count("*").alias("rows_in"))
    b = after.groupBy(by).agg(F.count("*").alias("rows_out"))
    both = a.join(b, a[by].eqNullSafe(b[by]), "left").select(a[by], "rows_in", F.coalesce("rows_out", F.lit(0)).alias("rows_out"))
    both = both.withColumn("is_total", F.lit(0))
    total = both.agg(F.coalesce(F.sum("rows_in"), F.lit(0)).alias("rows_in"), F.coalesce(F.sum("rows_out"), F.lit(0)).alias("rows_out"))
    total = total.select(F.lit(None).cast(dict(before.dtypes)[by]).alias(by), "rows_in", "rows_out", F.lit(1).alias("is_total"))
    return both.unionByName(total).withColumn("rows_filtered", F.col("rows_in") - F.col("rows_out"))
