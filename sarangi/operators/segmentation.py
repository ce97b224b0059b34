"""Sentences and paragraphs by fixed terminators, and statistics about them.

Null texts have neither. Each terminator ends a sentence, so `!!` gives an extra one; a
remainder without terminator is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sarangi.config import SegmentConfig
from sarangi.functions.text import SPACE, strip, word_count

TERMINATORS = "।॥!?…"
PIECE = rf"[^{TERMINATORS}]*[{TERMINATORS}]|[^{TERMINATORS}]+\z"


def sentences(text: Column, config: SegmentConfig = SegmentConfig()) -> Column:
    pieces = F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), strip)
    return F.filter(pieces, lambda s: word_count(s).between(config.min_sentence_words, config.max_sentence_words))


def paragraphs(text: Column, config: SegmentConfig = SegmentConfig()) -> Column:
    parts = F.transform(F.split(text, rf"\n[{SPACE}]*\n"), strip)
    return F.filter(parts, lambda p: (F.length(p) > 0) & (F.length(p) >= config.min_paragraph_length))


def segment(df: DataFrame, text_col: str = "text", config: SegmentConfig = SegmentConfig()) -> DataFrame:
    """Add sentences, paragraphs, their counts and mean lengths (words a sentence, characters a paragraph)."""
    df = df.withColumns({"sentences": sentences(F.col(text_col), config), "paragraphs": paragraphs(F.col(text_col), config)})
    n, m = F.size("sentences"), F.size("paragraphs")
    total = lambda c, f: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + f(x))
    return df.withColumns({
        "sentence_count": F.greatest(n, F.lit(0)).cast("bigint"),
        "paragraph_count": F.greatest(m, F.lit(0)).cast("bigint"),
        "avg_sentence_length": F.when(n > 0, total("sentences", word_count) / n).otherwise(F.lit(0.0)),
        "avg_paragraph_length": F.when(m > 0, total("paragraphs", lambda p: F.length(p).cast("bigint")) / m).otherwise(F.lit(0.0)),
    })


def corpus_stats(segmented: DataFrame, by: str) -> DataFrame:
    """Per group: documents, sentences, paragraphs and the means over all of them."""
    words = F.col("avg_sentence_length") * F.col("sentence_count")
    chars = F.col("avg_paragraph_length") * F.col("paragraph_count")
    out = segmented.groupBy(by).agg(
        F.count("*").alias("documents"), F.sum("sentence_count").alias("sentences"), F.sum("paragraph_count").alias("paragraphs"),
        F.sum(words).alias("__w"), F.sum(chars).alias("__c"),
    )
    return out.select(
        by, "documents", "sentences", "paragraphs",
        F.when(F.col("sentences") > 0, F.col("__w") / F.col("sentences")).otherwise(0.0).alias("avg_sentence_length"),
        F.when(F.col("paragraphs") > 0, F.col("__c") / F.col("paragraphs")).otherwise(0.0).alias("avg_paragraph_length"),
    )


def explode_sentences(df: DataFrame, id_col: str, text_col: str = "text", config: SegmentConfig = SegmentConfig()) -> DataFrame:
    """(id, pos, sentence)."""
    return df.select(id_col, F.posexplode(sentences(F.col(text_col), config)).alias("pos", "sentence")).withColumn("pos", F.col("pos").cast("bigint"))
