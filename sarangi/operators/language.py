"""Identification of one language by script share and a word list.

Null texts count as empty. A text below the script ratio is rejected by it; the ratio, and
the confidence, need only reach their thresholds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sarangi.config import LanguageConfig
from sarangi.functions.text import DEVANAGARI, script_ratio

# Common words, and names of places.
LEXICON = (
    "छ", "ले", "को", "मा", "बाट", "सँग", "लाई", "का", "की", "हरु", "हरू",
    "गरे", "भए", "हुने", "गर्ने", "भएको", "गरेको", "हुनेछ", "गर्नेछ",
    "नेपाल", "काठमाडौँ", "पोखरा", "ललितपुर", "भक्तपुर", "बिराटनगर", "धरान",
    "जनकपुर", "विरगञ्ज", "सप्तरी", "सिराहा", "महोत्तरी", "सर्लाही", "रौतहट",
    "बारा", "पर्सा", "चितवन", "मकवानपुर", "धादिङ", "नुवाकोट", "रसुवा",
    "गोरखा", "लमजुङ", "तनहुँ", "स्याङ्जा", "कास्की", "मनाङ", "मुस्ताङ",
    "म्याग्दी", "पर्वत", "बाग्लुङ", "गुल्मी", "पाल्पा", "नवलपरासी", "रुपन्देही",
    "कपिलवस्तु", "अर्घाखाँची", "प्यूठान", "रोल्पा", "रुकुम", "सल्यान",
    "दाङ", "बाँके", "बर्दिया", "सुर्खेत", "दैलेख", "जाजरकोट", "डोल्पा",
    "जुम्ला", "कालिकोट", "मुगु", "हुम्ला", "बाजुरा", "बझाङ", "अछाम",
    "डोटी", "कैलाली", "कञ्चनपुर", "डडेल्धुरा", "बैतडी", "दार्चुला",
)
#: Words of at least two characters of the script; a danda stays glued to the word before it.
TOKEN = f"[{DEVANAGARI}]{{2,}}"
BANDS = (("high", 0.8), ("medium", 0.6))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def detect(df: DataFrame, text_col: str = "text", config: LanguageConfig = LanguageConfig()) -> DataFrame:
    """Add `detection`: is_match, confidence, reason_code, script_ratio, hits, words. hits and words
    are null where the script ratio already decided."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    df = df.withColumn("__ratio", script_ratio(t))
    gated = F.col("__ratio") >= config.min_script_ratio
    df = df.withColumn("__tokens", F.when(gated, tokens(t)))
    # Set intersections can't count repeats; a filter over the tokens can.
    lexicon = F.array(*map(F.lit, LEXICON))
    df = df.withColumn("__hits", F.size(F.filter("__tokens", lambda w: F.array_contains(lexicon, w))).cast("bigint"))
    df = df.withColumn("__words", F.size("__tokens").cast("bigint"))
    boosted = F.when(F.col("__words") > 0, F.least(F.lit(1.0), F.col("__ratio") + config.lexicon_weight * F.col("__hits") / F.col("__words"))).otherwise(F.col("__ratio"))
    df = df.withColumn("__conf", F.when(gated, boosted).otherwise(F.col("__ratio")))
    empty = F.length(t) == 0
    detection = F.struct(
        (gated & ~empty & (F.col("__conf") >= config.min_confidence)).alias("is_match"),
        F.when(empty, 0.0).otherwise(F.col("__conf")).alias("confidence"),
        F.when(empty, "empty_text").when(~gated, "low_script_ratio").otherwise("confidence").alias("reason_code"),
        F.col("__ratio").alias("script_ratio"),
        F.when(gated & ~empty, F.col("__hits")).alias("hits"),
        F.when(gated & ~empty, F.col("__words")).alias("words"),
    )
    return df.withColumn("detection", detection).drop("__ratio", "__tokens", "__hits", "__words", "__conf")


def filter_language(df: DataFrame, text_col: str = "text", config: LanguageConfig = LanguageConfig()) -> DataFrame:
    """Rows in the language, with language_confidence and devanagari_ratio set."""
    out = detect(df, text_col, config).filter("detection.is_match")
    return out.withColumns({"language_confidence": F.col("detection.confidence"), "devanagari_ratio": F.col("detection.script_ratio")}).drop("detection")


def band(detection: Column) -> Column:
    out = F.lit("low")
    for name, least in reversed(BANDS):
        out = F.when(detection["confidence"] >= least, name).otherwise(out)
    return F.when(detection["is_match"], out).otherwise("rejected")


def bands(df: DataFrame, text_col: str = "text", config: LanguageConfig = LanguageConfig()) -> DataFrame:
    """(band, rows) over all rows."""
    return detect(df, text_col, config).groupBy(band(F.col("detection")).alias("band")).agg(F.count("*").alias("rows"))


def lexicon_hits(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, hits): how often each word of the list occurs."""
    spark = df.sparkSession
    lexicon = spark.createDataFrame([(w,) for w in LEXICON], "word string")
    found = df.select(F.explode(tokens(F.col(text_col))).alias("word"))
    return found.join(lexicon, "word", "left_semi").groupBy("word").agg(F.count("*").alias("hits"))
