"""The pN_ queries of the training-data operators, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sarangi.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sarangi.llm.tsearch import expand, near_duplicates

    return expand(*near_duplicates(table(spark, sf_dir, "preprocessed"))).select("doc_id_a", "doc_id_b")


def p1_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record: its class of equal texts and the links of that class to others."""
    from sarangi.llm.tsearch import class_table, near_duplicates

    return class_table(*near_duplicates(table(spark, sf_dir, "preprocessed")))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sarangi.llm.sentences import learn, sentence_table

    docs = table(spark, sf_dir, "documents")
    return sentence_table(docs, learn(docs))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sarangi.llm.forest import replay

    return replay(table(spark, sf_dir, "preprocessed"), table(spark, sf_dir, "hashes"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sarangi.llm.lines import repeated_lines

    return repeated_lines(table(spark, sf_dir, "scraped_articles"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sarangi.llm.boilerplate import content_flags

    return content_flags(table(spark, sf_dir, "scraped_articles")).filter("not is_body").select("record_id", "line_no")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sarangi.llm.language import fitted, paragraph_languages

    docs = table(spark, sf_dir, "documents")
    found = paragraph_languages(docs, fitted(docs))
    return found.filter("mixed or not right").select("doc_id", "para_no", "lang")


def p7_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph's language with its confidence."""
    from sarangi.llm.language import fitted, paragraph_languages

    docs = table(spark, sf_dir, "documents")
    return paragraph_languages(docs, fitted(docs)).select("doc_id", "para_no", "lang", F.round("language_confidence", 6).alias("language_confidence"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sarangi.llm.tokens import encode_texts

    return encode_texts(table(spark, sf_dir, "documents"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix: records with their tokens and copies."""
    from sarangi.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual shares."""
    from sarangi.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sarangi.llm.mojibake import repair_table

    found = repair_table(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.coalesce(F.md5(F.encode("restored", "UTF-8")), F.lit("")).alias("fixed_md5"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p1_found": p1_found, "p1_classes": p1_classes, "p2_found": p2_found, "p4_found": p4_found, "p5_found": p5_found, "p6_found": p6_found, "p7_found": p7_found, "p7_segments": p7_segments, "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found}
ORACLE_SQL: dict[str, str] = {}
