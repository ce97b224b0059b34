"""The stages from raw corpus to deduplicated corpus as one plan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sarangi.config import CleanConfig, ExactDedupConfig, LanguageConfig, NearDedupConfig, SegmentConfig
from sarangi.operators import cleaning, exact_dedup, language, near_dedup, segmentation
from sarangi.session import stored
from sarangi.sources.sinks import write_by_dataset


@dataclass(frozen=True)
class PipelineConfig:
    clean: CleanConfig = field(default_factory=CleanConfig)
    language: LanguageConfig = field(default_factory=LanguageConfig)
    segment: SegmentConfig = field(default_factory=SegmentConfig)
    exact: ExactDedupConfig = field(default_factory=ExactDedupConfig)
    near: NearDedupConfig = field(default_factory=NearDedupConfig)


def preprocess(raw: DataFrame, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Clean, filter by language and segment: narrow work in one stage."""
    cleaned = cleaning.clean(raw, "text", config.clean)
    return segmentation.segment(language.filter_language(cleaned, "text", config.language), "text", config.segment)


def deduplicate(df: DataFrame, id_col: str, config: PipelineConfig = PipelineConfig()) -> tuple[DataFrame, DataFrame]:
    """The rows that stay after exact and near deduplication, and the near pairs."""
    unique = stored(exact_dedup.first_seen(df, [id_col], "text", config.exact), "pipeline-unique")
    signed = stored(near_dedup.signatures(unique, id_col, "text", config.near), "pipeline-signatures")
    pairs = stored(near_dedup.record_pairs(*near_dedup.lsh_links(signed, config.near), config.near), "pipeline-pairs")
    return near_dedup.survivors(unique, pairs, id_col), pairs


def check_input(spark: SparkSession, path: str) -> DataFrame:
    """The input, or an error that says what is missing, before anything is run."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)
    if "text" not in df.columns:
        raise ValueError(f"{path} has no column text")
    return df


def run(spark: SparkSession, source: str, target: str, id_col: str, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Read, process, write by dataset; returns counts per stage."""
    raw = check_input(spark, source)
    ready = stored(preprocess(raw, config), "pipeline-ready")
    kept, _ = deduplicate(ready, id_col, config)
    write_by_dataset(cleaning.with_defaults(kept, cleaning.DEFAULTS | {"dataset_name": "unknown"}), target)
    counts = [raw.select(F.lit("raw").alias("stage"), F.lit(1).alias("n")), ready.select(F.lit("preprocessed").alias("stage"), F.lit(1).alias("n")), spark.read.parquet(target).select(F.lit("deduplicated").alias("stage"), F.lit(1).alias("n"))]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).groupBy("stage").agg(F.count("*").alias("rows"))
