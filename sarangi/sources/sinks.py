"""Sinks: partitioned and numbered Parquet, JSON statistics, url lists, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_by_dataset(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per dataset_name. Rows are spread by dataset and a salt, so that a large dataset
    isn't written by one task."""
    salted = df.repartition(F.col("dataset_name"), F.pmod(F.xxhash64(*df.columns[:1]), F.lit(64)))
    salted.write.mode(mode).partitionBy("dataset_name").parquet(path)


def write_batches(df: DataFrame, path: str, rows: int = 50_000, mode: str = "overwrite") -> None:
    """Files of at most `rows` rows."""
    df.write.mode(mode).option("maxRecordsPerFile", rows).parquet(path)


def write_batch(df: DataFrame, path: str, format: str = "parquet") -> None:
    """A batch that appears whole or not at all, by the output committer."""
    if format not in ("parquet", "jsonl"):
        raise ValueError(f"unknown format {format}")
    df.write.mode("append").format("json" if format == "jsonl" else "parquet").save(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def export_article_urls(urls: DataFrame, path: str) -> None:
    """Article urls in order, one a line."""
    urls.filter("is_article = 1").select("url").orderBy("url").write.mode("overwrite").text(path)


def write_stats(df: DataFrame, path: str) -> None:
    """A small result as JSON, with the time of writing."""
    df.withColumn("written_at", F.current_timestamp()).write.mode("append").json(path)


def pending_files(spark: SparkSession, files: DataFrame, manifest: str) -> DataFrame:
    """Files (file_path) that the manifest doesn't hold yet; all where there is none."""
    try:
        done = spark.read.parquet(manifest)
    except Exception:  # noqa: BLE001 - no manifest yet
        return files
    return files.join(done.select("file_path").distinct(), "file_path", "left_anti")


def mark_done(files: DataFrame, manifest: str) -> None:
    files.select("file_path").distinct().withColumn("done_at", F.current_timestamp()).write.mode("append").parquet(manifest)
