"""Incremental exact deduplication of a stream of files: each micro-batch is checked against a
store of hashes, which it extends. A batch that is repeated after a failure writes the same
folder again, and the store keeps one row per hash and batch, so nothing counts twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sarangi.operators.exact_dedup import content_hash


def _store(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema("hash string, batch bigint").option("recursiveFileLookup", True).parquet(path)
    except Exception:  # noqa: BLE001 - no store yet
        return spark.createDataFrame([], "hash string, batch bigint")


def dedup_stream(spark: SparkSession, source: str, schema: StructType, out: str, store: str, checkpoint: str, id_col: str, text_col: str = "text") -> StreamingQuery:
    """Read Parquet files as they come; write rows whose text is new, the least id of each text."""

    def batch(df: DataFrame, number: int) -> None:
        known = _store(spark, store).filter(F.col("batch") != number).select("hash").distinct()
        rows = df.withColumn("hash", content_hash(F.col(text_col))).filter("hash is not null").join(known, "hash", "left_anti")
        first = rows.groupBy("hash").agg(F.min(id_col).alias(id_col))
        fresh = rows.join(first, ["hash", id_col], "left_semi").persist()
        fresh.drop("hash").write.mode("overwrite").parquet(f"{out}/batch={number}")
        fresh.select("hash", F.lit(number).cast("bigint").alias("batch")).distinct().write.mode("overwrite").parquet(f"{store}/part-{number}")
        fresh.unpersist()

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time_col: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per window and kind, of a stream or a table; later events than the watermark are left out of a stream."""
    return events.withWatermark(time_col, late).groupBy(F.window(time_col, width).alias("w"), by).agg(F.count("*").alias("events")).select(F.col("w.start").alias("window_start"), by, "events")
