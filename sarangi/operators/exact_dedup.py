"""Exact duplicates by content hash, and stores of hashes seen.

Groups are formed by hash, so a text that a third of all rows share makes one large group;
all group results here are min, count or an anti-join, which are pre-aggregated or split by
the engine, and no group is gathered in one task except by window functions, which the
first-seen filters avoid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sarangi.config import ExactDedupConfig
from sarangi.functions.text import digest

HEX_LENGTHS = {"sha256": 64, "md5": 32}


def content_hash(text: Column, config: ExactDedupConfig = ExactDedupConfig()) -> Column:
    """Hex digest; null texts hash as 'None' if so configured, else give null."""
    return digest(F.coalesce(text, F.lit("None")) if config.null_as_text else text, config.digest)


def _hashed(df: DataFrame, text_col: str, config: ExactDedupConfig) -> DataFrame:
    out = df.withColumn("__hash", content_hash(F.col(text_col), config))
    return out if config.null_as_text else out.filter("__hash is not null")


def first_seen(df: DataFrame, order: list[str], text_col: str = "text", config: ExactDedupConfig = ExactDedupConfig()) -> DataFrame:
    """Rows that are the first of their text in `order`, which must tell rows apart.

    In chunked mode the order's last column is a row number, rows form chunks of chunk_rows
    by it, and all rows of the first chunk that holds a text stay. The winner comes from a
    partial aggregate of narrow rows, not from a window over whole ones.
    """
    rows = _hashed(df, text_col, config)
    if config.mode == "chunked":
        keys = [*(F.col(c) for c in order[:-1]), F.floor(F.col(order[-1]) / config.chunk_rows)]
    elif config.mode == "strict":
        keys = [F.col(c) for c in order]
    else:
        raise ValueError(f"unknown mode {config.mode}")
    place = F.struct(*(k.alias(f"k{i}") for i, k in enumerate(keys)))
    rows = rows.withColumn("__place", place)
    best = rows.groupBy("__hash").agg(F.min("__place").alias("__place"))
    return rows.join(best, ["__hash", "__place"], "left_semi").drop("__hash", "__place")


def unseen(df: DataFrame, store: DataFrame, text_col: str = "text", config: ExactDedupConfig = ExactDedupConfig()) -> DataFrame:
    """Rows whose text the store holds by no digest of store_digests, told apart by length; letter
    case of stored hashes is ignored. All digests are made before the joins, which so carry no text
    that isn't asked for."""
    text = F.coalesce(F.col(text_col), F.lit("None")) if config.null_as_text else F.col(text_col)
    rows = df.withColumns({f"__{kind}": digest(text, kind) for kind in config.store_digests})
    rows = rows if config.null_as_text else rows.filter(F.col(text_col).isNotNull())
    for kind in config.store_digests:
        known = store.filter(F.length("hash") == HEX_LENGTHS[kind]).select(F.lower("hash").alias(f"__{kind}")).distinct()
        rows = rows.join(known, f"__{kind}", "left_anti").drop(f"__{kind}")
    return rows


def new_hashes(df: DataFrame, store: DataFrame, dataset_col: str, order_col: str, text_col: str = "text", config: ExactDedupConfig = ExactDedupConfig()) -> DataFrame:
    """(hash, dataset_name) to add to the store: the first dataset by order wins."""
    fresh = unseen(df, store, text_col, config).withColumn("__hash", content_hash(F.col(text_col), config))
    return fresh.groupBy(F.col("__hash").alias("hash")).agg(F.min_by(dataset_col, order_col).alias("dataset_name"))


def duplicate_groups(df: DataFrame, id_col: str, text_col: str = "text", config: ExactDedupConfig = ExactDedupConfig()) -> DataFrame:
    """(hash, copies, first_id) of texts with more than one row."""
    out = _hashed(df, text_col, config).groupBy(F.col("__hash").alias("hash"))
    return out.agg(F.count("*").alias("copies"), F.min(id_col).alias("first_id")).filter("copies > 1")


def dedup_stats(df: DataFrame, text_col: str = "text", config: ExactDedupConfig = ExactDedupConfig()) -> DataFrame:
    """One row: total, unique, duplicates, duplicate_rate in percent."""
    per = _hashed(df, text_col, config).groupBy("__hash").agg(F.count("*").alias("n"))
    out = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("*").alias("unique_rows"))
    dup = F.col("total_rows") - F.col("unique_rows")
    return out.select("total_rows", "unique_rows", dup.alias("duplicate_rows"), F.round(F.when(F.col("total_rows") > 0, 100.0 * dup / F.col("total_rows")).otherwise(0.0), 2).alias("duplicate_rate"))


def micro_batches(df: DataFrame, dataset_col: str, seq_col: str, text_col: str = "text", size: int = 900) -> DataFrame:
    """Rows kept when batches of `size` rows of a dataset are probed against all earlier batches of
    all datasets, in order of dataset: copies within one batch all stay."""
    return first_seen(df, [dataset_col, seq_col], text_col, ExactDedupConfig(mode="chunked", chunk_rows=size))


def owned(df: DataFrame, dataset_col: str, order_col: str, text_col: str = "text") -> DataFrame:
    """Rows kept when a text is a duplicate only within the dataset that met it first: elsewhere
    its copies all stay."""
    rows = _hashed(df, text_col, ExactDedupConfig())
    best = rows.groupBy("__hash").agg(F.min(F.struct(order_col, dataset_col)).alias("__first"))
    rows = rows.join(best, "__hash")
    return rows.filter((F.col(dataset_col) != F.col(f"__first.{dataset_col}")) | (F.col(order_col) == F.col(f"__first.{order_col}"))).drop("__hash", "__first")
