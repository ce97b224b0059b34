"""Sources: Parquet trees, text, CSV, JSON, archives, MediaWiki dumps.

Each text reader gives one row per non-blank text, stripped, in a column `text`; a missing
text column or an unknown format is a ValueError.
"""

from __future__ import annotations

import re
import tarfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sarangi.functions.text import is_blank, strip

ARCHIVES = (".zip", ".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tar.xz")
UNSUPPORTED_ARCHIVES = (".zst", ".7z", ".rar")
# Fixed value: the schema of pages in a dump.
PAGE = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("ns", T.IntegerType()), T.StructField("id", T.StringType()),
    T.StructField("revision", T.StructType([
        T.StructField("timestamp", T.StringType()),
        T.StructField("text", T.StructType([T.StructField("_VALUE", T.StringType())])),
    ])),
])


def parquet_tree(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below a folder, with dataset_name (the file's folder), file_path and row_index,
    which order rows as they lie."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)
    file = F.col("_metadata.file_path")
    extra = {"file_path": file, "row_index": F.col("_metadata.row_index")}
    if "dataset_name" not in df.columns:
        extra["dataset_name"] = F.regexp_extract(file, r"([^/]+)/[^/]+$", 1)
    return df.withColumns(extra)


def sites(path: str) -> list[str]:
    return sorted(p.name for p in Path(path).iterdir() if p.is_dir())


def _texts(df: DataFrame, column: str | None) -> DataFrame:
    if not column or column not in df.columns:
        raise ValueError(f"text column {column!r} not among {df.columns}")
    text = F.col(column).cast("string")
    return df.filter(~is_blank(text)).withColumn("text", strip(text))


def read_texts(spark: SparkSession, path: str, text_column: str | None = None, format: str | None = None) -> DataFrame:
    """One file or folder of texts, by format or suffix: text, csv, jsonl, json, parquet."""
    suffix = (format or Path(path).suffix.lstrip(".")).lower()
    if suffix in ("txt", "text"):
        return _texts(spark.read.text(path), "value").select("text")
    if suffix == "csv":
        return _texts(spark.read.csv(path, header=True, multiLine=True, escape='"'), text_column)
    if suffix == "jsonl":
        return _texts(spark.read.json(path), text_column)
    if suffix == "json":
        return _texts(spark.read.json(path, multiLine=True), text_column)
    if suffix == "parquet":
        return _texts(spark.read.parquet(path), text_column)
    raise ValueError(f"unsupported format {suffix!r}")


def read_text_folder(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all .txt files below a folder, readme files left out."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(path)
    df = df.filter(~F.lower("_metadata.file_name").isin("readme.txt"))
    return _texts(df, "value").select("text")


def is_archive(path: str) -> bool:
    return path.lower().endswith(ARCHIVES + UNSUPPORTED_ARCHIVES)


def extract_archive(path: str, target: str) -> str:
    """Unpack; members that would leave the target are an error."""
    root = Path(target).resolve()
    root.mkdir(parents=True, exist_ok=True)
    name = path.lower()
    if name.endswith(UNSUPPORTED_ARCHIVES):
        raise ValueError(f"unsupported archive {path}")
    if name.endswith(".zip"):
        with zipfile.ZipFile(path) as z:
            for member in z.namelist():
                if not (root / member).resolve().is_relative_to(root):
                    raise ValueError(f"unsafe member {member}")
            z.extractall(root)
    elif name.endswith(ARCHIVES):
        with tarfile.open(path) as t:
            t.extractall(root, filter="data")
    else:
        raise ValueError(f"not an archive: {path}")
    return str(root)


def dataset_rows(df: DataFrame, text_column: str, dataset: str) -> DataFrame:
    """Rows of a ready-made dataset as (text, source, dataset_name): source from Source, source or the dataset."""
    if text_column not in df.columns:
        raise ValueError(f"no column {text_column}")
    found = [F.col(c).cast("string") for c in df.columns if c in ("Source", "source")]
    source = F.coalesce(*found, F.lit(dataset))
    return _texts(df, text_column).select("text", source.alias("source"), F.lit(dataset).alias("dataset_name"))


def wiki_namespace(head: str) -> str | None:
    """The XML namespace named in the head of a dump."""
    m = re.search(r'xmlns="([^"]+)"', head[:5000])
    return m[1] if m else None


def wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a MediaWiki dump, also compressed: title, ns, id, timestamp, markup."""
    df = spark.read.format("xml").option("rowTag", "page").schema(PAGE).load(path)
    return df.select("title", F.coalesce("ns", F.lit(-1)).alias("ns"), "id", F.col("revision.timestamp").alias("timestamp"), F.col("revision.text._VALUE").alias("markup"))


def url_list(spark: SparkSession, path: str) -> DataFrame:
    return _texts(spark.read.text(path), "value").select(F.col("text").alias("url"))
