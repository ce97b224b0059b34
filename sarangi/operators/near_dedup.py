"""Near duplicates by MinHash signatures and banded buckets, with links recorded as pairs.

Shingles are hashed to 32 bits of their MD5; a signature is the minimum of (a_i h + b_i) mod p
over them, per permutation, all in one vectorised Python step; bands of rows are hashed to
bucket keys in the JVM. Records that share a bucket are candidates: the one self-join
is on (band, bucket), whose hot buckets adaptive execution splits. Records with equal
signatures are collapsed before it, so copies can't multiply, and come back by membership.

Null texts count as empty; records without shingles have no signature and no links.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sarangi.config import NearDedupConfig

#: Characters that survive normalisation, besides white space.
KEPT = r"\u0900-\u097f\u0980-\u09ff.,!?;:\-()\[\]{}\"'।॥"
_DROPPED = re.compile(rf"[^{KEPT}\s]")
PRIME = 2_147_483_647


def permutation(i: int) -> tuple[int, int]:
    """Coefficients of the i-th permutation, by rule."""
    return 1 + (1_103_515_245 * (i + 1) + 12_345) % (PRIME - 1), (69_069 * (i + 7) * (i + 7) + 1) % PRIME


def normal_text(text: str | None) -> str:
    """Form C, characters outside KEPT as spaces, white space squeezed."""
    return " ".join(_DROPPED.sub(" ", unicodedata.normalize("NFC", text or "")).split())


def shingle_set(normal: str) -> set[str]:
    """Two- and three-word runs; of texts with at most one word, three-character runs."""
    w = normal.split()
    runs = {" ".join(w[i : i + n]) for n in (2, 3) for i in range(len(w) - n + 1)}
    return runs or {normal[i : i + 3] for i in range(len(normal) - 2)}


def hashes_of(text: str | None) -> np.ndarray:
    """Sorted 32-bit hashes of a text's shingles."""
    found = {int.from_bytes(hashlib.md5(s.encode()).digest()[:4], "big") for s in shingle_set(normal_text(text))}
    return np.array(sorted(found), dtype=np.int64)


@F.pandas_udf(T.ArrayType(T.LongType()))
def base_hashes(text: pd.Series) -> pd.Series:
    return text.map(hashes_of)


def _signature(permutations: int):
    a, b = (np.array(x, dtype=np.uint64) for x in zip(*map(permutation, range(permutations))))
    p = np.uint64(PRIME)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def run(text: pd.Series) -> pd.Series:
        out = []
        for h in map(hashes_of, text):
            if not len(h):
                out.append(None)
                continue
            h, best = h.astype(np.uint64) % p, np.full(permutations, p)
            for k in range(0, len(h), 256):
                best = np.minimum(best, ((h[k : k + 256, None] * a + b) % p).min(axis=0))
            out.append(best.astype(np.int64))
        return pd.Series(out)

    return run


def signatures(df: DataFrame, id_col: str, text_col: str = "text", config: NearDedupConfig = NearDedupConfig()) -> DataFrame:
    """(id, signature) of the records that have shingles, in one vectorised step."""
    signed = df.select(F.col(id_col).alias("id"), _signature(config.permutations)(F.col(text_col)).alias("signature"))
    return signed.filter("signature is not null")


def buckets(signed: DataFrame, config: NearDedupConfig = NearDedupConfig()) -> DataFrame:
    """(id, band, bucket): the persisted form of the index."""
    r = config.rows
    keys = F.array(*[F.md5(F.array_join(F.slice("signature", i * r + 1, r).cast("array<string>"), ",")) for i in range(config.bands)])
    return signed.select("id", F.posexplode(keys).alias("band", "bucket")).withColumn("band", F.col("band").cast("bigint"))


def lsh_links(signed: DataFrame, config: NearDedupConfig = NearDedupConfig()) -> tuple[DataFrame, DataFrame]:
    """Links (a, b), a < b, between representatives of equal signatures, and membership (id, rep)."""
    keyed = signed.withColumn("sig", F.md5(F.array_join(F.col("signature").cast("array<string>"), ",")))
    reps = keyed.groupBy("sig").agg(F.min("id").alias("rep"))
    members = keyed.select("id", "sig").join(reps, "sig").select("id", "rep")
    mine = buckets(keyed.join(reps.select(F.col("rep").alias("id")), "id", "left_semi"), config)
    a, b = mine.select(F.col("id").alias("a"), "band", "bucket"), mine.select(F.col("id").alias("b"), "band", "bucket")
    return a.join(b, ["band", "bucket"]).filter("a < b").select("a", "b").distinct(), members


def record_pairs(links: DataFrame, members: DataFrame, config: NearDedupConfig = NearDedupConfig()) -> DataFrame:
    """(canonical_doc_id, duplicate_doc_id, similarity) as the duplicates table holds them: the earlier
    id is canonical, the similarity is the threshold; members of a class hang on its representative."""
    own = members.filter("id != rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    return links.unionByName(own).select(F.col("a").alias("canonical_doc_id"), F.col("b").alias("duplicate_doc_id"), F.lit(config.threshold).alias("similarity"))


def jaccard(pairs: DataFrame, df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(a, b, jaccard) measured on the shingles."""
    sets = df.select(F.col(id_col).alias("id"), base_hashes(F.col(text_col)).alias("s"))
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", (shared / (F.size("sa") + F.size("sb") - shared)).alias("jaccard"))


def neighbours(pairs: DataFrame) -> DataFrame:
    """(doc_id, other) in both directions, distinct."""
    a, b = F.col("canonical_doc_id"), F.col("duplicate_doc_id")
    return pairs.select(a.alias("doc_id"), b.alias("other")).unionByName(pairs.select(b.alias("doc_id"), a.alias("other"))).distinct()


def upsert_pairs(old: DataFrame, new: DataFrame) -> DataFrame:
    """The pair table after new rows replace old ones of the same key; the latest detection wins."""
    both = old.unionByName(new, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in ("canonical_doc_id", "duplicate_doc_id")]
    latest = F.max(F.struct("detected_at", *[c for c in rest if c != "detected_at"])).alias("v")
    return both.groupBy("canonical_doc_id", "duplicate_doc_id").agg(latest).select("canonical_doc_id", "duplicate_doc_id", *(F.col(f"v.{c}").alias(c) for c in rest))


def survivors(df: DataFrame, pairs: DataFrame, id_col: str) -> DataFrame:
    """Records that no pair names as a duplicate."""
    return df.join(pairs.select(F.col("duplicate_doc_id").alias(id_col)).distinct(), id_col, "left_anti")


def query_similar(signed: DataFrame, index: DataFrame, config: NearDedupConfig = NearDedupConfig()) -> DataFrame:
    """(id, other) of records that share a bucket with a stored index, without adding them."""
    stored_ = index.select(F.col("id").alias("other"), "band", "bucket")
    return buckets(signed, config).join(stored_, ["band", "bucket"]).filter("id != other").select("id", "other").distinct()
