"""New batches against everything accepted, by a prefix-tree hash forest.

Each tree is a permutation of the signatures: a record's label in it is DEPTH min-wise
hashes, 16 bits each, the first foremost, so that labels in order are a prefix tree laid
flat and a common prefix of d hashes is a range. Entries are located by range search at the
deepest prefix first and prefixes are widened, until the recall of TREES trees at that
depth reaches the target; what is located is filtered by a sketch of min-wise bits and then
verified exactly. The history's texts are never read again: runs hold signatures, and
small runs are merged.

`HashForest.add` takes one batch. `replay` takes many batches at once, which is cheaper when
all are at hand: one range search over the runs of all batches gives the links between
classes of equal sets, and acceptance is then settled batch by batch on these links alone.

A record is a case if its text's digest was known before it came, or if it is similar to an
accepted record of an earlier batch. Null texts and those of fewer than MIN_WORDS words take
no part. Digests compare without case, by length SHA-256 or MD5; ties of first_seen and
arrival are no cases. The first batch is accepted whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sarangi.llm.shingles import Shingler, mix, overlap, required
from sarangi.session import new_path, stored

TENTHS, TREES, DEPTH, TARGET = 7, 24, 4, 0.9999
BITS, SIGMAS = 192, 6.5
_A = (mix(np.arange(1, BITS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (mix(np.arange(1001, BITS + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def recall(depth: int, trees: int = TREES, tenths: int = TENTHS) -> float:
    return 1 - (1 - (tenths / 10) ** depth) ** trees


def depths(target: float = TARGET, trees: int = TREES, tenths: int = TENTHS) -> list[int]:
    """From the deepest prefix to the first whose recall reaches the target."""
    out = []
    for d in range(DEPTH, 0, -1):
        out.append(d)
        if recall(d, trees, tenths) >= target:
            return out
    raise ValueError(f"{trees} trees can't reach a recall of {target}")


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels of the trees, and the sketch as three numbers."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(BITS, np.uint32(0xFFFFFFFF))
    for k in range(0, len(x), 1024):
        best = np.minimum(best, (x[k : k + 1024, None] * _A + _B).min(axis=0))
    stirred = mix(best.astype(np.uint64) + (np.arange(BITS, dtype=np.uint64) << np.uint64(32)))
    parts = (stirred[: TREES * DEPTH].reshape(TREES, DEPTH) & np.uint64(0xFFFF)) << np.array([48, 32, 16, 0], dtype=np.uint64)
    bits = np.packbits(((stirred >> np.uint64(40)) & np.uint64(1)).astype(np.uint8)).view(np.int64)
    return np.bitwise_or.reduce(parts, axis=1).view(np.int64), bits


def pack(shingles: np.ndarray) -> bytes:
    return (shingles >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
    return out.view(np.uint64).ravel()


def class_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def signatures(docs: DataFrame) -> DataFrame:
    """(id, batch, cls, n, s0..s2, labels) of the records of `docs` (id, batch, text) that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for b in batches:
            sets = shingler.sets(b.column("text").to_pylist())
            keep = pa.array([s is not None for s in sets], pa.bool_())
            sets = [s for s in sets if s is not None]
            signed = [signature(s) for s in sets]
            flat = np.concatenate([x for x, _ in signed]) if signed else np.zeros(0, dtype=np.int64)
            sketch = np.stack([s for _, s in signed]) if signed else np.zeros((0, 3), dtype=np.int64)
            labels = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * TREES, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [b.column("id").filter(keep), b.column("batch").filter(keep), pa.array([class_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), *(pa.array(np.ascontiguousarray(sketch[:, k])) for k in range(3)), labels],
                ["id", "batch", "cls", "n", "s0", "s1", "s2", "labels"],
            )

    return docs.select("id", "batch", "text").mapInArrow(run, "id string, batch int, cls bigint, n int, s0 bigint, s1 bigint, s2 bigint, labels array<bigint>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(cls, packed) of the records of `docs` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for b in batches:
            sets = [s for s in shingler.sets(b.column("text").to_pylist()) if s is not None]
            yield pa.RecordBatch.from_arrays([pa.array([class_of(s) for s in sets], pa.int64()), pa.array([pack(s) for s in sets], pa.binary())], ["cls", "packed"])

    return docs.select("text").mapInArrow(run, "cls bigint, packed binary")


def ranges(signed: DataFrame, depth: int) -> DataFrame:
    """(cls, n, s0..s2, key): the range of each label at a depth, keyed by tree and prefix."""
    at = signed.select("cls", F.posexplode("labels").alias("tree", "label"))
    return at.select("cls", F.xxhash64("tree", F.shiftright("label", 16 * (DEPTH - depth))).alias("key"))


def _near(tenths: int) -> Column:
    p = (1 - tenths / 10) / 2
    limit = math.floor(BITS * p + SIGMAS * math.sqrt(BITS * p * (1 - p)))
    differ = F.bit_count(F.col("a_s0").bitwiseXOR(F.col("b_s0"))) + F.bit_count(F.col("a_s1").bitwiseXOR(F.col("b_s1"))) + F.bit_count(F.col("a_s2").bitwiseXOR(F.col("b_s2")))
    return (F.col("a_n") * 10 >= F.col("b_n") * tenths) & (F.col("b_n") * 10 >= F.col("a_n") * tenths) & (differ <= limit)


_SKETCH = ("cls", "n", "s0", "s1", "s2")


def links_within(classes: DataFrame, depth: int, tenths: int = TENTHS) -> DataFrame:
    """Distinct candidate links (a, b), a < b, between classes that share a range."""
    at = ranges(classes, depth)
    shared = at.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1").select("key")
    live = at.join(shared, "key").join(classes.select(*_SKETCH), "cls")
    live = stored(live, "forest-ranges")
    a, b = (live.select("key", *(F.col(c).alias(f"{x}_{c}") for c in _SKETCH)) for x in "ab")
    return a.join(b, "key").filter((F.col("a_cls") < F.col("b_cls")) & _near(tenths)).select(F.col("a_cls").alias("a"), F.col("b_cls").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, other: DataFrame | None = None, tenths: int = TENTHS) -> DataFrame:
    """The pairs (a, b) whose sets, of `sets` and `other`, have the required overlap."""
    other = sets if other is None else other
    both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("packed").alias("pa")), "a").join(other.select(F.col("cls").alias("b"), F.col("packed").alias("pb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            keep = []
            for x, y in zip(t.column("pa").to_pylist(), t.column("pb").to_pylist()):
                x, y = unpack(x), unpack(y)
                keep.append(overlap(x, y) >= required(len(x), len(y), tenths))
            yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "pa", "pb").mapInArrow(run, "a bigint, b bigint")


def known_digests(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """(id) of records whose text's digest was first seen before they came."""
    seen = hashes.filter("hash is not null and first_seen is not null").select(F.unhex("hash").alias("digest"), "first_seen").groupBy("digest").agg(F.min("first_seen").alias("first_seen"))
    mine = docs.filter("text is not null").select("id", "batch_at", F.explode(F.array(F.unhex(F.sha2("text", 256)), F.unhex(F.md5("text")))).alias("digest"))
    return mine.join(seen, "digest").filter(F.col("first_seen") < F.col("batch_at")).select("id").distinct()


def one_per_class(signed: DataFrame) -> DataFrame:
    """A row per class. Copies are told by narrow rows; most classes have none and stay where they are."""
    first = signed.groupBy("cls").agg(F.min("id").alias("first"), F.count("*").alias("copies")).filter("copies > 1").drop("copies")
    others = signed.select("id", "cls").join(first, "cls").filter("id != first").select("id")
    return signed.join(others, "id", "left_anti")


def replay(docs: DataFrame, hashes: DataFrame, target: float = TARGET, tenths: int = TENTHS) -> DataFrame:
    """(doc_id) of the cases of `docs` (doc_id, batch_no, batch_at, text) in order of batch_no."""
    spark = docs.sparkSession
    docs = docs.filter("doc_id is not null and batch_no is not null").select(F.col("doc_id").alias("id"), F.col("batch_no").cast("int").alias("batch"), "batch_at", "text")
    signed = stored(signatures(docs), "forest-signatures")
    classes = one_per_class(signed)
    found = stored(links_within(classes, depths(target, TREES, tenths)[-1], tenths), "forest-candidates")
    needed = found.select(F.col("a").alias("cls")).unionByName(found.select(F.col("b").alias("cls"))).distinct()
    # The texts of linked classes alone are read again, one record a class.
    chosen = classes.select("id", "cls").join(needed, "cls", "left_semi").select("id")
    sets = shingle_sets(docs.join(chosen, "id", "left_semi"))
    sets = stored(sets, "forest-sets")
    one_way = verified(found, sets, tenths=tenths)
    links = stored(one_way.unionByName(one_way.select(F.col("b").alias("a"), F.col("a").alias("b"))), "forest-links")
    hits = known_digests(docs.filter("batch > 0"), hashes)
    known = signed.select("id", "batch", "cls").join(hits.withColumn("hit", F.lit(True)), "id", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    known = stored(known, "forest-members")
    return _settle(spark, known, links)


def _settle(spark, members: DataFrame, links: DataFrame) -> DataFrame:
    """Acceptance in order of batch over members (id, batch, cls, hit) and symmetric links (a, b).

    Accepting a class in a batch blocks it and its neighbours from the next batch on; only
    classes with links or copies are touched, and each batch writes only what it newly blocks.
    """
    several = members.groupBy("cls").agg(F.min("batch").alias("lo"), F.max("batch").alias("hi")).filter("lo < hi").select("cls")
    active = several.unionByName(links.select(F.col("a").alias("cls"))).distinct()
    units = members.join(active, "cls", "left_semi").groupBy("cls", "batch").agg(F.min("hit").alias("all_hit"))
    units = stored(units, "forest-units")
    batches = sorted(r["batch"] for r in units.select("batch").distinct().collect())
    path, schema, done = new_path(spark, "forest-blocked"), "cls bigint, since int", False
    for k in batches:
        free = units.filter((F.col("batch") == k) & (F.lit(k == 0) | ~F.col("all_hit"))).select("cls")
        if done:
            free = free.join(spark.read.schema(schema).parquet(path), "cls", "left_anti")
        around = free.join(links, free["cls"] == links["a"]).select(F.col("b").alias("cls"))
        free.unionByName(around).distinct().withColumn("since", F.lit(k)).write.mode("append").parquet(path)
        done = True
    own = members.filter("batch > 0 and hit").select("id")
    if not done:
        return own.select(F.col("id").alias("doc_id")).distinct()
    since = spark.read.schema(schema).parquet(path).groupBy("cls").agg(F.min("since").alias("since"))
    similar = members.filter("batch > 0").join(since, "cls").filter("since < batch").select("id")
    return own.unionByName(similar).distinct().select(F.col("id").alias("doc_id"))


@dataclass
class HashForest:
    """Incremental use: runs of accepted records in the shared folder, newest last."""

    target: float = TARGET
    tenths: int = TENTHS
    max_runs: int = 8
    runs: list[DataFrame] = field(default_factory=list)
    batches: int = 0

    def add(self, batch: DataFrame, hashes: DataFrame | None = None) -> DataFrame:
        """Take a batch (doc_id, batch_at, text); returns its cases (doc_id) and accepts the rest."""
        docs = batch.filter("doc_id is not null").select(F.col("doc_id").alias("id"), F.lit(self.batches).alias("batch"), "batch_at", "text")
        new = stored(signatures(docs), "forest-batch")
        sets = stored(shingle_sets(docs).dropDuplicates(["cls"]), "forest-batch-sets")
        cases = None
        if self.batches:
            cases = new.select("id").limit(0)
            if hashes is not None:
                cases = known_digests(docs, hashes).join(new.select("id"), "id", "left_semi")
            for run in self.runs:
                cases = cases.unionByName(self._probe(new, sets, run))
            cases = stored(cases.distinct(), "forest-cases")
            new = new.join(cases, "id", "left_anti")
        self.batches += 1
        self.runs.append(stored(new.dropDuplicates(["cls"]).join(sets, "cls"), "forest-run"))
        if len(self.runs) > self.max_runs:
            self._merge()
        empty = new.select(F.col("id").alias("doc_id")).limit(0)
        return empty if cases is None else cases.select(F.col("id").alias("doc_id"))

    def _probe(self, new: DataFrame, sets: DataFrame, run: DataFrame) -> DataFrame:
        """Ids of new records similar to one of a run; what is found isn't looked up in wider ranges."""
        cases, open_ = None, new
        for depth in depths(self.target, TREES, self.tenths):
            a = ranges(open_, depth).join(open_.select(*_SKETCH).dropDuplicates(["cls"]), "cls")
            b = ranges(run, depth).join(run.select(*_SKETCH), "cls")
            a, b = (d.select("key", *(F.col(c).alias(f"{x}_{c}") for c in _SKETCH)) for d, x in ((a, "a"), (b, "b")))
            pairs = a.join(b, "key").filter(_near(self.tenths)).select(F.col("a_cls").alias("a"), F.col("b_cls").alias("b")).distinct()
            hit = stored(verified(pairs, sets, run, self.tenths).select(F.col("a").alias("cls")).distinct(), "forest-hits")
            ids = open_.join(hit, "cls", "left_semi").select("id")
            cases = ids if cases is None else cases.unionByName(ids)
            open_ = open_.join(hit, "cls", "left_anti")
        return cases

    def _merge(self) -> None:
        """Merge the runs into one, ordered by class."""
        merged = self.runs[0]
        for run in self.runs[1:]:
            merged = merged.unionByName(run)
        self.runs = [stored(merged.dropDuplicates(["cls"]), "forest-run")]
