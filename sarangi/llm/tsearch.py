"""Near-duplicate pairs by T-occurrence search over inverted lists, with DivideSkip.

Two kinds of lists. The long ones are those of single shingles (two- and three-word
sequences): in a closed vocabulary they grow with the corpus, so they are never merged, only
probed. The short ones are those of grams: the shingles of a record are dealt by hash into m
groups, several times over, and the content of a group of at least two shingles is a gram.
Records that differ in D shingles share every gram that the differences miss. `Space` says
how many groups are posted, so that a pair of the wanted similarity shares at least T grams
but once in 1 / MISS, by the binomial tail of its worst partner; T is two at least for every
size, and more where the sizes allow it.

Search. Gram lists of one record are dropped. Each record leaves out its T - 2 longest gram
lists: of the T shared lists in one global order the leavings of both sides are the longer of
two suffixes, so a pair still occurs together twice. The rest is merged by an equi-join on
the gram, whose hot keys adaptive execution splits; what sizes and sketches of 128 bits rule
out isn't passed on, and occurrences are counted: pairs that occur together fewer than MERGED
times are dropped. The others are probed: each shingle of the shorter record is looked up in
the longer one by binary search, which is whether its (long) list holds that record, and the
pair is kept if the count reaches the overlap that the two sizes require.

Copies (equal shingle sets) are one class, searched once by the member with the least id.
Null texts and texts of fewer than MIN_WORDS words take no part; ids should be unique, and
an id's repeated rows count once; a pair with exactly the wanted similarity is a pair.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sarangi.llm.shingles import Shingler, mix, overlap, required
from sarangi.session import stored

TENTHS = 7
#: Occurrences that a pair needs in the merged lists, the least content of a gram, and how often a pair at the threshold may be missed.
MERGED, CONTENT, MISS = 2, 2, 1e-6
SKETCH_BITS, SKETCH_SIGMAS = 128, 5.5
_SEEDS = mix(np.arange(1, SKETCH_BITS + 1, dtype=np.uint64)) | np.uint64(1)


def groups_for(n: int) -> int:
    """m for a record of n shingles: two to four shingles a group."""
    return max(2, 1 << (n.bit_length() - 2))


def sizes_of(m: int) -> tuple[int, int]:
    """The least and largest record whose own number of groups is m."""
    return (1, 7) if m == 2 else (2 * m, 4 * m - 1)


def share(n: int, partner: int, m: int, tenths: int = TENTHS) -> float:
    """Chance that a pair of these sizes, at the threshold, has a given group as a common gram."""
    common = required(n, partner, tenths)
    if common > min(n, partner):
        return 1.0
    differ = n + partner - 2 * common
    q = 1 - 1 / m
    few = sum(math.comb(common, k) * (1 / m) ** k * q ** (common - k) for k in range(CONTENT))
    return q**differ * (1 - few)


def tail(groups: int, p: float, t: int) -> float:
    """Chance of fewer than t common grams among so many groups."""
    return sum(math.comb(groups, k) * p**k * (1 - p) ** (groups - k) for k in range(t))


def _partners(n: int, lo: int, hi: int, tenths: int) -> list[int]:
    """Sizes between lo and hi of possible partners of n: all of a short range, else a grid with its ends."""
    a, b = max(lo, -(-n * tenths // 10)), min(hi, n * 10 // tenths)
    return sorted({*range(a, b + 1, max(1, (b - a) // 16)), b}) if a <= b else []


@functools.cache
def groups_posted(m: int, tenths: int = TENTHS) -> int:
    """Groups posted under m, for all sizes alike: as many as give MERGED common grams to the worst pair
    of which one has m as its own."""
    lo, hi = sizes_of(m)
    worst = 1.0
    for n in sorted({*range(lo, hi + 1, max(1, (hi - lo) // 32)), hi}):
        for partner in _partners(n, 1, hi, tenths):
            worst = min(worst, share(n, partner, m, tenths))
    out = 16
    while tail(out, worst, MERGED) > MISS:
        out += 4
    return out


@functools.cache
def plan(n: int, tenths: int = TENTHS) -> tuple[tuple[int, bool, int], ...]:
    """(m, native, T) under which a record is indexed: its own m, and that of larger partners."""
    own, upper = groups_for(n), groups_for(n * 10 // tenths)
    out = []
    for m in dict.fromkeys((own, upper)):
        lo, hi = sizes_of(m)
        p = min((share(n, x, m, tenths) for x in _partners(n, lo if m != own else 1, hi, tenths)), default=1.0)
        t = MERGED
        while t < groups_posted(m, tenths) and tail(groups_posted(m, tenths), p, t + 1) <= MISS:
            t += 1
        out.append((m, m == own, t))
    return tuple(out)


def grams(shingles: np.ndarray, m: int, groups: int) -> np.ndarray:
    """Fingerprints of the groups with enough content: of the first `groups` groups, m in each dealing."""
    out = []
    for k in range(-(-groups // m)):
        g = mix(shingles + np.uint64(k * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(m)
        s = shingles
        if groups - k * m < m:
            kept = g < np.uint64(groups - k * m)
            g, s = g[kept], s[kept]
        if not len(g):
            continue
        order = np.argsort(g, kind="stable")
        g = g[order]
        starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        content = np.add.reduceat(mix(s[order] ^ g), starts)
        full = np.diff(np.r_[starts, len(g)]) >= CONTENT
        out.append(mix(content + g[starts] + np.uint64((m << 20) + (k << 8)))[full])
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, dtype=np.int64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """128 bits, one of each min-wise hash, as two numbers."""
    best = np.full(SKETCH_BITS, ~np.uint64(0))
    for k in range(0, len(shingles), 512):
        best = np.minimum(best, (shingles[k : k + 512, None] * _SEEDS).min(axis=0))
    return np.packbits(((mix(best) >> np.uint64(7)) & np.uint64(1)).astype(np.uint8)).view(np.int64)


def sketch_limit(tenths: int = TENTHS) -> int:
    """Bits in which a pair of the wanted similarity may differ."""
    p = (1 - tenths / 10) / 2
    return math.floor(SKETCH_BITS * p + SKETCH_SIGMAS * math.sqrt(SKETCH_BITS * p * (1 - p)))


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tenths: int = TENTHS) -> DataFrame:
    """(id, num, cls, n, s0, s1, posts array<struct(m, native, skip, keys)>) of every record that takes
    part; num is a short name for the id, which must be stored to stay the same."""
    docs = docs.filter(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        entry = pa.struct([("m", pa.int32()), ("native", pa.bool_()), ("skip", pa.int32()), ("keys", pa.list_(pa.int64()))])
        for b in batches:
            ids, cls, ns, sketches, posts = [], [], [], [], []
            for id_, s in zip(b.column("id").to_pylist(), shingler.sets(b.column("text").to_pylist())):
                if s is None:
                    continue
                ids.append(id_)
                cls.append(xxhash.xxh3_128_hexdigest(s.tobytes()))
                ns.append(len(s))
                sketches.append(sketch(s))
                posts.append([{"m": m, "native": native, "skip": t - MERGED, "keys": grams(s, m, groups_posted(m, tenths))} for m, native, t in plan(len(s), tenths)])
            both = np.stack(sketches) if sketches else np.zeros((0, 2), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(cls, pa.string()), pa.array(ns, pa.int32()), *(pa.array(np.ascontiguousarray(both[:, k])) for k in range(2)), pa.array(posts, pa.list_(entry))],
                ["id", "cls", "n", "s0", "s1", "posts"],
            )

    shape = "id string, cls string, n int, s0 bigint, s1 bigint, posts array<struct<m: int, native: boolean, skip: int, keys: array<bigint>>>"
    return docs.mapInArrow(run, shape).withColumn("num", F.monotonically_increasing_id())


def classes(indexed: DataFrame) -> DataFrame:
    """(cls, rep): each class of equal sets and its least id."""
    return indexed.groupBy("cls").agg(F.min("id").alias("rep"))


def live_posts(reps: DataFrame) -> DataFrame:
    """(key, num, m, native, skip, length) of the lists that hold several records, one of them under its
    own m. The posts are shuffled once; counting and joining read the same exchange."""
    posts = reps.select("num", F.explode("posts").alias("p")).select("num", "p.m", "p.native", "p.skip", F.explode("p.keys").alias("key"))
    posts = posts.select("key", "num", F.struct("m", "native", "skip").alias("p")).repartition("key")
    lengths = posts.groupBy("key").agg(F.count("*").alias("length"), F.max(F.col("p.native")).alias("any_native"), F.max("num").alias("top"), F.max("p").alias("top_p"))
    lengths = lengths.filter("length > 1 and any_native and top is not null and top_p is not null").select("key", "length")
    return posts.join(lengths, "key").select("key", "num", "p.m", "p.native", "p.skip", "length")


def candidates(reps: DataFrame, tenths: int = TENTHS) -> DataFrame:
    """(a, b) of pairs, as nums, that occur together MERGED times in short lists and may reach the overlap."""
    order = Window.partitionBy("num", "m").orderBy(F.desc("length"), "key")
    short = live_posts(reps).repartition("num").withColumn("rank", F.row_number().over(order)).filter("rank > skip").select("key", "num", "native")
    short = short.join(reps.select("num", "n", "s0", "s1"), "num").repartition("key")
    a, b = (short.select("key", *(F.col(c).alias(f"{x}_{c}") for c in ("num", "native", "n", "s0", "s1"))) for x in "ab")
    differ = F.bit_count(F.col("a_s0").bitwiseXOR(F.col("b_s0"))) + F.bit_count(F.col("a_s1").bitwiseXOR(F.col("b_s1")))
    # A record posted under its own m meets each other once; two guests of a space don't meet in it.
    met = a.join(b, "key").filter("a_native and (a_num < b_num or not b_native) and a_num != b_num")
    met = met.filter((F.col("a_n") * 10 >= F.col("b_n") * tenths) & (F.col("b_n") * 10 >= F.col("a_n") * tenths) & (differ <= sketch_limit(tenths)))
    pairs = met.groupBy(F.least("a_num", "b_num").alias("a"), F.greatest("a_num", "b_num").alias("b")).agg(F.count("*").alias("times"))
    return pairs.filter(F.col("times") >= MERGED).select("a", "b")


def verify(pairs: DataFrame, texts: DataFrame, tenths: int = TENTHS) -> DataFrame:
    """(a, b, similarity) of the pairs whose records, of `texts` (id, text), reach the required overlap."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for b in batches:
            sets = shingler.sets(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([None if s is None else s.tobytes() for s in sets], pa.binary())], ["id", "shingles"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            sims = []
            for x, y in zip(t.column("xs").to_pylist(), t.column("ys").to_pylist()):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                o = overlap(x, y)
                sims.append(o / (len(x) + len(y) - o) if o >= required(len(x), len(y), tenths) else None)
            sim = pa.array(sims, pa.float64())
            yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b"), sim], ["a", "b", "similarity"]).filter(sim.is_valid())

    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    sets = texts.join(ends, "id", "left_semi").select("id", "text").mapInArrow(hashed, "id string, shingles binary")
    sets = stored(sets.filter("shingles is not null"), "shingle-sets").dropDuplicates(["id"])
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("xs")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("ys")), "b")
    return both.select("a", "b", "xs", "ys").mapInArrow(probe, "a string, b string, similarity double")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tenths: int = TENTHS) -> tuple[DataFrame, DataFrame]:
    """Links (a, b, similarity) between class representatives, and membership (id, rep)."""
    indexed = stored(index(docs, id_col, text_col, tenths), "gram-index")
    members = stored(indexed.select("id", "cls").join(classes(indexed), "cls").select("id", "rep").distinct(), "classes")
    # Most classes have one member, so those that leave are the fewer; an id's repeated rows count once.
    rows = indexed.groupBy("id").agg(F.count("*").alias("rows"), F.min("num").alias("first")).filter("rows > 1").select("id", "first")
    reps = indexed.join(members.filter("id != rep").select("id"), "id", "left_anti").join(rows, "id", "left").filter("first is null or first = num").drop("first")
    names = indexed.select("num", "id")
    found = candidates(reps, tenths)
    found = found.join(names.select(F.col("num").alias("a"), F.col("id").alias("x")), "a").join(names.select(F.col("num").alias("b"), F.col("id").alias("y")), "b")
    found = stored(found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), "candidates")
    texts = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return verify(found, texts, tenths), members


def expand(links: DataFrame, members: DataFrame) -> DataFrame:
    """Every pair of records (doc_id_a < doc_id_b) with its similarity: links between members of
    linked classes, and the pairs within a class. The result grows with the square of a class, which
    `class_table` doesn't."""
    a = members.select(F.col("rep").alias("a"), F.col("id").alias("x"))
    b = members.select(F.col("rep").alias("b"), F.col("id").alias("y"))
    across = links.join(a, "a").join(b, "b").select("x", "y", "similarity")
    within = a.join(b.withColumnRenamed("b", "a"), "a").filter("x < y").select("x", "y", F.lit(1.0).alias("similarity"))
    return across.unionByName(within).select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"), "similarity")


def class_table(links: DataFrame, members: DataFrame) -> DataFrame:
    """(doc_id, class_id, links): one row per record, its class and the links of the class to others."""
    ends = links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count("*").alias("links"))
    return members.join(ends, "rep", "left").select(F.col("id").alias("doc_id"), F.col("rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))
