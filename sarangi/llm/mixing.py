"""Mixing sources to target shares of tokens by pivotal dependent rounding.

A source of T tokens that is to give w of a mix of N tokens needs w N / T copies of each
record: a whole number for all of them and a fraction more. Fractions are rounded two
records at a time: mass moves at random from one to the other, in tokens, so that their sum
stays and one of the two becomes whole. The order of records is by a hash. Each task rounds
its own part and passes on one record per source that is still fractional; those meet in a
reduction tree of FANOUT until one per source is left, which a coin decides. Records larger
than 1 / LARGE of their source's target are decided by coins before, and the fraction of the
others takes up the difference. So a source's tokens miss its target by one ordinary record
at most, and each record's expected copies are exact where caps leave room.

By default the mix is the largest whose shares are all exact, over the sources that have
tokens: N is the least of cap * T / w, with w scaled to sum to 1 over those sources.
With `total_tokens` given, sources that would exceed their cap give what they can, and the
others keep their targets of the rest. Records of other or null sources, and those without
tokens, stay out; a source without records is reported with a share of 0; of repeated rows
of a source in the targets the first by share counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarangi.llm.tokens import DEFAULT_VOCABULARY, encode_texts
from sarangi.session import stored

FANOUT, SEED, MAX_SOURCES, LARGE = 16, 17, 100_000, 400


def token_counts(docs: DataFrame, targets: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(doc_id, source, tokens) of the records of the targets' sources that have tokens."""
    mine = docs.join(targets.filter("source is not null").select("source").distinct(), "source", "left_semi").select("doc_id", "source", "text")
    sizes = encode_texts(mine.select(F.struct("doc_id", "source").alias("doc_id"), "text"), "doc_id", "text", vocabulary)
    return sizes.select("doc_id.doc_id", "doc_id.source", F.size("ids").cast("bigint").alias("tokens")).filter("tokens > 0")


def allocate(totals: dict[str, int], targets: dict[str, tuple[float, int]], total_tokens: float | None = None) -> dict[str, float]:
    """Copies of each record of a source, as a real number."""
    have = {s: t for s, t in totals.items() if t > 0 and targets[s][0] > 0 and targets[s][1] > 0}
    if not have:
        return {}
    whole = sum(targets[s][0] for s in have)
    share = {s: targets[s][0] / whole for s in have}
    if total_tokens is None:
        total_tokens = min(targets[s][1] * t / share[s] for s, t in have.items())
    give, free, left = {}, dict(share), float(total_tokens)
    while free:
        scale = left / sum(free.values())
        over = [s for s in free if free[s] * scale > targets[s][1] * have[s] * (1 + 1e-12)]
        if not over:
            return {s: x / have[s] for s, x in (give | {s: f * scale for s, f in free.items()}).items()}
        for s in over:
            give[s] = targets[s][1] * have[s]
            left -= give[s]
            del free[s]
    return {s: x / have[s] for s, x in give.items()}


def _unit(*keys: object) -> float:
    """A number in [0, 1) from the keys alone, so that a repeated task decides alike."""
    import xxhash

    return xxhash.xxh3_64_intdigest("|".join(map(str, keys)).encode(), SEED) / 2**64


def pivot(rest: tuple | None, new: tuple) -> tuple[list[tuple], tuple | None]:
    """Combine a fractional record with another: (decided, still fractional). Records are
    (id, tokens, fraction); the tokens-weighted sum of fractions is kept, and expectations too."""
    if not 1e-12 < new[2] < 1 - 1e-12:
        return [(new[0], new[1], round(new[2]))], rest
    if rest is None:
        return [], new
    (i, s, p), (j, t, q) = rest, new
    # Mass in tokens that may go from j to i, and from i to j, until one is whole.
    up, down = min((1 - p) * s, q * t), min(p * s, (1 - q) * t)
    if _unit(i, j) < down / (up + down):
        p, q = p + up / s, q - up / t
    else:
        p, q = p - down / s, q + down / t
    decided, open_ = [], None
    for r in ((i, s, p), (j, t, q)):
        if r[2] <= 1e-9 or r[2] >= 1 - 1e-9:
            decided.append((r[0], r[1], round(r[2])))
        else:
            open_ = r
    return decided, open_


def _round_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round one part; what stays fractional, a record per source, keeps its fraction and null copies."""
    open_: dict[str, tuple | None] = {}
    base_of: dict[str, int] = {}
    kind = None

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[]] * 6
        types = (pa.string(), kind, pa.int64(), pa.int32(), pa.float64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["source", "doc_id", "tokens", "base", "fraction", "copies"])

    for b in batches:
        kind = b.column("doc_id").type
        out = []
        for source, id_, tokens, base, fraction in zip(*(b.column(c).to_pylist() for c in ("source", "doc_id", "tokens", "base", "fraction"))):
            base_of[source] = base
            decided, open_[source] = pivot(open_.get(source), (id_, tokens, fraction))
            out += [(source, i, t, base, None, base + extra) for i, t, extra in decided]
        yield batch(out)
    out = []
    for source, r in open_.items():
        if r is None:
            continue
        i, t, p = r
        out.append((source, i, t, base_of[source], p, None))
    if kind is not None:
        yield batch(out)


def _rates(spark, rates: dict[str, float]) -> DataFrame:
    parts = [(s, *(divmod(x, 1.0) if x % 1.0 < 1 - 1e-9 else (round(x), 0.0))) for s, x in rates.items()]
    return spark.createDataFrame([(s, int(b), float(f)) for s, b, f in parts], "source string, base int, fraction double")


def mix(docs: DataFrame, targets: DataFrame, total_tokens: float | None = None, vocabulary: str = DEFAULT_VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """The mix (doc_id, source, tokens, copies), with copies above 0, and the report
    (source, target_share, max_repeats, source_tokens, mix_tokens, actual_share, records, most_copies)."""
    spark = docs.sparkSession
    targets = targets.filter("source is not null").groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("t")).select("source", "t.*")
    counted = stored(token_counts(docs, targets, vocabulary), "mix-tokens")
    sums = targets.join(counted.groupBy("source").agg(F.sum("tokens").alias("tokens")), "source", "left")
    rows = sums.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    want = {r["source"]: (r["target_share"] or 0.0, r["max_repeats"] or 0) for r in rows}
    rates = allocate({r["source"]: r["tokens"] or 0 for r in rows}, want, total_tokens)
    kind = dict(counted.dtypes)["doc_id"]
    shape = f"source string, doc_id {kind}, tokens bigint, base int, fraction double, copies bigint"
    first = _rates(spark, rates)
    size = F.col("tokens") * LARGE > (F.col("base") + F.col("fraction")) * F.col("source_tokens")
    joined = counted.join(first, "source").join(sums.select("source", F.col("tokens").alias("source_tokens")), "source")
    coin = F.pmod(F.xxhash64("source", "doc_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Fewer than LARGE * cap records of a source can be large.
    large = stored(joined.filter(size).select("source", "doc_id", "tokens", (F.col("base") + (coin < F.col("fraction")).cast("int")).cast("bigint").alias("copies")), "mix-large")
    took = {r["source"]: (r["n"], r["t"]) for r in large.groupBy("source").agg(F.sum("tokens").alias("n"), F.sum(F.col("tokens") * F.col("copies")).alias("t")).collect()}
    total = {r["source"]: r["tokens"] or 0 for r in rows}
    rest = {s: min(max((x * total[s] - took.get(s, (0, 0))[1]) / max(total[s] - took.get(s, (0, 0))[0], 1), 0.0), want[s][1]) for s, x in rates.items()}
    level = joined.filter(~size).select("source", "doc_id", "tokens").join(_rates(spark, rest), "source").select("source", "doc_id", "tokens", "base", "fraction")
    done: DataFrame = large
    width = None
    while True:
        rounded = stored(level.mapInArrow(_round_part, shape), "mix-level")
        done = done.unionByName(rounded.filter("copies is not null").select("source", "doc_id", "tokens", "copies"))
        open_ = rounded.filter("copies is null")
        most = open_.groupBy("source").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).collect()[0]["n"] or 0
        if most <= 1:
            done = done.unionByName(open_.select("source", "doc_id", "tokens", (F.col("base") + (coin < F.col("fraction")).cast("int")).cast("bigint").alias("copies")))
            break
        # One fractional record per source and part goes up the tree.
        width = -(-(width or most) // FANOUT)
        level = open_.select("source", "doc_id", "tokens", "base", "fraction").repartition(width, F.xxhash64("doc_id")).sortWithinPartitions("source", "doc_id")
    used = done.filter("copies > 0")
    got = used.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mix_tokens"), F.count("*").alias("records"), F.max("copies").alias("most_copies"))
    # The whole is a sum over the sources, which are few.
    whole = got.agg(F.sum("mix_tokens").alias("whole")).collect()[0]["whole"] or 0
    report = sums.join(got, "source", "left").select(
        "source", "target_share", F.col("max_repeats").cast("bigint").alias("max_repeats"), F.coalesce("tokens", F.lit(0)).alias("source_tokens"), F.coalesce("mix_tokens", F.lit(0)).alias("mix_tokens"),
        (F.coalesce("mix_tokens", F.lit(0)) / F.lit(float(max(whole, 1)))).alias("actual_share"), F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
    )
    return used, report
