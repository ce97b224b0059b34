"""Encoding of texts with a public byte-level BPE, long texts in overlapping chunks.

Short texts are encoded as they are. A text above `chunk_chars` is cut into overlapping
chunks, which are pre-tokenised apart, in any task. Two neighbouring chunks are stitched at
a pre-token boundary that both have inside their overlap: from a common boundary on, the
pre-tokeniser, which reads from left to right without memory, gives the same pieces. The
pieces between two stitches are then encoded, again apart, and put together in order.
Where an overlap has no common boundary (one enormous pre-token), the pieces on both sides
are encoded as one. Decoding concatenates raw bytes.

Null and empty texts give an empty list. Strings that look like special tokens are text.
Repeated ids are kept as rows of their own; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the published pre-token pattern of the 50k byte-level vocabulary.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CHUNK_CHARS, OVERLAP_CHARS = 65_536, 1_024


@functools.cache
def encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    return tiktoken.Encoding(path, pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _pretoken() -> regex.Pattern:
    return regex.compile(PRETOKEN)


def boundaries(text: str, last: bool) -> list[int]:
    """Ends of pre-tokens that hold whatever follows the chunk; those of the final chunk all hold."""
    ends = [m.end() for m in _pretoken().finditer(text)]
    if last:
        return ends
    # What follows can change the last pre-token, and the white space before it.
    while ends and (ends[-1] == len(text) or text[ends[-1] - 1].isspace()):
        ends.pop()
    return ends


def safe(text: str, ends: Iterable[int]) -> list[int]:
    """Boundaries after a character that isn't white space: a piece cut there is read alike alone."""
    return [e for e in ends if not text[e - 1].isspace()]


def decode(ids: Iterable[int], path: str = DEFAULT_VOCABULARY) -> bytes:
    one = encoder(path).decode_single_token_bytes
    return b"".join(one(i) for i in ids)


def _encode_batches(batches: Iterator[pa.RecordBatch], path: str, keep: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for b in batches:
        texts = b.column("text").to_pylist()
        lists = [enc.encode_ordinary(t) if t else [] for t in texts]
        offsets, flat = [0], []
        for ids in lists:
            flat.extend(ids)
            offsets.append(len(flat))
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), ids], [*keep, "ids"])


def _chunk_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Safe boundaries of each chunk inside its overlaps, as offsets in the whole text."""
    for b in batches:
        rows = b.to_pylist()
        head, tail = [], []
        for r in rows:
            t, start = r["chunk"], r["start"]
            ends = [e for e in safe(t, boundaries(t, r["last"]))]
            head.append([start + e for e in ends if e <= r["overlap"]])
            tail.append([start + e for e in ends if e >= len(t) - r["overlap"]])
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), b.column("no"), pa.array(head, pa.list_(pa.int64())), pa.array(tail, pa.list_(pa.int64()))],
            ["row", "no", "head", "tail"],
        )


def encode_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY,
    chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """(id_col, ids array<int>) for every row of `docs`."""
    if not 0 < overlap_chars < chunk_chars:
        raise ValueError("overlap_chars must be positive and below chunk_chars")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(docs.dtypes)["id"]
    short = docs.filter(F.col("text").isNull() | (F.length("text") <= chunk_chars))
    done = short.mapInArrow(lambda it: _encode_batches(it, vocabulary, ("id",)), f"id {kind}, ids array<int>")
    long = docs.filter(F.length("text") > chunk_chars)
    return done.unionByName(_encode_long(long, kind, vocabulary, chunk_chars, overlap_chars)).withColumnRenamed("id", id_col)


def _encode_long(long: DataFrame, kind: str, vocabulary: str, size: int, overlap: int) -> DataFrame:
    # The row key tells repeated ids apart; it depends on the text alone, so a repeated task agrees.
    long = long.groupBy("id", "text").agg(F.count("*").alias("times"))
    long = long.withColumn("row", F.struct("id", F.xxhash64("text"), F.md5("text")))
    n = F.length("text")
    cuts = long.select("row", "text", F.posexplode(F.sequence(F.lit(0), ((n - 1) / size).cast("int"))).alias("no", "k"))
    cuts = cuts.withColumn("start", (F.col("k") * size).cast("long"))
    chunks = cuts.select(
        "row", "no", "start", F.substring(F.col("text"), (F.col("k") * size + 1).cast("int"), F.lit(size + overlap)).alias("chunk"),
        (F.length("text") <= F.col("start") + size + overlap).alias("last"), F.lit(overlap).alias("overlap"),
    ).filter(F.length("chunk") > 0)
    row = dict(chunks.dtypes)["row"]
    ends = chunks.mapInArrow(_chunk_ends, f"row {row}, no int, head array<bigint>, tail array<bigint>")
    # One small row per chunk: the first boundary that a chunk's tail and the next chunk's head share.
    nxt = ends.select("row", (F.col("no") - 1).alias("no"), F.col("head").alias("next_head"))
    stitch = ends.join(nxt, ["row", "no"]).select("row", F.array_min(F.array_intersect("tail", "next_head")).alias("at"))
    stitch = stitch.filter("at is not null").groupBy("row").agg(F.sort_array(F.collect_set("at")).alias("cuts"))
    whole = long.join(stitch, "row", "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<bigint>")))
    bounds = F.concat(F.array(F.lit(0).cast("long")), F.col("cuts"), F.array(F.length("text").cast("long")))
    pieces = whole.select("row", "times", "text", F.posexplode(F.transform(F.slice(bounds, 1, F.size("cuts") + 1), lambda x, i: F.struct(x.alias("a"), F.get(bounds, i + 1).alias("b")))).alias("no", "ab"))
    pieces = pieces.filter("ab.b > ab.a").select("row", "times", "no", F.expr("substring(text, int(ab.a) + 1, int(ab.b - ab.a))").alias("text"))
    coded = pieces.repartition(F.col("row"), F.col("no")).mapInArrow(
        lambda it: _encode_batches(it, vocabulary, ("row", "times", "no")), f"row {row}, times bigint, no int, ids array<int>"
    )
    whole = coded.groupBy("row", "times").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("no", "ids"))), lambda x: x["ids"])).alias("ids"))
    return whole.select(F.col("row.id").cast(kind).alias("id"), "ids", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")).drop("copy")
