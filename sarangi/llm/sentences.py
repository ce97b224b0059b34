"""Sentence boundaries in many scripts, with abbreviations learned from the corpus.

Periods are ambiguous, so the corpus itself tells, without labels, which words are
abbreviations: counts over all documents, added up per script group, give by log-likelihood
ratios (a) words that have a period far oftener than chance, weighted against length,
(b) that, unlike words ending sentences, hardly ever stand last in a paragraph, (c) the
words that start sentences and (d) pairs around a period that belong together. Each period
is then classified by these statistics; other marks are read by rule. Only the short lists
of abbreviations, starters and pairs leave the cluster, and their size is checked.

Offsets are code points, ends exclusive, white space around a sentence left out. Blank lines
always end a sentence; what stands within quotation marks or brackets doesn't. Null, empty
and blank texts have no sentences; a text without marks is one; garbled texts are left out;
repeated rows give their rows again.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarangi.llm.mojibake import may_be_garbled, repair

#: Thresholds of the log-likelihood ratios and the most entries that the lists may have.
ABBREVIATION_SCORE, FINAL_LLR, STARTER_LLR, PAIR_LLR, MAX_LIST = 5.0, 3.84, 30.0, 7.88, 200_000
FLUSH = 100_000

# Marks.
OPENERS = {"“": "”", "‘": "’", "「": "」", "『": "』", "(": ")", "（": "）", "«": "»"}
QUOTES, CORNERS = "“‘\"«「『", "「『"
CLOSERS = "”’\"」』)）»]"
STRONG, SOFT, DOTS = "।॥。！？", "?!|", ".…"
_MARK = re.compile(r"[“‘「『(（«”’」』)）»\"]|[।॥|.?!…。！？]+|(?<=[฀-๿0-9?!])[ \t 　]+(?=[฀-๿“])")
_BLANK = re.compile(r"\r?\n[^\S\n]*(?:\r?\n\s*)")
_TOKEN = re.compile(r"[^\s“”‘’\"「」『』()（）«»।॥|?!…，。！？、,:：;]+")
_QUOTE = re.compile("[“‘\"«「『]")
_INDIC = re.compile("[ऀ-෿]")
_GROUPS = (("deva", re.compile("[ऀ-ॿ]")), ("beng", re.compile("[ঀ-৿]")), ("latn", re.compile("[A-Za-zÀ-ɏ]")))


def group_of(token: str) -> str:
    return next((g for g, p in _GROUPS if p.search(token)), "other")


def base_length(token: str) -> int:
    """Letters without marks and periods."""
    return sum(unicodedata.category(c)[0] in "LN" for c in token)


def type_of(token: str) -> str:
    t = token.lower()
    return "#" if t[:1].isdigit() and not any(c.isalpha() for c in t) else t


def has_form_of_abbreviation(t: str) -> bool:
    """Initials and words with inner periods need no counts."""
    parts = t.split(".")
    if len(parts) == 1:
        return base_length(t) == 1 and group_of(t) == "latn"
    return all(0 < base_length(p) <= 3 for p in parts) and not any(c.isdigit() for c in t)


@dataclass(frozen=True)
class Knowledge:
    """(group, type) of abbreviations and of those that may end a sentence; starters; pairs."""

    abbreviations: frozenset = field(default_factory=frozenset)
    final: frozenset = field(default_factory=frozenset)
    starters: frozenset = field(default_factory=frozenset)
    pairs: frozenset = field(default_factory=frozenset)


def blocks(text: str) -> Iterator[tuple[int, int]]:
    """Stretches between blank lines."""
    at = 0
    for m in _BLANK.finditer(text):
        yield at, m.start()
        at = m.end()
    yield at, len(text)


def count_text(text: str, counts: Counter) -> None:
    """Add a text's evidence: (kind, group, type) with kinds plain, dot, final, start, word, pair."""
    for a, b in blocks(text):
        block = text[a:b].rstrip().rstrip(CLOSERS)
        quoted = sorted((i, j) for i, j in _matching(block).items() if block[i] in QUOTES) if _QUOTE.search(block) else []
        started, pending = True, None
        for m in _TOKEN.finditer(block):
            while quoted and quoted[0][1] < m.start():
                quoted.pop(0)
            if quoted and quoted[0][0] < m.start():  # what is quoted ends by other rules
                started, pending = False, None
                continue
            token = m[0]
            dotted = token.endswith(".") and not token.endswith("..")
            t = type_of(token.strip("."))
            if not t:
                continue
            g = group_of(t)
            counts["word", g, t] += 1
            if pending:
                counts["pair", pending[0], f"{pending[1]}\t{t}"] += 1
            if started:
                counts["start", g, t] += 1
            pending = None
            if dotted:
                if m.end() == len(block):
                    counts["final", g, t] += 1
                else:
                    counts["dot", g, t] += 1
                    if t == "#" or has_form_of_abbreviation(t):
                        pending = (g, t)
            else:
                counts["plain", g, t] += 1
            follow = block[m.end() : m.end() + 1]
            started = follow != "" and follow in "।॥?!。"


def evidence(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(kind, grp, type, n), pre-aggregated in each task and then added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(counts)
            batch = pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in keys], pa.string()) for i in range(3)] + [pa.array([counts[k] for k in keys], pa.int64())],
                ["kind", "grp", "type", "n"],
            )
            counts.clear()
            return batch

        for b in batches:
            for text, suspect in zip(b.column("text").to_pylist(), b.column("suspect").to_pylist()):
                if suspect and repair(text)[0]:
                    continue
                count_text(text, counts)
            if len(counts) > FLUSH:
                yield out()
        yield out()

    docs = docs.filter(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), may_be_garbled(F.col(text_col)).alias("suspect"))
    return docs.mapInArrow(run, "kind string, grp string, type string, n bigint").groupBy("kind", "grp", "type").agg(F.sum("n").alias("n"))


def _llr(k1, n1, k2, n2):
    """Dunning's log-likelihood ratio of two binomials, as Column expressions."""
    p, p1, p2 = F.try_divide(k1 + k2, n1 + n2), F.try_divide(k1, n1), F.try_divide(k2, n2)
    part = lambda k, n, q: F.when(k > 0, k * F.log(q)).otherwise(0.0) + F.when(n - k > 0, (n - k) * F.log(1 - q)).otherwise(0.0)
    return 2 * (part(k1, n1, p1) + part(k2, n2, p2) - part(k1, n1, p) - part(k2, n2, p))


def learn(docs: DataFrame, text_col: str = "text") -> Knowledge:
    from sarangi.session import stored

    ev = stored(evidence(docs, text_col), "sentence-evidence")
    kind = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).cast("double")
    types = ev.filter("kind != 'pair'").groupBy("grp", "type").agg(*(kind(k).alias(k) for k in ("plain", "dot", "final", "start", "word")))
    types = types.withColumn("size", F.length(F.regexp_replace("type", r"[^\p{L}\p{N}]", ""))).withColumn("inner", F.col("type").contains("."))
    totals = types.groupBy("grp").agg(
        F.sum("word").alias("words"), F.sum(F.col("dot") + F.col("final")).alias("dots"), F.sum("start").alias("starts"),
        F.sum(F.when(~F.col("inner") & (F.col("size") > 3), F.col("final"))).alias("f_final"),
        F.sum(F.when(~F.col("inner") & (F.col("size") > 3), F.col("final") + F.col("dot"))).alias("f_all"),
    )
    t = types.join(totals, "grp").filter("words > 0")
    own, other = F.col("dot") + F.col("final"), F.col("dots") - F.col("dot") - F.col("final")
    share = F.try_divide(own, own + F.col("plain"))
    score = _llr(own, F.col("word"), other, F.greatest(F.col("words") - F.col("word"), F.lit(1.0))) * F.exp(-0.5 * F.col("size")) * F.pow(share, F.lit(4.0))
    base = F.least(F.greatest(F.coalesce(F.try_divide(F.col("f_final"), F.col("f_all")), F.lit(0.2)), F.lit(0.02)), F.lit(0.9))
    rate = F.try_divide(F.col("final"), own)
    surprise = F.when(rate < base, 2 * (F.when(F.col("final") > 0, F.col("final") * F.log(rate / base)).otherwise(0.0) + F.when(F.col("dot") > 0, F.col("dot") * F.log((1 - rate) / (1 - base))).otherwise(0.0))).otherwise(0.0)
    short = (F.col("size") <= 2) & (F.col("final") == 0) & (share >= 0.8)
    dotted = t.filter((own >= 2) & (share >= 0.5) & (F.col("type") != "#"))
    abbreviations = dotted.filter(~F.col("inner") & ((score >= ABBREVIATION_SCORE) & (surprise >= FINAL_LLR) & (rate < 0.25 * base) | short)).select("grp", "type")
    final = t.filter((F.col("final") >= 2) & (rate >= 0.02) & F.col("inner")).select("grp", "type")
    free = F.greatest(F.col("words") - F.col("starts"), F.lit(1.0))
    starters = t.filter((F.col("start") > 1) & (F.try_divide(F.col("start"), F.col("word")) > F.try_divide(F.col("starts"), F.col("words"))))
    starters = starters.filter(_llr(F.col("start"), F.col("starts"), F.least(F.col("word") - F.col("start"), free), free) >= STARTER_LLR).select("grp", "type")
    pair = ev.filter("kind = 'pair'").select("grp", F.split("type", "\t").alias("p"), "n").select("grp", F.col("p")[0].alias("first"), F.col("p")[1].alias("second"), F.col("n").cast("double").alias("both"))
    word = types.select("grp", "type", "word")
    pair = pair.join(word.select("grp", F.col("type").alias("first"), F.col("word").alias("a")), ["grp", "first"]).join(word.groupBy(F.col("type").alias("second")).agg(F.sum("word").alias("b")), "second").join(totals.select("grp", "words"), "grp")
    rest = F.greatest(F.col("words") - F.col("a"), F.lit(1.0))
    pair = pair.filter((F.col("both") > 1) & (F.try_divide(F.col("both"), F.col("a")) > F.try_divide(F.col("b"), F.col("words"))))
    pair = pair.filter(_llr(F.least(F.col("both"), F.col("a")), F.col("a"), F.least(F.greatest(F.col("b") - F.col("both"), F.lit(0.0)), rest), rest) >= PAIR_LLR).select("grp", F.concat_ws("\t", "first", "second").alias("type"))
    lists = [abbreviations.withColumn("list", F.lit(0)), final.withColumn("list", F.lit(1)), starters.withColumn("list", F.lit(2)), pair.withColumn("list", F.lit(3))]
    union = lists[0].unionByName(lists[1]).unionByName(lists[2]).unionByName(lists[3])
    rows = union.limit(MAX_LIST + 1).collect()
    if len(rows) > MAX_LIST:
        raise ValueError(f"more than {MAX_LIST} learned entries; raise the thresholds")
    return Knowledge(*(frozenset((r["grp"], r["type"]) for r in rows if r["list"] == k) for k in range(4)))


def _matching(text: str) -> dict[int, int]:
    """Openers to their closers; those without one don't count."""
    out, stack, straight = {}, [], None
    for i, c in enumerate(text):
        if c in OPENERS:
            stack.append((c, i))
        elif c == '"':
            if straight is None:
                straight = i
            else:
                out[straight], straight = i, None
        elif c in CLOSERS:
            for k in range(len(stack) - 1, -1, -1):
                if OPENERS[stack[k][0]] == c:
                    out[stack[k][1]] = i
                    del stack[k:]
                    break
    return out


def _period_ends(text: str, start: int, i: int, e: int, know: Knowledge) -> bool:
    """Whether the period at i, followed by white space at e, ends the sentence begun at `start`."""
    tokens = _TOKEN.findall(text[max(start, i - 60) : i])
    if not tokens or text[i - 1].isspace():
        return True
    t = type_of(tokens[-1].strip("."))
    g = group_of(t)
    after = _TOKEN.search(text, e)
    nxt = after[0] if after else ""
    key, follower = (g, t), type_of(nxt.strip("."))
    capital = nxt[:1].isupper()
    if t == "#":
        return not (len(text[start:i].strip()) == len(tokens[-1]) or (g, f"#\t{follower}") in know.pairs and not capital and group_of(nxt) == "latn")
    if key in know.abbreviations or has_form_of_abbreviation(t):
        if base_length(t) == 1 or key not in know.final:
            return False
        return capital and (g, f"{t}\t{follower}") not in know.pairs or capital and (group_of(nxt), follower) in know.starters
    return True


def spans(text: str, know: Knowledge) -> list[tuple[int, int]]:
    """(start, end) of each sentence."""
    out = []
    for a, b in blocks(text):
        for s, e in _block_spans(text[a:b], know):
            out.append((a + s, a + e))
    return out


def _block_spans(text: str, know: Knowledge) -> list[tuple[int, int]]:
    pairs = _matching(text)
    closing = set(pairs.values())
    out: list[tuple[int, int]] = []
    start, i, n = 0, 0, len(text)

    def cut(end: int) -> None:
        nonlocal start
        piece = text[start:end]
        left = len(piece) - len(piece.lstrip())
        size = len(piece.strip())
        if size:
            out.append((start + left, start + left + size))
        start = end

    while m := _MARK.search(text, i):
        j, e = m.start(), m.end()
        c = text[j]
        if c.isspace():
            if "฀" <= next((x for x in reversed(text[start:j]) if x.isalpha()), "") <= "๿":
                cut(j)
            i = e
            continue
        if j in pairs:
            k = pairs[j]
            i = k + 1
            before, inner = text[start:j].strip(), text[j + 1 : k].rstrip()
            if c in QUOTES and c not in CORNERS and before and before[-1] in ",，:：–-" and inner and inner[-1] in STRONG + SOFT + DOTS:
                while i < n and text[i] in CLOSERS and i not in pairs:
                    i += 1
                if text[i : i + 1] not in STRONG + SOFT + DOTS + ",，" or i == n:
                    cut(i)
            continue
        if c in CLOSERS or c in OPENERS or c == '"':
            i = e
            continue
        run = m[0]
        while e < n and text[e] in CLOSERS and e not in closing and e not in pairs:
            e += 1
        i = e
        rest = text[e:].lstrip()
        spaced = e < n and text[e].isspace()
        if not rest:
            cut(e)
        elif any(x in STRONG for x in run):
            cut(e)
        elif all(x in DOTS for x in run) and (len(run) > 1 or run == "…"):
            if spaced and rest[0].isupper():
                cut(e)
        elif "?" in run or "!" in run:
            if spaced or not (rest[0].isascii() and (rest[0].isalnum() or rest[0] in "&=/#%")):
                cut(e)
        elif "|" in run:
            before = text[start:j].rstrip()
            if before and (_INDIC.match(before[-1]) or before[-1] in CLOSERS) and (spaced or not rest[0].isascii()):
                cut(e)
        elif spaced and _period_ends(text, start, j, e, know):
            cut(e)
    cut(n)
    return out


def sentence_table(docs: DataFrame, know: Knowledge, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, start_char, end_char) of every document that isn't garbled."""
    docs = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), may_be_garbled(F.col(text_col)).alias("suspect"))
    kind = dict(docs.dtypes)["id"]
    shared = docs.sparkSession.sparkContext.broadcast(know)  # MAX_LIST entries at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        know = shared.value
        for b in batches:
            ids, starts, ends = [], [], []
            for id_, text, suspect in zip(*(b.column(c).to_pylist() for c in ("id", "text", "suspect"))):
                if suspect and repair(text)[0]:
                    continue
                for s, e in spans(text, know):
                    ids.append(id_)
                    starts.append(s)
                    ends.append(e)
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.column("id").type), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["id", "start_char", "end_char"])

    return docs.mapInArrow(run, f"id {kind}, start_char bigint, end_char bigint").withColumnRenamed("id", id_col)
