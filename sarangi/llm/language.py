"""Languages of documents and of their paragraphs by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed vocabulary, and the score of a
word is the sum over all its segmentations, by a forward algorithm. The vocabulary is that
of a public tokenizer; as the public ones hold little more than single characters of most
Asian scripts, frequent whole words, starts and endings of the training sample are pieces
too. Pieces don't cross words, so a word is scored once and remembered.

The model is fitted on a bounded sample of labelled rows (`sample_docs`), whose labels are
only a start: paragraphs are assigned again to the likeliest language of their script, and
the pieces are estimated by expectation maximisation, in `rounds` turns. Everything else
runs over all documents, in one narrow pass.

A paragraph's language is that of most of its words: sentence by sentence, the words of the
likeliest language are added up. Paragraphs without words take the document's language;
documents without words (null and blank texts too) give no rows. Ties go to the first of
CLASSES. Repeated ids give their rows again.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarangi.llm.mojibake import may_be_garbled, repair

SAMPLE_DOCS, ROUNDS = 6_000, 3
DEFAULT_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Classes with the script group in which they compete; a class may be a second script of a language.
CLASSES = {"ne": "deva", "hi": "deva", "mai": "deva", "en": "latn", "ne-Latn": "latn", "bn": "beng", "zh": "hani", "ja": "hani", "th": "thai"}
NAMES = list(CLASSES)
GROUPS = {g: [i for i, c in enumerate(NAMES) if CLASSES[c] == g] for g in dict.fromkeys(CLASSES.values())}

# Usual codes and names of the languages.
ALIASES = {
    "ne": "ne nep npi nepali nepalese नेपाली",
    "hi": "hi hin hindi हिन्दी हिंदी",
    "mai": "mai maithili मैथिली",
    "en": "en eng english",
    "bn": "bn ben bengali bangla বাংলা",
    "zh": "zh zho chi cmn chinese mandarin 中文 汉语 简体中文",
    "ja": "ja jpn japanese 日本語",
    "th": "th tha thai ไทย ภาษาไทย",
}
_BY_ALIAS = {a: lang for lang, names in ALIASES.items() for a in names.split()}

_SCRIPTS = {
    "deva": "ऀ-ॣॱ-ॿ‌‍", "latn": "A-Za-zÀ-ɏ", "beng": "ঀ-ৣ", "hani": "぀-ヿ㐀-䶿一-鿿々ー", "thai": "฀-๎",
}
_WORDS = re.compile("|".join(f"(?P<{g}>[{c}]+)" for g, c in _SCRIPTS.items()))
#: Characters that count as one word, in scripts without spaces.
CHARS_PER_WORD = {"hani": 2.0, "thai": 4.0}
_SENTENCE = re.compile(r"(?<=[।॥|?!。！？])\s*|(?<=\.)\s+")
PARAGRAPHS = re.compile(r"\r?\n[^\S\n]*(?:\r?\n\s*)")
FLOOR = 1e-7
LONGEST_PIECE, LONGEST_WORD = 16, 24


def label_language(label: str | None) -> str | None:
    """The language that a label names, or None."""
    s = unicodedata.normalize("NFC", label or "").strip().lower()
    return _BY_ALIAS.get(s) or _BY_ALIAS.get(re.split(r"[-_\s(]", s)[0])


def paragraphs(text: str | None) -> list[str]:
    return [p for p in (x.strip() for x in PARAGRAPHS.split(text or "")) if p]


def words(text: str) -> Iterator[tuple[str, str]]:
    """(script group, word) in order; runs of scripts without spaces are cut to bounded length."""
    for m in _WORDS.finditer(text):
        w, g = m[0].lower(), m.lastgroup
        for k in range(0, len(w), LONGEST_WORD):
            yield g, w[k : k + LONGEST_WORD]


def weight(group: str, word: str) -> float:
    return max(1.0, len(word) / CHARS_PER_WORD[group]) if group in CHARS_PER_WORD else 1.0


@functools.cache
def public_pieces(path: str) -> frozenset[str]:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return frozenset(sp.id_to_piece(i).lower() for i in range(sp.get_piece_size()) if not sp.is_byte(i) and not sp.is_control(i))


@dataclass
class Model:
    """Piece probabilities as one row per piece, a column per class."""

    pieces: dict[str, np.ndarray]
    base: list[float] = field(default_factory=lambda: [0.0] * len(NAMES))  # log share of each class in its script
    known: dict[str, tuple] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"pieces": self.pieces, "base": self.base, "known": {}}

    def forward(self, marked: str) -> list[np.ndarray]:
        """Sums over all segmentations of each prefix."""
        get, alpha = self.pieces.get, [np.ones(len(NAMES))]
        for i in range(1, len(marked) + 1):
            a = alpha[i - 1] * FLOOR
            for j in range(max(0, i - LONGEST_PIECE), i):
                p = get(marked[j:i])
                if p is not None:
                    a = a + alpha[j] * p
            alpha.append(a)
        return alpha

    def word(self, group: str, word: str) -> tuple[float, ...]:
        """Log probability of a word in each class of its script group."""
        s = self.known.get(word)
        if s is None:
            if len(self.known) > 200_000:
                self.known.clear()
            s = self.known[word] = tuple(np.log(self.forward("▁" + word)[-1][GROUPS[group]] + 1e-290).tolist())
        return s

    def bags(self, text: str) -> list[tuple[str, float, list[float]]]:
        """(script group, words, log probability per class of the group) of each sentence and group."""
        out = []
        for sentence in _SENTENCE.split(text):
            here: dict[str, list] = {}
            for g, w in words(sentence):
                bag = here.get(g)
                if bag is None:
                    bag = here[g] = [0.0, [0.0] * len(GROUPS[g])]
                bag[0] += weight(g, w)
                if len(bag[1]) > 1:
                    bag[1] = [a + b for a, b in zip(bag[1], self.word(g, w))]
            out += [(g, n, scores) for g, (n, scores) in here.items()]
        return out

    def document(self, parts: list[str]) -> tuple[list[list[float]], list[float]]:
        """Words per class of each paragraph, and their sum. The sentences are read twice: first
        alone, then with the document's own mix as a mild prior."""
        bags = [self.bags(p) for p in parts]
        prior: list[float] | None = None
        for _ in range(2):
            each = [[0.0] * len(NAMES) for _ in parts]
            for row, sentences in zip(each, bags):
                for g, n, scores in sentences:
                    own = GROUPS[g]
                    if len(own) > 1:
                        total = [x + (prior[k] if prior else self.base[k]) for k, x in zip(own, scores)]
                        row[own[total.index(max(total))]] += n
                    else:
                        row[own[0]] += n
            sums = [sum(col) for col in zip(*each)] if each else [0.0] * len(NAMES)
            size = sum(sums) or 1.0
            prior = [math.log(0.02 * math.exp(b) + 0.98 * x / size + 1e-9) for x, b in zip(sums, self.base)]
        return each, sums


def language_of(per_class: list[float]) -> tuple[str | None, float]:
    """Language with most words, classes of one language together, and its share."""
    total: dict[str, float] = defaultdict(float)
    for name, n in zip(NAMES, per_class):
        total[name.split("-")[0]] += n
    best = max(total, key=total.get)
    return (best, total[best] / sum(total.values())) if total[best] else (None, 0.0)


def fit(rows: Iterable[tuple[str | None, str]], vocabulary: str = DEFAULT_VOCABULARY, rounds: int = ROUNDS) -> Model:
    """Fit on (label, text) rows, already bounded by the caller."""
    # A unit is what one document has in one script: the words of each paragraph.
    units: list[tuple[str, list[Counter], int]] = []
    for label, text in rows:
        lang = label_language(label)
        by_group: dict[str, list[Counter]] = defaultdict(list)
        for p in paragraphs(text):
            here: dict[str, Counter] = defaultdict(Counter)
            for g, w in words(p):
                here[g][w] += 1
            for g, c in here.items():
                by_group[g].append(c)
        for g, bags in by_group.items():
            own = [i for i in GROUPS[g] if NAMES[i].split("-")[0] == lang]
            if g == "hani":
                own = [NAMES.index("ja" if any("぀" <= ch <= "ヿ" for c in bags for w in c for ch in w) else "zh")]
            units.append((g, bags, own[0] if own else GROUPS[g][0] if len(GROUPS[g]) == 1 else -1))
    types: dict[str, str] = {w: g for g, bags, _ in units for c in bags for w in c}
    total: Counter = Counter()
    for _, bags, _ in units:
        for c in bags:
            total.update(c)
    vocab = _inventory(total, public_pieces(vocabulary))
    spans = {w: [(j, i) for i in range(1, len(w) + 2) for j in range(max(0, i - LONGEST_PIECE), i) if ("▁" + w)[j:i] in vocab] for w in types}
    model = Model({})
    for turn in range(rounds):
        counts: dict[str, np.ndarray] = {w: np.zeros(len(NAMES)) for w in types}
        mass = np.zeros(len(NAMES))
        for g, bags, start in units:
            for c, k in zip(bags, [start] * len(bags) if turn == 0 else _assign(model, g, bags, start)):
                if k >= 0:
                    mass[k] += c.total()
                    for w, n in c.items():
                        counts[w][k] += n
        model = _estimate(model if turn else None, counts, spans)
        for own in GROUPS.values():
            for k in own:
                model.base[k] = float(np.log((mass[k] + 1) / (mass[own].sum() + len(own))))
    return model


def _assign(model: Model, group: str, bags: list[Counter], label: int) -> list[int]:
    """Class of each paragraph of a document: the likeliest, given what the whole document is
    likeliest to be and, weakly, its label."""
    own = GROUPS[group]
    if len(own) == 1 or group == "hani":  # kana have already told
        return [label] * len(bags)
    each = []
    for c in bags:
        score = [0.0] * len(own)
        for w, n in c.items():
            score = [a + n * b for a, b in zip(score, model.word(group, w))]
        each.append(score)
    bias = [model.base[k] + (1.0 if k == label else 0.0) for k in own]
    whole = [sum(col) + b for col, b in zip(zip(*each), bias)]
    best = whole.index(max(whole))
    return [own[max(range(len(own)), key=lambda i: s[i] + bias[i] + (3.0 if i == best else 0.0))] for s in each]


def _inventory(types: Counter, public: frozenset[str]) -> set[str]:
    """Public pieces that occur, whole words seen thrice, starts and endings seen often, characters."""
    out, parts = set(), Counter()
    for w, n in types.items():
        m = "▁" + w
        out.update(m)
        if n >= 3 and len(m) <= LONGEST_PIECE:
            out.add(m)
        for k in range(1, min(5, len(w))):
            parts[w[-k:]] += n
            parts[m[: k + 1]] += n
        for i in range(1, len(m) + 1):
            for j in range(max(0, i - LONGEST_PIECE), i):
                if m[j:i] in public:
                    out.add(m[j:i])
    return out | {p for p, n in parts.items() if n >= 20}


def _estimate(model: Model | None, counts: dict[str, np.ndarray], spans: dict[str, list]) -> Model:
    """One step of expectation maximisation from the model, or from even piece weights."""
    expected: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(NAMES)))
    for w, n in counts.items():
        if not n.any():
            continue
        m = "▁" + w
        # Characters keep a small count of their own, on which words never seen fall back.
        for c in m:
            expected[c] += 0.02 * n
        if model is None or not model.pieces:
            # Longer pieces first count more, as if each character halved the probability.
            for j, i in spans[w]:
                expected[m[j:i]] += n * 0.5 ** (len(m) - (i - j))
            continue
        alpha = model.forward(m)
        beta = [np.zeros(len(NAMES)) for _ in range(len(m))] + [np.ones(len(NAMES))]
        for i in range(len(m), 0, -1):
            beta[i - 1] = beta[i - 1] + beta[i] * FLOOR
            for j in range(max(0, i - LONGEST_PIECE), i):
                p = model.pieces.get(m[j:i])
                if p is not None:
                    beta[j] = beta[j] + beta[i] * p
        z = alpha[-1] + 1e-290
        for j, i in spans[w]:
            p = model.pieces.get(m[j:i])
            if p is not None:
                expected[m[j:i]] += n * alpha[j] * p * beta[i] / z
    total = sum(expected.values()) + 1.0
    return Model({k: (v + 0.01) / (total + 0.01 * len(expected)) for k, v in expected.items() if v.sum() > 1e-3})


def sample_rows(docs: DataFrame, limit: int, id_col: str = "doc_id") -> list[tuple[str | None, str]]:
    """At most `limit` labelled rows, those least by a hash of the id, wherever they stand."""
    labelled = docs.filter("text is not null and lang is not null and trim(lang) != ''").select(id_col, "lang", "text")
    n = max(1, labelled.select(id_col).count())
    share = min(1.0, 1.2 * limit / n)
    place = F.pmod(F.xxhash64(id_col), F.lit(1_000_000))
    rows = labelled.filter(place < int(share * 1_000_000) + 1).orderBy(place, id_col, "lang", "text").limit(limit)
    return [(r["lang"], r["text"]) for r in rows.collect()]


def paragraph_languages(docs: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """(id, para_no, lang, language_confidence, doc_lang, mixed, right): every paragraph of every
    document that isn't garbled."""
    spark = docs.sparkSession
    docs = docs.filter("text is not null").select(F.col(id_col).alias("id"), "text", "lang", may_be_garbled(F.col("text")).alias("suspect"))
    kind = dict(docs.dtypes)["id"]
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for id_, text, label, suspect in zip(*(b.column(c).to_pylist() for c in ("id", "text", "lang", "suspect"))):
                if suspect and repair(text)[0]:
                    continue
                parts = paragraphs(text)
                each, total = model.document(parts)
                doc_lang, _ = language_of(total)
                if doc_lang is None:
                    continue
                langs = [language_of(e) for e in each]
                names = [x or doc_lang for x, _ in langs]
                mixed = len(set(names)) > 1
                for no, (name, (_, conf)) in enumerate(zip(names, langs)):
                    for c, v in zip(cols, (id_, no, name, conf, doc_lang, mixed, label_language(label) == doc_lang)):
                        c.append(v)
            types = (b.column("id").type, pa.int64(), pa.string(), pa.float64(), pa.string(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["id", "para_no", "lang", "language_confidence", "doc_lang", "mixed", "right"])

    shape = f"id {kind}, para_no bigint, lang string, language_confidence double, doc_lang string, mixed boolean, right boolean"
    return docs.mapInArrow(run, shape).withColumnRenamed("id", id_col)


def fitted(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS, vocabulary: str = DEFAULT_VOCABULARY) -> Model:
    return fit(sample_rows(docs, sample_docs), vocabulary, rounds)
