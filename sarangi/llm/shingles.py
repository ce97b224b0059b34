"""Sets of two- and three-word sequences, as sorted 64-bit hashes, a batch of texts at a time."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np

from sarangi.llm.chars import fold

MIN_WORDS = 5
CHARS_AT_ONCE = 2_000_000
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_S = np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    """Bits of each number stirred, so that any of them can be used alone."""
    x = (x ^ (x >> _S)) * _A
    x = (x ^ (x >> _S)) * _B
    return x ^ (x >> _S)


class Shingler:
    """Shingles of texts by whole-batch array operations; keeps what characters become."""

    DROP, SPACE, UNKNOWN = 0, 1, 2**32 - 1

    def __init__(self, sizes: tuple[int, ...] = (2, 3), min_words: int = MIN_WORDS):
        self.sizes, self.min_words = sizes, min_words
        self.table = np.full(0x110000, self.UNKNOWN, dtype=np.uint32)

    def _learn(self, codes: np.ndarray) -> None:
        for c in np.unique(codes).tolist():
            out = fold(c)
            self.table[c] = self.DROP if out is None else self.SPACE if out == " " else ord(out) if isinstance(out, str) else out

    def word_hashes(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and where each text's begin and end."""
        prepared = []
        for t in texts:
            t = t or ""
            if not unicodedata.is_normalized("NFC", t):
                t = unicodedata.normalize("NFC", t)
            prepared.append(t.lower())
        sizes = np.array([len(t) + 1 for t in prepared])
        codes = np.frombuffer("\n".join([*prepared, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        doc = np.repeat(np.arange(len(texts)), sizes)
        folded = self.table[codes]
        if (new := folded == self.UNKNOWN).any():
            self._learn(codes[new])
            folded = self.table[codes]
        kept = folded != self.DROP
        folded, doc = folded[kept], doc[kept]
        inside = folded != self.SPACE
        begins = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
        if not len(begins):
            return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
        at = np.arange(len(folded))
        start = np.zeros(len(folded), dtype=np.int64)
        start[begins] = begins
        place = at - np.maximum.accumulate(start)
        value = np.where(inside, mix(folded.astype(np.uint64) * _C + place.astype(np.uint64)), np.uint64(0))
        return mix(np.add.reduceat(value, begins)), np.searchsorted(doc[begins], np.arange(len(texts) + 1))

    def sets(self, texts: Sequence[str | None]) -> list[np.ndarray | None]:
        """Sorted distinct shingles of each text, or None for a text of too few words."""
        out: list[np.ndarray | None] = []
        for part in self._parts(texts):
            h, ends = self.word_hashes(part)
            grams, acc = {}, h
            for n in range(2, max(self.sizes) + 1):
                acc = mix(acc[:-1] * _C + h[n - 1 :])
                grams[n] = acc
            for a, b in zip(ends[:-1], ends[1:]):
                if b - a < self.min_words:
                    out.append(None)
                    continue
                s = np.concatenate([grams[n][a : b - n + 1] for n in self.sizes])
                s.sort()
                out.append(s[np.r_[True, s[1:] != s[:-1]]])
        return out

    @staticmethod
    def _parts(texts: Sequence[str | None]) -> Iterator[list[str | None]]:
        part, size = [], 0
        for t in texts:
            part.append(t)
            size += len(t or "")
            if size > CHARS_AT_ONCE:
                yield part
                part, size = [], 0
        if part:
            yield part

    def __call__(self, text: str | None) -> np.ndarray | None:
        return self.sets([text])[0]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of sorted sets, by binary probes of the longer."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def required(n: int, m: int, tenths: int) -> int:
    """The overlap that sets of sizes n and m need for a similarity of tenths / 10."""
    return -(-tenths * (n + m) // (10 + tenths))
