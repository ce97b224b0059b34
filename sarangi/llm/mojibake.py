"""Text decoded with the wrong character encoding, found and restored by round trips.

For each candidate legacy encoding a pattern finds the stretches whose characters, put back
into that encoding's bytes, are whole multi-byte UTF-8 sequences. Each is re-encoded and
strictly decoded as UTF-8, and the reading is kept only where the garbling cost of the text
drops; this repeats until no layer is left. Stretches are found anywhere, so text garbled
in part is restored in place.

A text is garbled if a reading lowered its cost, or if what is left shows that bytes were
lost: replacement characters beside garbled sequences, or lead characters of a sequence
without their followers. Then `restored` is null, for it can't be known.
Null, empty and plain ASCII texts are not garbled.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Candidate encodings, likelier ones first.
ENCODINGS = ("cp1252", "latin-1", "cp1250", "cp1254", "cp1251", "cp437", "cp850", "cp866", "mac_roman", "iso8859_2", "iso8859_15", "koi8_r")
MAX_LAYERS = 5
#: Encodings of a script that true texts use. There a reading counts only if it takes
#: up most of the script's letters, or ordinary words would be read as garbled.
SCRIPT_ENCODINGS, SCRIPT_SHARE = {"cp1251": "[Ѐ-ӿ]", "cp866": "[Ѐ-ӿ]", "koi8_r": "[Ѐ-ӿ]"}, 0.6


@functools.cache
def byte_map(encoding: str) -> dict[str, int]:
    """Characters of the upper half to bytes. Bytes that the encoding leaves undefined stand for
    the control character of the same number, as browsers decode them."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            c = bytes([b]).decode(encoding)
        except UnicodeDecodeError:
            c = chr(b)
        out.setdefault(c, b)
    return out


def _set(chars: list[str]) -> str:
    return "[" + "".join(map(re.escape, sorted(chars))) + "]"


@functools.cache
def patterns(encoding: str) -> tuple[re.Pattern, re.Pattern, dict[int, int]]:
    """Whole sequences; what a sequence that lost a byte looks like; translation to Latin-1."""
    m = byte_map(encoding)
    pick = lambda lo, hi: [c for c, b in m.items() if lo <= b <= hi]
    two, three, four, cont = _set(pick(0xC2, 0xDF)), _set(pick(0xE0, 0xEF)), _set(pick(0xF0, 0xF4)), _set(pick(0x80, 0xBF))
    whole = re.compile(f"(?:{two}{cont}|{three}{cont}{{2}}|{four}{cont}{{3}})+")
    broken = re.compile(f"{three}{cont}?(?=[?�]|{three}|\\Z)|{three}{cont}(?!{cont})|{four}{cont}{{1,2}}(?!{cont})")
    return whole, broken, {ord(c): b for c, b in m.items()}


_HIGH = re.compile("[\x80-￿]")
_SUSPECT = re.compile(
    "[\x80-\x9f�]|[\xa0-\xbfÀ-ɏ][\x80-\xbfŒœŠšŽžŸƒˆ˜–—‘’‚“”„†‡•…‰‹›€™]|[À-ɏ]{2}|[Ѐ-ӿ]{2}|[─-╿▀-▟]|[α-ωΓΘΣΦΩ∞∩≡±≥≤⌠⌡÷≈√ⁿ∂∏π∫]"
)


def cost(text: str) -> int:
    """Garbling cost: characters outside ASCII, and again each suspect pair or control character."""
    return len(_HIGH.findall(text)) + 3 * len(_SUSPECT.findall(text))


def _plausible(text: str) -> bool:
    return all(unicodedata.category(c)[0] != "C" or c in "​‌‍﻿\xad" or "\x80" <= c <= "\x9f" for c in text)


def _one_layer(text: str, encoding: str) -> tuple[str, int, int]:
    """The text with every stretch that reads as UTF-8 replaced; how many characters went; how many sequences look cut."""
    whole, broken, to_latin = patterns(encoding)
    n = 0

    def back(m: re.Match) -> str:
        nonlocal n
        try:
            new = m[0].translate(to_latin).encode("latin-1").decode("utf-8")
        except (UnicodeDecodeError, UnicodeEncodeError):
            return m[0]
        if not _plausible(new):
            return m[0]
        n += len(m[0])
        return new

    out = whole.sub(back, text)
    if n and encoding in SCRIPT_ENCODINGS and n < SCRIPT_SHARE * len(re.findall(SCRIPT_ENCODINGS[encoding], text)):
        return text, 0, 0
    return out, n, len(broken.findall(out)) if n else 0


#: Double-byte encodings whose bytes were read as a single-byte one: the ranges of
#: their first and second bytes, and what a true reading of a stretch must hold.
DOUBLE_BYTE = {
    "gbk": ("\x81-\xfe", "\x40-\x7e\x80-\xfe", lambda s: sum("一" <= c <= "鿿" or c in "，。？！：“”、…" for c in s) >= 0.9 * len(s) and _encodable(s, "gb2312") >= 0.7 * len(s)),
    "cp932": ("\x81-\x9f\xe0-\xfc", "\x40-\x7e\x80-\xfc", lambda s: any("ぁ" <= c <= "ヿ" for c in s) and sum("ぁ" <= c <= "ヿ" or "一" <= c <= "鿿" or c in "、。「」？！％" for c in s) >= 0.9 * len(s)),
}
MIN_RUN = 4
MOSTLY = 0.6


def _encodable(text: str, encoding: str) -> int:
    return len(text.encode(encoding, "ignore").decode(encoding))


@functools.cache
def _double_byte(encoding: str, carrier: str) -> re.Pattern:
    first, second, _ = DOUBLE_BYTE[encoding]
    back = {b: c for c, b in byte_map(carrier).items()}

    def chars(ranges: str) -> str:
        bytes_ = re.findall(f"[{ranges}]", "".join(map(chr, range(256))))
        return _set([back.get(ord(x), x) for x in bytes_])

    return re.compile(f"(?:{chars(first)}{chars(second)})+")


def _double_layer(text: str, encoding: str, carrier: str) -> tuple[str, int]:
    """Stretches read as a double-byte encoding, where at least one is long enough to tell."""
    to_latin, plausible = patterns(carrier)[2], DOUBLE_BYTE[encoding][2]
    sure = 0

    def back(m: re.Match) -> str:
        nonlocal sure
        try:
            new = m[0].translate(to_latin).encode("latin-1").decode(encoding)
        except (UnicodeDecodeError, UnicodeEncodeError):
            return m[0]
        sure += len(new) >= MIN_RUN and plausible(new)
        return new if len(new) < MIN_RUN or plausible(new) else m[0]

    out = _double_byte(encoding, carrier).sub(back, text)
    return out, sure


def repair(text: str | None) -> tuple[bool, str | None]:
    """(is garbled, restored text or None where characters were lost or nothing is garbled)."""
    if not text or text.isascii():
        return False, None
    now, changed = text, False
    for _ in range(MAX_LAYERS):
        best, was = None, cost(now)
        for e in ENCODINGS:
            new, n, cut = _one_layer(now, e)
            if n and (c := cost(new)) < was and (best is None or (c, cut) < best[:2]):
                best = (c, cut, new)
                read = n / sum(ord(c) in patterns(e)[2] for c in now)
        # Where UTF-8 explains most of what the encoding could have made, nothing else is tried.
        for e in DOUBLE_BYTE if best is None or read < MOSTLY else ():
            for carrier in ("latin-1", "cp1252"):
                new, sure = _double_layer(now, e, carrier)
                if sure and (c := cost(new)) < was and (best is None or (c, 0) < best[:2]):
                    best = (c, 0, new)
        if best is None:
            break
        changed, now = True, best[2]
        if best[1]:
            return True, None
    if not changed:
        return "�" in text or any(len(broken_at(text, e)) > 2 for e in ENCODINGS[:3]), None
    return True, None if "�" in now else now


def broken_at(text: str, encoding: str) -> list[str]:
    """Sequences that lost a byte, in a text without whole ones."""
    _, broken, _ = patterns(encoding)
    return [m[0] for m in broken.finditer(text) if len(m[0]) > 1 and unicodedata.category(m[0][1])[0] != "L"]


def may_be_garbled(text: Column) -> Column:
    """A cheap test in the JVM: only texts with a character that legacy encodings give a lead byte."""
    leads = sorted({c for e in ENCODINGS for c, b in byte_map(e).items() if 0xC2 <= b <= 0xF4 or e == "cp1252" and b >= 0x81})
    conts = sorted({c for e in ENCODINGS for c, b in byte_map(e).items() if 0x80 <= b <= 0xBF} | {"?"} | set(leads))
    inside = lambda cs: "[" + "".join(f"\\x{{{ord(c):x}}}" for c in cs) + "]"
    return text.rlike(inside(leads) + inside(conts) + "|\\x{fffd}")


def repair_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, restored string): one row per garbled row of `docs`; null where it can't be restored."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(may_be_garbled(F.col("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [repair(t) for t in b.column("text").to_pylist()]
            keep = pa.array([g for g, _ in found], pa.bool_())
            out = pa.RecordBatch.from_arrays([b.column("id"), pa.array([x for _, x in found], pa.string())], ["id", "restored"])
            yield out.filter(keep)

    kind = dict(docs.dtypes)["id"]
    return docs.mapInArrow(run, f"id {kind}, restored string").withColumnRenamed("id", id_col)


def md5_of(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()
