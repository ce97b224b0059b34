"""Column functions on text whose results agree with Python's string rules.

Java's and RE2's ideas of white space differ from Python's, so the class is spelled out.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python's str.split() knows it, without brackets.
SPACE = r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
DEVANAGARI = r"\x{0900}-\x{097f}"


@F.pandas_udf(T.StringType())
def _nfc(text: pd.Series) -> pd.Series:
    normal, is_normal = unicodedata.normalize, unicodedata.is_normalized
    return text.map(lambda t: t if t is None or is_normal("NFC", t) else normal("NFC", t))


def nfc(text: Column) -> Column:
    """Unicode form C; Spark has no built-in for it. ASCII never reaches Python's normaliser."""
    return _nfc(text)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+\z", "")


def squeeze(text: Column) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(text, rf"[{SPACE}]+", " ")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(rf"[^{SPACE}]+")).cast("bigint")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"[^{SPACE}]+"), F.lit(0))


def length(text: Column) -> Column:
    return F.length(text).cast("bigint")


def is_blank(text: Column) -> Column:
    return text.isNull() | ~text.rlike(rf"[^{SPACE}]")


def has_script(text: Column, chars: str = DEVANAGARI) -> Column:
    return text.rlike(f"[{chars}]")


def script_count(text: Column, chars: str = DEVANAGARI) -> Column:
    return F.length(F.regexp_replace(text, f"[^{chars}]", "")).cast("bigint")


def script_ratio(text: Column, chars: str = DEVANAGARI) -> Column:
    """Share of the script's characters among all code points; 0 for an empty text."""
    n = F.length(text)
    return F.when(n > 0, script_count(text, chars) / n).otherwise(F.lit(0.0))


def letter_script_ratio(text: Column, chars: str = DEVANAGARI) -> Column:
    """The second definition: among letters, marks and underscores only; above 1 for texts with
    many signs, since the numerator counts danda and digits too."""
    n = F.length(F.regexp_replace(text, r"[^\p{L}\p{N}_]|\p{Nd}", ""))
    return F.when(n > 0, script_count(text, chars) / n).otherwise(F.lit(0.0))


def digest(text: Column, kind: str = "sha256") -> Column:
    """Hex digest of the UTF-8 bytes."""
    if kind not in ("sha256", "md5"):
        raise ValueError(f"unknown digest {kind}")
    return F.sha2(text, 256) if kind == "sha256" else F.md5(text)


def ordered_replace(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text
