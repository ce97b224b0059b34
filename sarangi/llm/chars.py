"""Words of texts as they are compared, by the Unicode database."""

from __future__ import annotations

import unicodedata


def fold(code: int) -> str | int | None:
    """What a character becomes when texts are compared: an ASCII digit, itself, nothing or a space."""
    ch = chr(code)
    kind = unicodedata.category(ch)
    if kind == "Nd":
        return str(unicodedata.decimal(ch))
    if kind[0] in "LMN":
        return code
    return None if kind == "Cf" else " "


class _Fold(dict):
    def __missing__(self, code: int) -> str | int | None:
        self[code] = out = fold(code)
        return out


_FOLD = _Fold()


def compare_words(text: str) -> list[str]:
    """Words of a text as they are compared: NFC, lower case, no format characters, ASCII digits,
    split at everything that isn't a letter, mark or number."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.lower().translate(_FOLD).split()
