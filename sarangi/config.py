"""Settings of the stages as frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class CleanConfig:
    unicode_normalize: bool = True
    remove_html: bool = True
    remove_urls: bool = True
    remove_emails: bool = True
    remove_control_chars: bool = True
    control_char_replacement: str = ""  # '' deletes line breaks too and joins the words around them
    clean_whitespace: bool = True
    normalize_punctuation: bool = True
    min_text_length: int = 10
    require_script: bool = True


@dataclass(frozen=True)
class LanguageConfig:
    min_script_ratio: float = 0.3
    min_confidence: float = 0.5
    lexicon_weight: float = 0.3


@dataclass(frozen=True)
class SegmentConfig:
    min_sentence_words: int = 5
    max_sentence_words: int = 100
    min_paragraph_length: int = 50


@dataclass(frozen=True)
class ExactDedupConfig:
    mode: str = "strict"  # strict, chunked
    chunk_rows: int = 100_000
    null_as_text: bool = False
    digest: str = "sha256"  # sha256, md5
    store_digests: tuple[str, ...] = ("sha256", "md5")  # kinds of digest that a store of hashes may hold


@dataclass(frozen=True)
class NearDedupConfig:
    permutations: int = 128
    bands: int = 16
    threshold: float = 0.85

    @property
    def rows(self) -> int:
        return self.permutations // self.bands


@dataclass(frozen=True)
class WikiConfig:
    allowed_namespaces: tuple[int, ...] = (0,)
    skip_redirects: bool = True
    skip_disambiguation: bool = True
    min_article_length: int = 100
    max_article_length: int = 0
    require_script: bool = True
    min_script_ratio: float = 0.0
    min_paragraph_length: int = 20
    max_paragraph_length: int = 10_000
    normalize_punctuation: bool = False
    max_articles: int = 0
    fields: tuple[str, ...] = field(default=("title", "page_id", "timestamp"))


def load_config(path: str) -> dict[str, Any]:
    """A YAML mapping; anything else is an error."""
    import yaml

    if not Path(path).is_file():
        raise FileNotFoundError(path)
    data = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(data, dict):
        raise ValueError(f"{path} doesn't hold a mapping")
    return data


def from_mapping(kind: type, values: dict[str, Any]):
    """A config from a mapping; unknown keys are an error, not ignored."""
    known = {f.name for f in fields(kind)}
    if unknown := set(values) - known:
        raise ValueError(f"unknown keys for {kind.__name__}: {sorted(unknown)}")
    return kind(**values)
