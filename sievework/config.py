"""Run configuration: frozen sections, checked on the driver and folded into plans as literals."""

from __future__ import annotations

import dataclasses
import typing
import warnings
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any, Literal

import yaml

# The defaults that give the same results.
DROP_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", ".mp4", ".mov", ".avi", ".zip", ".tar", ".gz", ".7z", ".pdf")
DROP_QUERY_PREFIXES = ("utm_", "fbclid", "gclid", "ref", "session")
BLACKLIST_PHRASES = ("enable javascript", "cookie policy", "accept cookies", "privacy policy", "terms of service", "all rights reserved", "sign up", "subscribe", "404 not found", "page not found")


class ConfigError(ValueError):
    """A configuration that cannot be used; the message names the file and the key."""


@dataclass(frozen=True)
class UrlFilter:
    enabled: bool = True
    drop_extensions: tuple[str, ...] = DROP_EXTENSIONS
    drop_query_prefixes: tuple[str, ...] = DROP_QUERY_PREFIXES
    deny_domains: tuple[str, ...] = ()
    allow_domains: tuple[str, ...] = ()


@dataclass(frozen=True)
class Fetch:
    enabled: bool = True
    timeout_s: float = 20.0
    connect_timeout_s: float = 10.0
    max_retries: int = 3
    max_concurrency: int = 50
    user_agent: str = "sievework corpus builder"
    accept_content_types: tuple[str, ...] = ("text/html", "text/plain")
    render_fallback: bool = False


@dataclass(frozen=True)
class Extract:
    enabled: bool = True
    primary: Literal["trafilatura", "readability"] = "trafilatura"
    fallback: Literal["none", "readability", "trafilatura"] = "readability"
    include_tables: bool = False
    include_comments: bool = False
    min_extracted_chars: int = 200


@dataclass(frozen=True)
class Language:
    enabled: bool = True
    detector: Literal["fast_langdetect", "fasttext", "pycld3", "profile", "column"] = "fast_langdetect"
    target_langs: tuple[str, ...] = ("en",)
    min_confidence: float = 0.80
    min_chars: int = 200
    allow_mixed: bool = False


@dataclass(frozen=True)
class Gopher:
    enabled: bool = True
    min_words: int = 80
    max_words: int = 20000
    max_symbol_ratio: float = 0.20
    max_digit_ratio: float = 0.25
    max_upper_ratio: float = 0.35
    repetition_threshold: float = 0.35


@dataclass(frozen=True)
class Dedup:
    enabled: bool = True
    exact_dedup: bool = True
    minhash: bool = True
    shingle_size: int = 5
    num_perm: int = 128
    jaccard_threshold: float = 0.85
    keep_policy: Literal["highest_quality", "longest"] = "highest_quality"


@dataclass(frozen=True)
class C4:
    enabled: bool = True
    min_sentences: int = 3
    min_stopword_fraction: float = 0.02
    blacklist_phrases: tuple[str, ...] = BLACKLIST_PHRASES


@dataclass(frozen=True)
class Pii:
    enabled: bool = True
    mode: Literal["redact", "drop"] = "redact"
    redact_email: bool = True
    redact_phone: bool = True
    redact_ip: bool = True
    drop_if_pii_matches_gte: int = 3


@dataclass(frozen=True)
class Output:
    format: Literal["parquet", "jsonl"] = "parquet"
    shard_size: int = 50000
    write_stats: bool = True


@dataclass(frozen=True)
class Settings:
    url_filter: UrlFilter = field(default_factory=UrlFilter)
    fetch: Fetch = field(default_factory=Fetch)
    extract: Extract = field(default_factory=Extract)
    language: Language = field(default_factory=Language)
    gopher: Gopher = field(default_factory=Gopher)
    dedup: Dedup = field(default_factory=Dedup)
    c4: C4 = field(default_factory=C4)
    pii: Pii = field(default_factory=Pii)
    output: Output = field(default_factory=Output)


#: Accepted for compatibility; no operator reads them.
UNUSED = (("fetch", "enabled"), ("fetch", "render_fallback"), ("language", "allow_mixed"))


def _checked(kind: Any, value: Any, at: str) -> Any:
    origin = typing.get_origin(kind)
    if dataclasses.is_dataclass(kind):
        return _section(kind, value, at)
    if origin is Literal:
        if value not in typing.get_args(kind):
            raise ConfigError(f"{at}: {value!r} is not one of {', '.join(map(str, typing.get_args(kind)))}")
        return value
    if origin is tuple:
        if not isinstance(value, (list, tuple)) or not all(isinstance(x, str) for x in value):
            raise ConfigError(f"{at}: a list of strings is wanted")
        return tuple(value)
    if kind is float and isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    if not isinstance(value, kind) or kind is int and isinstance(value, bool):
        raise ConfigError(f"{at}: {kind.__name__} is wanted, not {value!r}")
    return value


def _section(kind: Any, raw: Any, at: str = "") -> Any:
    if raw is None:
        raw = {}
    if not isinstance(raw, dict):
        raise ConfigError(f"{at or 'configuration'}: a mapping is wanted")
    hints = typing.get_type_hints(kind)
    if unknown := sorted(str(k) for k in raw if k not in hints):
        raise ConfigError(f"{at or 'configuration'}: unknown key {', '.join(unknown)}")
    return kind(**{k: _checked(hints[k], v, f"{at}.{k}" if at else k) for k, v in raw.items()})


def settings_from(raw: dict | None) -> Settings:
    out = _section(Settings, raw)
    for section, key in UNUSED:
        if isinstance(raw, dict) and key in (raw.get(section) or {}):
            warnings.warn(f"{section}.{key} has no effect", stacklevel=2)
    return out


class _Unique(yaml.SafeLoader):
    """Safe loading that refuses a key given twice, which plain YAML silently lets the last win."""


def _mapping(loader: yaml.SafeLoader, node: yaml.MappingNode, deep: bool = False) -> dict:
    seen = set()
    for k, _ in node.value:
        name = loader.construct_object(k, deep=deep)
        if name in seen:
            raise ConfigError(f"line {k.start_mark.line + 1}: key {name!r} is given twice")
        seen.add(name)
    return yaml.SafeLoader.construct_mapping(loader, node, deep)


_Unique.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, _mapping)


def load_settings(path: str | Path) -> Settings:
    """Settings from a YAML file; an empty file gives the defaults."""
    file = Path(path).expanduser().resolve()
    if not file.exists():
        raise FileNotFoundError(f"no configuration file {file}")
    try:
        return settings_from(yaml.load(file.read_text(encoding="utf-8"), _Unique))
    except (ConfigError, yaml.YAMLError) as e:
        raise ConfigError(f"{file}: {e}") from e
