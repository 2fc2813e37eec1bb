"""Canonical URLs and registrable domains."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import parse_qsl, urlencode, urlparse, urlsplit, urlunparse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names that registries use below a country's two letters ("co.uk", "com.my"); with them a suffix has two labels.
SECOND_LEVEL = tuple("ac ad co com ed edu gen geek go gob gouv gov govt id ltd me mil ne net nom or org plc re sch school web".split())


@dataclass(frozen=True)
class Suffixes:
    """Public suffixes: exact ones, parents of which every child is one, and exceptions to that. Without any, ``SECOND_LEVEL`` is the rule."""

    exact: tuple[str, ...] = ()
    parents: tuple[str, ...] = ()
    exceptions: tuple[str, ...] = ()

    def size(self, labels: list[str]) -> int:
        """How many of the last labels of a host are its public suffix."""
        if not (self.exact or self.parents or self.exceptions):
            return 2 if len(labels) > 1 and len(labels[-1]) == 2 and labels[-2] in SECOND_LEVEL else 1
        best = 1
        for k in range(1, min(len(labels), MOST_LABELS) + 1):
            tail, parent = ".".join(labels[-k:]), ".".join(labels[-k + 1 :]) if k > 1 else ""
            if tail in self.exceptions:
                return k - 1
            if tail in self.exact or parent in self.parents:
                best = k
        return best


#: Labels of the longest public suffix looked for.
MOST_LABELS = 5
SUFFIXES = Suffixes()


def read_suffixes(lines: Iterable[str]) -> Suffixes:
    """The rules of a public suffix list: one a line, ``*.`` before a parent, ``!`` before an exception, comments after //."""
    rules = [r.split()[0].lower().lstrip(".") for line in lines if (r := line.strip()) and not r.startswith("//")]
    rules = [r.encode("idna").decode() if not r.isascii() and "*" not in r and "!" not in r else r for r in rules]
    return Suffixes(tuple(r for r in rules if r[0] not in "*!"), tuple(r[2:] for r in rules if r.startswith("*.")), tuple(r[1:] for r in rules if r.startswith("!")))


# Absolute, of plain characters, each query pair with an equals sign: parsing and encoding leave such parts as they are.
_PLAIN = r"^(?i:https?)://[A-Za-z0-9.-]+(?::\d+)?(?:/[!-~&&[^?#;\[\]]]*)?(?:\?[A-Za-z0-9_.~-]+=[A-Za-z0-9_.~-]*(?:&[A-Za-z0-9_.~-]+=[A-Za-z0-9_.~-]*)*)?(?:#[!-~]*)?$"


def canonical(url: str | None, drop_prefixes: tuple[str, ...]) -> str | None:
    """Without fragment and tracking parameters, host in lower case; None where there is nothing to parse."""
    given = (url or "").strip()
    if not given:
        return None
    try:
        parts = urlparse(given)
        if not parts.scheme:
            parts = urlparse(f"https://{given}")
        query = parts.query
        if query:
            kept = [(k, v) for k, v in parse_qsl(query, keep_blank_values=True) if not k.lower().startswith(drop_prefixes)]
            query = urlencode(kept, doseq=True)
        return urlunparse((parts.scheme, parts.netloc.lower(), parts.path, parts.params, query, ""))
    except ValueError:
        return None


def canonical_url(c: Column, drop_prefixes: tuple[str, ...]) -> Column:
    """Native for plain absolute URLs; odd ones go in batches through the standard library's parser, as Java's disagrees on them."""
    prefixes = tuple(drop_prefixes)
    given = F.trim(c)
    plain = given.rlike(_PLAIN)
    bare = F.regexp_replace(given, "#.*$", "")
    head, query = F.regexp_extract(bare, r"^([^?]*)", 1), F.regexp_extract(bare, r"\?(.*)$", 1)
    scheme_host = F.lower(F.regexp_extract(head, "^[A-Za-z]+://[^/]*", 0))

    def kept(pair: Column) -> Column:
        out = F.lit(True)
        for p in prefixes:
            out = out & ~F.lower(pair).startswith(p)
        return out & (pair != "")

    pairs = F.array_join(F.filter(F.split(query, "&"), kept), "&")
    native = F.concat(scheme_host, F.substr(head, F.length(scheme_host) + 1), F.when(pairs != "", F.concat(F.lit("?"), pairs)).otherwise(F.lit("")))

    @F.pandas_udf("string")
    def run(urls: pd.Series) -> pd.Series:
        return urls.map(lambda u: canonical(u, prefixes) if isinstance(u, str) else None)

    return F.when(plain, native).otherwise(run(F.when(~plain, c)))


def _host(url: str) -> str:
    try:
        return (urlsplit(url).hostname or "").rstrip(".")
    except ValueError:
        return ""


def domain(url: str | None, suffixes: Suffixes = SUFFIXES) -> str:
    """The public suffix and one label more; the host itself for addresses and single names."""
    host = _host(url or "").lower()
    labels = host.split(".")
    if ":" in host or len(labels) < 2 or labels[-1].isdigit():
        return host
    return ".".join(labels[-(suffixes.size(labels) + 1) :])


def url_domain(c: Column, suffixes: Suffixes = SUFFIXES) -> Column:
    """The registrable domain, in native expressions for the host that the URL names."""
    authority = F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", ""), r"\.$", ""))
    labels = F.split(host, r"\.")
    n = F.size(labels)

    def last(k: int) -> Column:
        return F.when(n >= k, F.array_join(F.slice(labels, -k, k), "."))

    if suffixes.exact or suffixes.parents or suffixes.exceptions:
        size = F.lit(1)
        for k in range(1, MOST_LABELS + 1):
            size = F.when(F.coalesce(last(k).isin(*suffixes.exact) | (last(k - 1).isin(*suffixes.parents) & (n >= k) if k > 1 else F.lit(False)), F.lit(False)), F.lit(k)).otherwise(size)
        for k in range(2, MOST_LABELS + 1):
            size = F.when(F.coalesce(last(k).isin(*suffixes.exceptions), F.lit(False)), F.lit(k - 1)).otherwise(size)
    else:
        size = F.when(F.coalesce(last(2).rlike(rf"^(?:{'|'.join(SECOND_LEVEL)})\.[a-z]{{2}}$"), F.lit(False)), F.lit(2)).otherwise(F.lit(1))
    plain = host.contains(":") | (n < 2) | host.rlike(r"\.\d+$")
    wide = F.least(size + 1, n)
    found = F.when(plain, host).otherwise(F.array_join(F.slice(labels, -wide, wide), "."))
    return F.when(c.isNull(), F.lit("")).otherwise(found)


def url_path(c: Column) -> Column:
    """The path in lower case, of URLs with a scheme."""
    return F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?([^?#;]*)", 1))
