"""Patterns of personal data, as Java regular expressions with Unicode word edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_IN = r"[\p{L}\p{N}_]"
#: A word edge: Java's own takes another set of word characters.
EDGE = rf"(?:(?<={_IN})(?!{_IN})|(?<!{_IN})(?={_IN}))"
_D = r"\p{Nd}"
_GAP = r"[\p{IsWhite_Space}\x1c-\x1f-]?"

# Labels, patterns and replacement tokens, in the order they are applied.
KINDS = (
    ("email", rf"(?iu){EDGE}[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{{2,}}{EDGE}", "[EMAIL]"),
    ("phone", rf"{EDGE}(?:\+?{_D}{{1,3}}{_GAP})?(?:\(?{_D}{{2,4}}\)?{_GAP})?{_D}{{3,4}}{_GAP}{_D}{{3,4}}{EDGE}", "[PHONE]"),
    ("ip", rf"{EDGE}(?:{_D}{{1,3}}\.){{3}}{_D}{{1,3}}{EDGE}", "[IP]"),
)


#: What every match holds: texts without it are not searched with the pattern itself.
_NEEDED = {KINDS[0][1]: "@", KINDS[1][1]: rf"{_D}{{3}}", KINDS[2][1]: rf"{_D}\.{_D}"}


def possible(c: Column, pattern: str) -> Column:
    needed = _NEEDED.get(pattern)
    return F.lit(True) if needed is None else F.contains(c, F.lit(needed)) if needed == "@" else c.rlike(needed)


def count(c: Column, pattern: str) -> Column:
    return F.when(possible(c, pattern), F.regexp_count(c, F.lit(pattern))).when(c.isNotNull(), F.lit(0))


def replace(c: Column, pattern: str, token: str) -> Column:
    return F.when(possible(c, pattern), F.regexp_replace(c, pattern, token)).otherwise(c)
