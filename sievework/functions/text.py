"""Column expressions over text, with Unicode classes that agree with Python's predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, as str.isspace and the regular expression \\s see it.
SPACE = r"\p{IsWhite_Space}\x1c-\x1f"
#: A word is a maximal run of these.
WORD = r"[\p{L}\p{N}_]+"
# Digits that are not decimal (superscripts, circled and dotted digits, ...).
_OTHER_DIGITS = (
    r"\xB2\xB3\xB9፩-፱᧚⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿"
    r"❶-❾➀-➈➊-➒\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)
DIGIT = r"\p{Nd}" + _OTHER_DIGITS
LETTER, UPPER = r"\p{L}", r"\p{IsUppercase}"
PLAIN = rf"\p{{L}}\p{{N}}{SPACE}"  # neither symbol nor punctuation
LINE_BREAK = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\x{2028}\x{2029}]"
SENTENCE_BREAK = rf"[.!?][{SPACE}]+"

# The 45 English stopwords.
STOPWORDS = "a an and are as at be been being but by else for from he her his i if in is it not of on or our she that the their them then these they this those to us was we were with you your".split()


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def collapse(c: Column) -> Column:
    """White-space runs as one space, none at the ends."""
    return F.btrim(F.regexp_replace(c, rf"[{SPACE}]+", " "))


def normalised(c: Column) -> Column:
    """What exact dedup compares: lower case, white space collapsed."""
    return collapse(F.lower(strip(c)))


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def lower_words(c: Column) -> Column:
    """Words, each in lower case: lowering first would split those whose lower case has a combining mark (U+0130)."""
    return F.transform(words(c), F.lower)


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD))


def count_chars(c: Column, members: str) -> Column:
    """How many characters of ``c`` are in the class."""
    return F.length(F.regexp_replace(c, f"[^{members}]+", ""))


def lines(c: Column) -> Column:
    """Lines, stripped and lower-cased, without blank ones."""
    parts = F.split(c, LINE_BREAK)
    return F.filter(F.transform(parts, lambda s: F.lower(strip(s))), lambda s: s != "")


def repeated_fraction(c: Column) -> Column:
    def fraction(found: Column) -> Column:
        n = F.size(found)
        return F.when(n >= 5, 1.0 - F.size(F.array_distinct(found)) / n).otherwise(F.lit(0.0))

    return bound(lines(c), fraction)


def sentence_count(c: Column) -> Column:
    return F.size(F.filter(F.split(strip(c), SENTENCE_BREAK), lambda s: strip(s) != ""))


def stopword_fraction(c: Column) -> Column:
    """Share of words that are stopwords; null without words."""

    def fraction(found: Column) -> Column:
        hits = F.size(F.filter(found, lambda w: w.isin(STOPWORDS)))
        return F.when(F.size(found) > 0, hits / F.size(found))

    return bound(lower_words(c), fraction)


def bound(value: Column, body) -> Column:
    """body(value) with ``value`` computed once a row: as a lambda's variable it is not inlined again and again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingles(c: Column, k: int) -> Column:
    """Distinct k-word shingles of the lower-cased text; its words, where it has fewer than k."""

    def grams(found: Column) -> Column:
        n = F.size(found)
        runs = F.transform(F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1))), lambda i: F.array_join(F.slice(found, i, k), " "))
        return F.array_distinct(F.when(n < k, found).otherwise(runs))

    return bound(lower_words(c), grams)
