"""Native expressions against Python's own predicates, over random Unicode."""

import hashlib
import random
import re
import unicodedata

from pyspark.sql import functions as F

from sievework.functions import pii, text as t
from sievework.operators import quality

ODD = ["İ", "Ⅷ", "①", "²", "é", "é", "ß", " ", "\x85", "\x1c", "\xa0", "　", "_", "٣", "ǅ", "ª", "中", "🙂", "\r\n", "\n", "!", ".", "? "]


def samples():
    rng = random.Random(1)
    out = ["", " ", "\n\n", "a b\tc\n", "One. Two! Three? four", "x\n" * 7, "A a\r\nA A\n b\x0bB\n\n c"]
    for _ in range(400):
        out.append("".join(rng.choice(ODD + list("abcXYZ 019 \n.,-")) for _ in range(rng.randint(0, 40))))
    return [s for s in out if not any(unicodedata.category(c) == "Cn" for c in s)]


def test_expressions_agree_with_python(spark):
    texts = samples()
    c = F.col("s")
    df = spark.createDataFrame(list(enumerate(texts)), "i long, s string").select(
        "i", t.word_count(c).alias("words"), t.count_chars(c, t.DIGIT).alias("digits"), t.count_chars(c, t.LETTER).alias("letters"), t.count_chars(c, t.UPPER).alias("upper"),
        (F.length(c) - t.count_chars(c, t.PLAIN)).alias("symbols"), t.lines(c).alias("lines"), F.sha1(t.normalised(c).cast("binary")).alias("sha"), t.sentence_count(c).alias("sentences"),
        t.collapse(c).alias("collapsed"), t.shingles(c, 3).alias("shingles"), t.repeated_fraction(c).alias("rep"), t.stopword_fraction(c).alias("stop"),
    )
    for r in df.collect():
        s = texts[r["i"]]
        words = re.findall(r"\w+", s)
        assert r["words"] == len(words), repr(s)
        assert r["digits"] == sum(ch.isdigit() for ch in s) and r["letters"] == sum(ch.isalpha() for ch in s), repr(s)
        assert r["upper"] == sum(ch.isupper() for ch in s) and r["symbols"] == sum(not ch.isalnum() and not ch.isspace() for ch in s), repr(s)
        lines = [x.strip().lower() for x in s.splitlines() if x.strip()]
        assert r["lines"] == lines, repr(s)
        assert r["rep"] == (1 - len(set(lines)) / len(lines) if len(lines) >= 5 else 0.0)
        assert r["sha"] == hashlib.sha1(re.sub(r"\s+", " ", s.strip().lower()).encode()).hexdigest(), repr(s)
        assert r["sentences"] == len([x for x in re.split(r"[.!?]\s+", s.strip()) if x.strip()]), repr(s)
        assert r["collapsed"] == " ".join(s.split()), repr(s)
        low = [w.lower() for w in words]
        want = {" ".join(low[i : i + 3]) for i in range(len(low) - 2)} if len(low) >= 3 else set(low)
        assert set(r["shingles"]) == want, repr(s)
        assert r["stop"] == (sum(w in t.STOPWORDS for w in low) / len(low) if low else None)


def test_stopword_list():
    assert len(t.STOPWORDS) == len(set(t.STOPWORDS)) == 45


def test_metrics_of_nothing(spark):
    row = spark.createDataFrame([(None,), ("",)], "text string").select(quality.metrics(F.col("text")).alias("m")).select("m.*").collect()
    assert row[0] == row[1] and tuple(row[0]) == (0, 0.0, 0.0, 0.0, 0.0)


def test_pii_patterns(spark):
    phone = dict((k, p) for k, p, _ in pii.KINDS)["phone"]
    cases = {"+1 (743) 555-3824": "+[PHONE]", "(743) 555-3824": "([PHONE]", "1999 2000": "[PHONE]", "123456": "[PHONE]", "2024-01-15": "2024-01-15", "12345": "12345", "1234567890123456": "1234567890123456", "10.0.0.1": "10.0.0.1"}
    df = spark.createDataFrame([(k,) for k in cases], "s string").select("s", pii.replace(F.col("s"), phone, "[PHONE]").alias("out"))
    assert {r["s"]: r["out"] for r in df.collect()} == cases
    email = pii.KINDS[0][1]
    got = spark.createDataFrame([("éa.b@c.org, x@y.z Ü@d.fr",)], "s string").select(pii.replace(F.col("s"), email, "[E]").alias("o")).first()["o"]
    assert got == re.sub(r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b", "[E]", "éa.b@c.org, x@y.z Ü@d.fr", flags=re.I)
