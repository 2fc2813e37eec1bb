"""One row just inside and one just outside each rule, dedup invariants, sinks, the whole run."""

import dataclasses
import hashlib
import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework import cli
from sievework.config import C4, Dedup, Extract, Gopher, Language, Output, Pii, Settings
from sievework.operators import c4, dedup, extract, language, pii, quality
from sievework.operators.components import components
from sievework.plans import catalog, curate
from sievework.schema import OUTPUT, working
from sievework.sources import http, shards
from sievework.streaming import curate as stream


def rows(spark, texts, **more):
    return working(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "input_pos long, text string").withColumns({k: F.lit(v) for k, v in more.items()}))


def codes(df):
    return [r["drop"] and r["drop"]["code"] for r in df.orderBy("input_pos").collect()]


def test_gopher_limits(spark):
    words = lambda n: " ".join(["word"] * n)
    cfg = Gopher(min_words=4, max_words=6)
    texts = [words(3), words(4), words(6), words(7), "aaaa bbbb cccc dddd!!!!", "aaaa bbbb cccc dddd!!!!!", "abc abc abc 1234", "abc abc abc 12345", "AAA aaa aaa aaa", "AAAAAA aaa aaa aa", "a\nb\nc\nd", "a b\na b\nc d\ne f\na b", None]
    got = codes(quality.gopher_filter(rows(spark, texts), cfg))
    assert got == ["too_few_words", None, None, "too_many_words", None, "symbol_ratio", None, "digit_ratio", None, "upper_ratio", None, "too_many_words", "too_few_words"]
    assert codes(quality.gopher_filter(rows(spark, ["a b\na b\nc d\ne f\na b"]), Gopher(min_words=1))) == ["repetition"]
    off = quality.gopher_filter(rows(spark, ["x"]), Gopher(enabled=False)).first()
    assert off["quality_score"] == 1.0 and off["drop"] is None
    score = quality.gopher_filter(rows(spark, ["word " * 500]), Gopher()).first()["quality_score"]
    assert score == pytest.approx(1.1) and quality.gopher_filter(rows(spark, ["x"]), Gopher()).first()["quality_score"] is None


def test_language_rules(spark):
    text = "x" * 200
    df = working(spark.createDataFrame([(0, None, "en", 1.0), (1, "x" * 199, "en", 1.0), (2, text, None, 1.0), (3, text, "en", 0.79), (4, text, "en", 0.8), (5, text, "de", 1.0)], "input_pos long, text string, lang string, lang_conf double"))
    assert codes(language.language_filter(df, Language(detector="column"))) == ["no_text", "too_short", "lang_unknown", "low_conf", None, "lang_mismatch"]
    assert codes(language.language_filter(df, Language(detector="column", target_langs=())))[5] is None
    assert codes(language.language_filter(df, Language(detector="pycld3")))[2:] == ["bad_detector"] * 4
    assert codes(language.language_filter(df, Language(enabled=False))) == [None] * 6
    found = language.language_filter(rows(spark, ["der Hund und die Katze sind nicht in dem Haus"]), Language(min_chars=5, min_confidence=0.5, target_langs=("de",))).first()
    assert found["lang"] == "de" and found["lang_conf"] > 0.5 and found["drop"] is None


def test_c4_rules(spark):
    ok = "This is the one. That is a two. And it is three"
    texts = ["Please UNSUBSCRIBED now. " + ok, "One is. Two is", ok, "Aa bb. Cc dd. Ee ff.", "?? !! .. x y", ""]
    out = c4.c4_filter(rows(spark, texts), C4())
    assert codes(out) == ["blacklist_phrase", "too_few_sentences", None, "low_stopword_fraction", "low_stopword_fraction", "too_few_sentences"]
    assert out.where("input_pos = 0").first()["drop"]["detail"] == "subscribe"
    assert codes(c4.c4_filter(rows(spark, ["!! ?? .. !"]), C4())) == [None]


def test_pii_modes(spark):
    texts = ["mail a@b.org and 10.1.2.3 call 555-123-4567", "a@b.org c@d.org", "none", None]
    got = pii.pii_filter(rows(spark, texts), Pii()).orderBy("input_pos").collect()
    assert got[0]["text"] == "mail [EMAIL] and [IP] call [PHONE]" and got[0]["pii_types"] == ["email", "ip", "phone"] and got[0]["pii_matches"] == 3 and got[0]["pii_redacted"]
    assert [r["pii_redacted"] for r in got] == [True, True, False, False] and got[3]["text"] is None
    dropped = pii.pii_filter(rows(spark, texts), Pii(mode="drop"))
    assert codes(dropped) == ["pii_drop", None, None, None]
    assert dropped.where("input_pos = 1").first()["text"] == texts[1]
    only = pii.pii_filter(rows(spark, texts), Pii(redact_email=False, redact_phone=False)).orderBy("input_pos").first()
    assert only["pii_types"] == ["ip"] and "a@b.org" in only["text"]


def test_dropped_rows_keep_their_reason(spark):
    df = rows(spark, ["a@b.org " * 5]).withColumn("drop", F.struct(F.lit("x").alias("stage"), F.lit("y").alias("code"), F.lit(None).cast("string").alias("detail")))
    out = df.transform(language.language_filter, Language()).transform(quality.gopher_filter, Gopher()).transform(c4.c4_filter, C4()).transform(pii.pii_filter, Pii(mode="drop")).transform(dedup.exact_dedup, Dedup())
    assert codes(out) == ["y"] and out.first()["quality_score"] is None


def test_exact_dedup_keeps_the_best(spark):
    df = working(spark.createDataFrame([(0, "A  b", 0.5), (1, "a b", 0.9), (2, "a\nb ", 0.9), (3, "c", 0.1), (4, None, 0.3), (5, "", 0.2)], "input_pos long, text string, quality_score double"))
    out = dedup.exact_dedup(df, Dedup())
    assert codes(out) == ["duplicate", "duplicate", None, None, None, "duplicate"]
    assert codes(dedup.exact_dedup(df, Dedup(keep_policy="longest")))[:3] == [None, "duplicate", "duplicate"]
    assert codes(dedup.exact_dedup(df.repartition(7), Dedup())) == codes(out)
    assert codes(dedup.exact_dedup(df, Dedup(exact_dedup=False))) == [None] * 6


def test_bands_follow_the_threshold():
    assert [dedup.bands(t, 128) for t in (0.5, 0.7, 0.8, 0.85, 0.9)] == [(25, 5), (14, 9), (9, 13), (8, 16), (5, 25)]


def test_minhash_estimates_jaccard():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in rng.integers(0, 10_000, 400)]
    changed = words[:200] + ["zz"] + words[201:]
    grams = lambda w: {" ".join(w[i : i + 5]) for i in range(len(w) - 4)}
    residue = lambda g: int(hashlib.sha1(g.encode()).hexdigest()[:8], 16) % dedup.PRIME
    sets = [[residue(g) for g in grams(w)] for w in (words, changed)]
    a, b, none = dedup.least_values(np.array(sets[0] + sets[1]), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1]), len(sets[0]) + len(sets[1])]), 256)
    true = len(grams(words) & grams(changed)) / len(grams(words) | grams(changed))
    assert abs((a == b).mean() - true) < 0.08 and (none == dedup.PRIME).all()
    p, q = dedup.permutations(256)
    assert a.tolist() == [min((h * int(x) + int(y)) % dedup.PRIME for h in sets[0]) for x, y in zip(p, q)]


def test_signatures_against_plain_ones(spark, monkeypatch):
    """Native shingles and hashes, permutations in blocks of any size; words are lower-cased one by one."""
    monkeypatch.setattr(dedup, "BLOCK", 7)
    texts = ["İstanbul İzmir a b c d e f", "B a", "a b", "...", " ".join(f"w{i % 30}" for i in range(90))]
    got = {r["input_pos"]: r["signature"] for r in dedup.signatures(rows(spark, [*texts, "", None]), 5, 16).collect()}
    p, q = dedup.permutations(16)
    for i, text in enumerate(texts):
        words = [w.lower() for w in re.findall(r"\w+", text)]
        found = {" ".join(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else set(words)
        hashes = [int(hashlib.sha1(g.encode()).hexdigest()[:8], 16) % dedup.PRIME for g in found]
        assert got[i] == [min(((h * int(x) + int(y)) % dedup.PRIME for h in hashes), default=dedup.PRIME) for x, y in zip(p, q)]
    assert set(got) == set(range(5)) and got[1] == got[2]


def test_minhash_clusters(spark):
    rng = np.random.default_rng(2)
    base = [" ".join(f"w{i}" for i in rng.integers(0, 10_000, 200)) for _ in range(3)]
    texts = [base[0], base[0] + " end", base[1], base[0], base[2], "...", "!!"]
    df = rows(spark, texts, quality_score=0.5)
    out = dedup.minhash_dedup(df, Dedup(exact_dedup=False)).orderBy("input_pos").collect()
    assert [r["drop"] and r["drop"]["code"] for r in out] == ["near_duplicate", None, None, "near_duplicate", None, None, "near_duplicate"]
    assert len({out[i]["minhash_cluster_id"] for i in (0, 1, 3)}) == 1 and out[0]["minhash_cluster_id"] == out[1]["doc_id"] and out[2]["minhash_cluster_id"] is None
    assert codes(dedup.minhash_dedup(df.limit(1), Dedup())) == [None] and dedup.minhash_dedup(df.limit(0), Dedup()).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(90, 80)], "a long, b long")
    got = {r["id"]: r["root"] for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(51), 0), 80: 80, 90: 80}


def test_json_safe():
    import datetime
    import pathlib

    assert curate.json_safe({1: {"a": (1, 2.5)}, "p": pathlib.Path("x"), "d": datetime.date(2024, 1, 2), "n": float("nan"), "s": {"b", "a"}, "t": True}) == {"1": {"a": [1, 2.5]}, "p": "x", "d": "2024-01-02", "n": None, "s": ["a", "b"], "t": True}


PAGE = "<html><head><title>T &amp; t</title><script>a='</p>'</script></head><body><nav><a href=/>n</a></nav><article><h1>H</h1><p><b>{0}<br><p>more text</article><div class=ad>buy</div><footer>f</footer></body></html>"


def test_extract_rules(spark):
    cfg = Extract(min_extracted_chars=30)
    pages = [PAGE.format("body " * 10), "", None, "<p>short</p>"]
    df = working(spark.createDataFrame(list(enumerate(pages)), "input_pos long, html string"))
    out = extract.extract(df, cfg).orderBy("input_pos").collect()
    assert [r["drop"] and r["drop"]["code"] for r in out] == [None, "no_html", "no_html", "extraction_failed"]
    assert out[0]["title"] == "T & t" and out[0]["text"] == "H " + "body " * 10 + "more text" and "\n" not in out[0]["text"]
    assert codes(extract.extract(df, Extract(enabled=False))) == [None] * 4
    assert extract._extract_one("<div>" + "x" * 50 + "</div>", dataclasses.replace(cfg, primary="readability", fallback="none"))[1] == "x" * 50


def test_references_without_a_semicolon_are_text():
    """A title cut inside of &amp; keeps what is left of it, as the SQL of extract_pages has it."""
    page = "<title>A &amp; b &amp&amp; &copy 5 &#65; &ampx; &lt;p></title><article><h1>A &amp; b &amp</h1><p>R&amp;D &quot;x&quot; &copy; &amp;amp; &nosuch; & ? &"
    assert extract.read_page(page, "trafilatura") == ("A & b &amp& &copy 5 A &ampx; <p>", 'A & b &amp\nR&D "x" © &amp; &nosuch; & ? &')


def test_titles_cut_inside_a_reference(spark, tmp_path):
    import duckdb

    from sievework.plans import catalog

    titles = ["A &amp; b", "A &amp", "A &am", "&amp;&amp;&amp", "&quot;x&quot", "&copy; &copy", "&middot; &middot", "&"]
    pages = [f"<html><head><title>{t}</title></head><body><article><h1>{t}</h1><p>text</p></article></body></html>" for t in titles]
    spark.createDataFrame([(i, f"http://a.example.com/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    for name in ("extract_titles", "extract_pages"):
        assert sorted(tuple(r) for r in catalog.QUERIES[name](spark, str(tmp_path)).collect()) == sorted(con.execute(catalog.ORACLES[name]).fetchall())


def test_shards(spark, tmp_path):
    df = spark.createDataFrame([(i * 40_000, f"é{i}", []) for i in range(11)], "input_pos long, text string, kinds array<string>").repartition(5)
    for fmt, size, n in (("parquet", 5, 3), ("jsonl", 11, 1), ("parquet", 10, 2)):
        assert shards.write_shards(df, str(tmp_path), ["text", "kinds"], fmt, size) == n
        files = sorted((tmp_path / "shards").glob(f"shard_*.{fmt}"))
        assert [f.name for f in files] == [f"shard_{i:05d}.{fmt}" for i in range(n)]
        got = [[r["text"] for r in (spark.read.parquet(str(f)) if fmt == "parquet" else spark.read.json(str(f))).collect()] for f in files]
        assert [x for g in got for x in g] == [f"é{i}" for i in range(11)] and [len(g) for g in got[:-1]] == [size] * (n - 1)
    # A limit of records a file loses no rows, and a writer that fails leaves the shards before as they are.
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "2")
    try:
        assert shards.write_shards(df, str(tmp_path), ["text"], "parquet", 5) == 3 and spark.read.parquet(str(tmp_path / "shards")).count() == 11
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    with pytest.raises(Exception):
        shards.write_shards(df.withColumn("text", F.raise_error(F.lit("no"))), str(tmp_path), ["text"], "parquet", 5)
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 11 and not list(tmp_path.glob("_shards_old"))
    assert shards.write_shards(df.limit(0), str(tmp_path), ["text"], "parquet", 5) == 0 and not list((tmp_path / "shards").glob("shard_*"))
    assert shards.first_shard(spark, str(tmp_path)) is None


def test_whole_run(spark, tmp_path):
    body = "The cat is on the mat and it was with us. They are for you. We have this and that. " * 12
    pages = spark.createDataFrame(
        [(0, "http://a.com/1?utm_x=1", PAGE.format(body + "mail me@x.org ")), (1, "http://a.com/2", PAGE.format(body + "mail me@x.org ")), (2, "http://a.com/1", PAGE.format("dup url")), (3, "http://b.com/", "<p>tiny</p>"), (4, "http://c.com/", PAGE.format(body.replace("cat", "dog") + "privacy policy. "))],
        "page_id long, url string, html string",
    )
    settings = Settings(language=Language(detector="profile", min_confidence=0.3), output=Output(shard_size=2))
    summary = curate.run(pages.selectExpr("page_id as input_pos", "url as raw_url"), settings, str(tmp_path / "out"), scan=lambda wanted: http.pages_table(pages, wanted))
    assert (summary.total, summary.kept, summary.dropped, summary.shards_written) == (3, 1, 2, 1)
    stats = json.loads((tmp_path / "out/stats.json").read_text())
    assert stats["total_urls"] == 5 and stats["drop_counts"] == {"c4:blacklist_phrase": 1, "dedup_exact:duplicate": 1} and stats["lang_counts"] == {"en": 3} and stats["output_format"] == "parquet"
    got = spark.read.parquet(str(tmp_path / "out/shards"))
    assert got.columns == OUTPUT.names and got.schema["pii_types"].dataType == OUTPUT["pii_types"].dataType
    row = got.first()
    assert "[EMAIL]" in row["text"] and row["url"] == "http://a.com/1?utm_x=1" and row["domain"] == "a.com" and row["title"] == "T & t" and row["filters_triggered"] == []
    assert json.loads((tmp_path / "out/summary.json").read_text())["kept"] == 1
    first = shards.first_shard(spark, str(tmp_path / "out"))
    assert curate.preview_rows(first).first()["text_preview"].endswith("…") and curate.record_at(first, 0)["doc_id"] == row["doc_id"] and curate.record_at(first, 9) is None


def test_command_line(spark, tmp_path, capsys):
    assert cli.main(["version"]) == 0 and cli.main(["validate-config", str(tmp_path / "no.yaml")]) == 1
    (tmp_path / "c.yaml").write_text("output: {shard_size: 1}\n")
    assert cli.main(["validate-config", str(tmp_path / "c.yaml")]) == 0
    assert cli.main(["run", "--out", str(tmp_path / "o"), "--text", "http://a\nhttp://b", "--max-urls", "1", "--dry_run"]) == 0
    assert (tmp_path / "o/input_urls.txt").read_text() == "http://a\n"


def test_stream(spark, tmp_path):
    body = "The cat is on the mat and it was with us. They are for you. We have this and that. " * 12
    table = spark.createDataFrame([(i, f"http://a/{i}", PAGE.format(body + f"n{i % 3} ")) for i in range(6)], "page_id long, url string, html string").withColumn("seen", F.lit("2024-01-01").cast("timestamp"))
    table.write.parquet(str(tmp_path / "in"))
    pages = stream.read_pages(spark, str(tmp_path / "in"))
    query = stream.write_stream(stream.curate_stream(pages, Settings(language=Language(detector="profile", min_confidence=0.3))), str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_every_query_runs_small(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(catalog.QUERIES) <= set(entry.queries())


def test_release_gives_memory_back(spark):
    """What Python has let go leaves the driver, though later objects keep the end of its heap; and so does the JVM's native memory."""
    import re
    from pathlib import Path

    from sievework.plans import shared

    def resident():
        return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) >> 10

    held = [bytes([i % 256]) * 3000 for i in range(60_000)]
    pins = held[::200]
    before = resident()
    del held
    shared.release(spark)
    assert len(pins) == 300 and resident() < before - 100
    assert shared.trim_native(spark)
