import random

import pytest
from pyspark.sql import functions as F

from sievework.config import Fetch, UrlFilter
from sievework.functions.urls import canonical, canonical_url, domain, url_domain
from sievework.operators import url_filter
from sievework.sources import http, urls

P = UrlFilter().drop_query_prefixes


@pytest.mark.parametrize(
    "given, want",
    [
        (" example.com/A?b=1#f ", "https://example.com/A?b=1"), ("HTTPS://Ex.Com/P", "https://ex.com/P"), ("http://a.com/?utm_source=x&REF=1&q=", "http://a.com/?q="),
        ("http://a.com/?utm_x=1", "http://a.com/"), ("http://a.com/?reference=1&sessionid=2&k", "http://a.com/?k="), ("http://a.com/?q=a%20b;c=2", "http://a.com/?q=a+b%3Bc%3D2"),
        ("//Host/x", "https:////Host/x"), ("", None), ("   ", None), (None, None), ("http://[::1", None), ("http://a.com/x;p?z=1", "http://a.com/x;p?z=1"),
    ],
)
def test_canonical(given, want):
    assert canonical(given, P) == want


def test_domains(spark):
    cases = {"https://www.a.example.co.uk/x": "example.co.uk", "http://user@Sub.Example.com:80/": "example.com", "http://10.0.0.1/x": "10.0.0.1", "http://localhost:3000": "localhost", "http://co.uk/": "co.uk", "https://x.org?q": "x.org", "http://www.x.co.id/": "x.co.id", "http://a.b.com.my": "b.com.my", "http://a.b.xn--p1ai/": "b.xn--p1ai"}
    rows = spark.createDataFrame([(k,) for k in cases], "u string").select("u", url_domain(F.col("u")).alias("d")).collect()
    assert {r["u"]: r["d"] for r in rows} == cases == {k: domain(k) for k in cases}


def test_suffix_list(spark):
    from sievework.functions.urls import read_suffixes

    rules = read_suffixes(["// a list", "com", "uk", "co.uk", "jp", "*.kobe.jp", "!city.kobe.jp", "", "kyoto.jp  // more", "a.b.kyoto.jp"])
    cases = {"http://www.x.co.uk/": "x.co.uk", "http://x.y.kobe.jp/": "x.y.kobe.jp", "http://z.x.y.kobe.jp/": "x.y.kobe.jp", "http://a.city.kobe.jp/": "city.kobe.jp", "http://q.kyoto.jp/": "q.kyoto.jp", "http://m.q.a.b.kyoto.jp/": "q.a.b.kyoto.jp", "http://w.x.unknown/": "x.unknown", "http://uk/": "uk"}
    rows = spark.createDataFrame([(k,) for k in cases], "u string").select("u", url_domain(F.col("u"), rules).alias("d")).collect()
    assert {r["u"]: r["d"] for r in rows} == cases == {k: domain(k, rules) for k in cases}


def test_native_and_parsed_urls_agree(spark):
    rng = random.Random(5)
    parts = ["http://", "HTTPS://", "https://", "//", "", "ftp://", "Ex.Com", "a-b.org:80", "user@h.net", "[::1]", "/", "/Path/x.html", "/a;p", "//x", "?", "?a=1", "?utm_source=x&b=2", "?ref=", "&c=3", "&&", "?a", "?q=a%20b", "#", "#Frag", " ", "é", "\\", "'", "[", "\t"]
    given = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(800)] + ["".join(rng.choice(group) for group in (parts[:3], parts[6:8], ["", *parts[10:14]], ["", *parts[14:18]], ["", *parts[18:20]], ["", *parts[22:24]])) for _ in range(800)]
    rows = spark.createDataFrame(list(enumerate(given)), "i long, u string").select("i", canonical_url(F.col("u"), P).alias("c")).collect()
    assert {r["i"]: r["c"] for r in rows} == {i: canonical(u, P) for i, u in enumerate(given)}


def test_positions_follow_the_files(spark, tmp_path):
    (tmp_path / "b.txt").write_text("".join(f"http://b/{i}\n" for i in range(5000)))
    (tmp_path / "a.txt").write_text("http://a/0\n\nhttp://a/1\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = urls.urls_from_file(spark, str(tmp_path)).orderBy("input_pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["raw_url"] for r in got] == ["http://a/0", "http://a/1", *[f"http://b/{i}" for i in range(5000)]] and len({r["input_pos"] for r in got}) == 5002


def test_connect_time_limit():
    """A socket that accepts but never answers fails after the time limit of reads."""
    import socket
    import time

    with socket.socket() as s:
        s.bind(("127.0.0.1", 0))
        s.listen()
        began = time.perf_counter()
        with pytest.raises(OSError):
            http.get(f"http://127.0.0.1:{s.getsockname()[1]}/", Fetch(timeout_s=0.3, connect_timeout_s=5))
        assert time.perf_counter() - began < 3


def test_filter_keeps_first_and_names_reasons(spark):
    given = ["http://a.com/1#x", "http://a.com/1", "", "http://a.com/P.JPG?x=1", "http://a.com/?f=x.jpg", "http://b.org/", "http://c.net/"]
    table = urls.urls_from_list(spark, given)
    cfg = UrlFilter(allow_domains=("A.com", "b.org"), deny_domains=("B.ORG",))
    judged = {r["input_pos"]: r["rejected"] for r in url_filter.judged(table, cfg).collect()}
    assert judged == {0: None, 1: "duplicate_url", 2: "bad_url", 3: "extension", 4: None, 5: "denied", 6: "not_allowed"}
    assert sorted(r["url"] for r in url_filter.filter_urls(table, cfg).collect()) == ["http://a.com/1", "http://a.com/?f=x.jpg"]
    assert url_filter.rejected_urls(table, cfg).count() == 5
    assert url_filter.filter_urls(table, UrlFilter(enabled=False)).where("url = raw_url").count() == 7


def test_funnel_counts_repeats_by_rule(spark, tmp_path):
    """Two addresses of one page both pass the rules, as in the SQL; the filter still keeps one."""
    import duckdb
    from sievework.plans import catalog

    given = ["http://a.example.com/en/1?utm_source=feed", "http://a.example.com/en/1#top", "https://b.example.org/de/2", "https://b.example.org/de/2#top"]
    spark.createDataFrame(list(enumerate(given)), "page_id long, url string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    rows = sorted(tuple(r) for r in catalog.QUERIES["url_filter_funnel"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert rows == sorted(con.execute(catalog.ORACLES["url_filter_funnel"]).fetchall()) == [("denied", 2), ("passed", 2)]
    cfg = UrlFilter(deny_domains=("example.org",))
    judged = {r["input_pos"]: r["rejected"] for r in url_filter.judged(urls.urls_from_list(spark, given), cfg).collect()}
    assert judged == {0: None, 1: "duplicate_url", 2: "denied", 3: "denied"} and url_filter.filter_urls(urls.urls_from_list(spark, given), cfg).count() == 1


def test_sources(spark, tmp_path):
    (tmp_path / "u.txt").write_bytes(b"http://a/\n\n # no\n http://b/\xff \n")
    assert [r["raw_url"] for r in urls.urls_from_file(spark, str(tmp_path / "u.txt"), comments=True).orderBy("input_pos").collect()] == ["http://a/", "http://b/"]
    assert [tuple(r) for r in urls.read_urls(spark, text=" x \n\ny").collect()] == [(0, "x"), (1, "y")]
    assert [r["raw_url"] for r in urls.pasted_urls(spark, "b\n#c\na", "b\nd").orderBy("input_pos").collect()] == ["b", "a", "d"]
    assert url_filter.limited(urls.urls_from_list(spark, ["a", "b"]), 1).count() == 1 and url_filter.limited(urls.urls_from_list(spark, ["a", "b"]), 0).count() == 2


def test_fetch_rules(spark):
    def call(url, cfg):
        kind = url.rsplit("/", 1)[1]
        if kind == "down":
            raise OSError("refused")
        status = int(kind) if kind.isdigit() else 200
        types = {"pdf": "application/pdf", "upper": "TEXT/HTML; charset=x", "none": ""}
        return http.Response(status, url + "#moved", types.get(kind, "text/html"), "<p>x</p>")

    names = ["ok", "404", "503", "pdf", "upper", "none", "down"]
    table = spark.createDataFrame([(i, f"http://h/{k}", "h") for i, k in enumerate(names)], "input_pos long, url string, domain string")
    got = {names[r["input_pos"]]: r for r in http.fetch(table, Fetch(max_retries=1), call, 2, lambda s: None).collect()}
    assert {k: r["drop"] and r["drop"]["code"] for k, r in got.items()} == {"ok": None, "404": "http_error", "503": "http_error", "pdf": "bad_content_type", "upper": None, "none": "bad_content_type", "down": "fetch_failed"}
    assert got["ok"]["html"] and got["404"]["html"] is None and got["404"]["status_code"] == 404 and "refused" in got["down"]["fetch_error"] and got["upper"]["final_url"].endswith("#moved") and got["down"]["domain"] == "h"


def test_retries_then_success():
    calls, naps = [], []

    def call(url, cfg):
        calls.append(url)
        if len(calls) < 3:
            raise TimeoutError
        return http.Response(200, url, "text/html", "")

    assert http._one(0, "u", Fetch(), call, naps.append)[1] == 200 and naps == [2, 4]
    calls.clear()
    assert http._one(0, "u", Fetch(max_retries=5), lambda u, c: 1 / 0, naps.append)[1] is None and naps[2:] == [2, 4, 6, 8, 8, 8]
