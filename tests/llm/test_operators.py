"""Decontamination, media, HTML, mixing, sharding: against brute force, round trips and their laws."""

import os
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest

from sievework.llm import decontaminate, htmltext, media, mixing, sharding


def test_automaton_against_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        letters, w = [b"a", b"b", b"c"][: rng.randint(1, 3)], rng.randint(2, 5)
        items = [(str(i), [rng.choice(letters) for _ in range(rng.randint(1, 12))]) for i in range(rng.randint(1, 6))]
        found = decontaminate.Automaton(items, w)
        for _ in range(4):
            words = [rng.choice([*letters, b"z"]) for _ in range(rng.randint(0, 30))]
            hit, names = set(), set()
            for name, item in items:
                n = min(w, len(item))
                windows = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)}
                for i in range(len(words) - n + 1):
                    if tuple(words[i : i + n]) in windows:
                        hit |= set(range(i, i + n))
                        names.add(name)
            spans, got = found.scan(words)
            assert ({k for lo, hi in spans for k in range(lo, hi)}, got) == (hit, names)


def test_decontamination_tables(spark, table, monkeypatch):
    item = " ".join(f"w{i}" for i in range(14))
    benchmark = spark.createDataFrame([(1, item), (1, item), (2, "Short one!"), (3, None), (4, "??"), (None, "nine of ten")], "item_id long, text string").withColumn("doc_id", __import__("pyspark").sql.functions.lit(7))
    docs = table([(1, "before " + item.upper().replace(" ", ", ") + " after this there is much more clean text to be kept as it is here and there and everywhere"), (2, None), (3, ""), (4, "a short ONE, nine of ten"), (5, "clean"), (5, "clean")])
    for limit in (decontaminate.AUTOMATON_WORDS, 3):
        monkeypatch.setattr(decontaminate, "AUTOMATON_WORDS", limit)
        rows = {r["doc_id"]: r for r in decontaminate.contamination(docs, benchmark).collect()}
        assert rows[1]["n_hit"] == 14 and rows[1]["items"] == ["1"] and [tuple(s) for s in rows[1]["spans"]] == [(1, 15)]
        assert rows[4]["n_hit"] == 5 and rows[4]["items"] == ["2"]
        assert rows[2]["n_words"] == rows[3]["n_words"] == rows[5]["n_hit"] == 0
        kept = decontaminate.clean(docs.withColumn("_sw_h", docs["doc_id"]).withColumn("items", docs["text"]), benchmark)
        assert kept.columns == [*docs.columns, "_sw_h", "items"]
        texts = {r["doc_id"]: r["text"] for r in kept.collect()}
        assert texts[1].startswith("before after this") and 4 not in texts and texts[2] is None and texts[3] == "" and texts[5] == "clean"
        assert kept.count() == 5
    none = benchmark.limit(0)
    assert decontaminate.contamination(docs, none).where("n_hit > 0").count() == 0 and decontaminate.contamination(docs.limit(0), benchmark).count() == 0


def test_automaton_memory():
    """An automaton of a hundred thousand words takes about twenty megabytes, so the bound of one block is about a hundred."""
    import tracemalloc

    rng = random.Random(9)
    vocabulary = [f"word{i}".encode() for i in range(5000)]
    items = [(str(i), [rng.choice(vocabulary) for _ in range(100)]) for i in range(1000)]
    tracemalloc.start()
    kept = decontaminate.Automaton(items, 10)
    assert tracemalloc.get_traced_memory()[0] < 30 << 20 and kept.scan(items[7][1][20:40])[1] == {"7"}
    tracemalloc.stop()


@pytest.mark.parametrize("n", [0, 1, 575, 576, 577, 30_000])
def test_png_round_trip(n):
    for text in (os.urandom(n), b"a" * n):
        payload = media.payload_of(text)
        assert len(payload) % 576 == 0 and payload and payload[:n] == text
        assert media.decode(media.encode(payload)).tobytes() == payload


def test_png_filters_and_checks():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 256, (12, 24), dtype=np.uint8)
    kinds, body = [0, 1, 2, 3, 4, 4, 3, 2, 2, 1, 1, 0], b""
    for y, kind in enumerate(kinds):
        line = bytearray([kind])
        for x in range(24):
            a, b, c = int(rows[y, x - 1]) if x else 0, int(rows[y - 1, x]) if y else 0, int(rows[y - 1, x - 1]) if x and y else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            line.append((int(rows[y, x]) - [0, a, b, (a + b) // 2, paeth][kind]) % 256)
        body += bytes(line)
    z = zlib.compress(body)
    image = media.SIGNATURE + media._chunk(b"IHDR", struct.pack(">IIBBBBB", 24, 12, 8, 0, 0, 0, 0)) + media._chunk(b"tEXt", b"x") + media._chunk(b"IDAT", z[:9]) + media._chunk(b"IDAT", z[9:]) + media._chunk(b"IEND", b"")
    assert (media.decode(image) == rows).all()
    for at in (3, 20, len(image) // 2, len(image) - 3):
        with pytest.raises(media.BadImage):
            media.decode(image[:at] + bytes([image[at] ^ 1]) + image[at + 1 :])
    with pytest.raises(media.BadImage):
        media.decode(image[:-12])


def test_media_table(table):
    rows = {r["doc_id"]: r for r in media.digest(media.media(table([(1, None), (2, ""), (3, "é" * 400), (4, "é" * 400), (5, "x" * 100_000)]))).collect()}
    assert rows[1]["payload_bytes"] == 576 and rows[1]["n_bytes"] == 0 and rows[1]["tail_crc32"] == zlib.crc32(b"\xff" * 32)
    assert rows[3]["n_bytes"] == 800 and rows[3]["payload_bytes"] == 1152
    assert [list(rows[3])[1:], list(rows[1])[1:]] == [list(rows[4])[1:], list(rows[2])[1:]]
    near, far = bytearray(os.urandom(5760)), os.urandom(5760)
    base = media.feature_of(np.frombuffer(bytes(near), np.uint8).reshape(-1, 24))
    near[100] ^= 1
    bits = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    assert bits(base, media.feature_of(np.frombuffer(bytes(near), np.uint8).reshape(-1, 24))) < 6 < bits(base, media.feature_of(np.frombuffer(far, np.uint8).reshape(-1, 24)))


PROSE = "This is a paragraph of the article, long enough to be prose, with commas, clauses, and an end. " * 2


def test_html_parts():
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body><header><p>{PROSE}</p></header><nav><a href=x>menu</a></nav>
    <div class="cookie-banner"><p>{PROSE}</p></div><div id="main-content"><h1>Head &amp; line</h1><p>One &eacute;&#233;&#x2014; {PROSE}<p>Two <b>bold <i>it</b> {PROSE}
    <script>var a = "</p><p>no</p>";</script><ul><li>first, item<li>second</ul><div class=ad>buy</div><form><input>send</form></div>
    <aside>{PROSE}</aside><section id="comments"><p>{PROSE}</p></section><footer>{PROSE}</footer></body></html>"""
    got = htmltext.extract(page).split("\n")
    line = " ".join(PROSE.split())
    assert got == ["Head & line", "One éé— " + line, "Two bold it " + line, "first, item", "second"]


def test_html_siblings_without_container():
    page = f"<body><div class=sidebar><a href=1>links</a> <a href=2>more</a></div><p>{PROSE}</p><p>{PROSE}</p></body>"
    assert htmltext.extract(page).split("\n") == [" ".join(PROSE.split())] * 2


@pytest.mark.parametrize(
    "mark, kept",
    [("class='content-ad'", False), ("class='page-header'", False), ("class='entry-header'", True), ("id='main' class='with-sidebar'", True), ("class='postComments'", False), ("class='alert alert-info'", False), ("role=complementary", False), ("hidden", False), ("style='display: none'", False), ("class='roadmap'", True)],
)
def test_html_marks(mark, kept):
    page = f"<body><div class=wrap><div id=content><p>{PROSE}</p><div {mark}><p>Marked: {PROSE}</p></div><p>{PROSE}</p></div></div></body>"
    assert ("Marked" in htmltext.extract(page)) == kept


@pytest.mark.parametrize("page", ["", "plain text", "<", "<p", "</p>", "<!-- open", "<script>never closed", "<p><b><i>" * 50, "<div>" * 300 + "x", "&#xFFFFFFFF; &bad; &", "<a href='>'>x</a>", "\x00<p>\x01</p>", "</>x", "<a =x y= '", "<!-->x"])
def test_html_never_fails(page):
    assert isinstance(htmltext.extract(page), str)


@pytest.mark.parametrize("tags", ["<div>", "<span>", "<p><b>", "<ul><li>", "<div><form><i>", "<table><tr><td>", "<b><p>"])
def test_html_depth(tags):
    """A hundred thousand open elements fail no page and take no quadratic time."""
    import time

    began = time.perf_counter()
    got = htmltext.extract(tags * (100_000 // tags.count("<")) + f"<p>{PROSE}</p>" + "</b>" * 1000 + f"<p>{PROSE}")
    assert got.split("\n") == [" ".join(PROSE.split())] * 2 and time.perf_counter() - began < 20


@pytest.mark.parametrize(
    "wrap, kept",
    [
        ("<p data-x=it's>{0}</p><p>{0}</p>", 2), ("<p title='it\"s > 1'>{0}</p><p a=\"x'>\">{0}</p>", 2), ("<p a'b>{0}</p><p>{0}</p>", 2), ("<p a= >{0}</p><p =b>{0}</p>", 2),
        ("<form id='aspnetForm'><div><p>{0}</p><p>{0}</p></div></form>", 2), ("<div class='share-price-report'><p>{0}</p><p>{0}</p></div>", 2), ("<div class='no-sidebar comments-open'><p>{0}</p></div>", 1),
        ("<div class='social-share'><p>{0}</p></div><div><p>{0}</p><p>{0}</p></div>", 2), ("<article><p>{0}</p></article><div class='comment-list'><p>{0}</p><p>{0}</p><p>{0}</p></div>", 1),
        ("<form><p>{0}</p></form><div><p>{0}</p><p>{0}</p></div>", 2), ("<template><template><p>{0}</p></template><p>{0}</p></template><p>{0}</p>", 1), ("<svg><circle/><text/></svg><p>{0}</p>", 1), ("<p>{0}<!-- a > b --></p><!--> <p>{0}</p>", 2),
    ],
)
def test_html_attributes_and_names(wrap, kept):
    line = " ".join(PROSE.split())
    assert htmltext.extract("<body><div>" + wrap.format(PROSE) + "</div></body>").split("\n") == [line] * kept


def test_html_against_generated_articles():
    """Pages around a known article, in several layouts: the text is the article's blocks, whatever stands beside it."""
    rng = random.Random(17)
    words = "river stone window garden letter morning silver people market story & é — «q» 100".split()

    def sentence(n):
        return " ".join(rng.choice(words) for _ in range(n)).capitalize() + ", and so on."

    def marked(text):
        return text.replace("&", "&amp;").replace("é", "&eacute;").replace(" ", rng.choice([" ", "\n  ", " "]), 1)

    for _ in range(60):
        parts, html = [], []
        for k in range(rng.randint(3, 9)):
            kind = rng.choice(["p", "p", "p", "h2", "ul", "blockquote"]) if k else "h1"
            if kind == "ul":
                items = [sentence(rng.randint(8, 14)) for _ in range(rng.randint(2, 4))]
                parts += items
                html.append("<ul>" + "".join(f"<li>{marked(i)}" for i in items) + "</ul>")
            else:
                text = sentence(5 if kind[0] == "h" else rng.randint(25, 80))
                parts.append(text)
                inner = marked(text)
                if kind == "p" and rng.random() < 0.4:
                    first, _, more = inner.partition(" ")
                    inner = f"<b>{first} <a href='/x?a=1&b=2'>{more.split(' ')[0]}</a> " + " ".join(more.split(" ")[1:]) + ("</b>" if rng.random() < 0.5 else "")
                html.append(f"<{kind}>{inner}" + (f"</{kind}>" if kind != "p" or rng.random() < 0.6 else ""))
        beside = [f"<nav><ul><li><a href=/>{sentence(3)}</a></ul></nav>", f"<div class='sidebar'><p>{sentence(30)}</p></div>", f"<aside><p>{sentence(30)}</p></aside>", f"<div id=cookie-notice>{sentence(25)}</div>", f"<script>var a = '<p>{sentence(30)}</p>'</script>", "<!-- <p>gone</p> -->", f"<div class=ad><p>{sentence(20)}</p></div>"]
        after = [f"<section id='comments'><div class=comment><p>{sentence(40)}</p></div></section>", f"<footer><p>{sentence(20)}</p></footer>", "<form><input name=q><button>Go</button></form>", f"<div class='related-posts'><p>{sentence(20)}</p></div>"]
        body = rng.choice(["<article>{}</article>", "<main><div class=content>{}</div></main>", "<div id=wrap><div class='post-body'>{}</div></div>", "<form action=/><div><div>{}</div></div></form>", "<div class='legal-report-view'>{}</div>"]).format("".join(html))
        page = "<!doctype html><html><head><title>t</title></head><body>" + "".join(rng.sample(beside, 3)) + body + "".join(rng.sample(after, 2)) + "</body></html>"
        assert htmltext.extract(page).split("\n") == parts, page


def test_html_pages_table(spark):
    pages = spark.createDataFrame([(1, "u", None, 1), (2, None, "", 2), (None, "v", f"<article><p>{PROSE}</p></article>", 3)], "page_id long, url string, html string, text int")
    rows = {r["page_id"]: r for r in htmltext.main_text(pages).collect()}
    assert rows[1]["text"] == rows[2]["text"] == "" and rows[2]["url"] is None and rows[None]["n_chars"] == len(" ".join(PROSE.split()))
    assert htmltext.main_text(pages.limit(0)).count() == 0


def plain_targets(sizes, weights, most=3):
    out, open_, rest = [0.0] * len(sizes), {i for i, s in enumerate(sizes) if s}, float(sum(sizes))
    while open_:
        per = rest / sum(weights[i] for i in open_)
        over = {i for i in open_ if per * weights[i] > most * sizes[i]}
        for i in over or open_:
            out[i] = most * sizes[i] if over else per * weights[i]
        rest -= sum(out[i] for i in over)
        open_ = open_ - over if over else set()
    return out


def test_targets(spark):
    rng = random.Random(8)
    for _ in range(4):
        sizes = [rng.choice([0, 1, 3, 50, 100, 5000]) for _ in range(rng.randint(1, 12))]
        names = sorted(rng.sample(["a", "b", "é", "z", "zz", "中", "\U0001F600", "A", "", "a a", "~", "0"], len(sizes)))
        names = names[:-1] + [None]
        sums = mixing.weighed(spark.createDataFrame(list(zip(names, sizes)), "source string, s long"))
        got = {r["source"]: (r["s"], r["target"]) for r in mixing.targets(sums, 3).collect()}
        want = plain_targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
        assert [got[n][1] for n in names] == pytest.approx(want)
    assert mixing.targets(mixing.weighed(spark.createDataFrame([], "source string, s long")), 3).count() == 0


def test_fit_is_the_best_sum():
    """Nearest to the budget from below, against all sums; also where the programme covers only a part of the budget at first."""
    rng = random.Random(5)
    for case in range(600):
        lengths = rng.sample(range(1, 400), rng.randint(1, 6)) if case % 2 else [7 * k for k in rng.sample(range(1, 40), rng.randint(1, 5))]
        counts = [rng.randint(0, 5) for _ in lengths]
        sums = {0}
        for n, c in zip(lengths, counts):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        budget = rng.randint(0, max(sums))
        for rooms in (mixing.ROOMS, (16, 64, 1 << 14)):
            took = mixing.fit(lengths, counts, budget, rooms)
            assert all(0 <= t <= c for t, c in zip(took, counts)) and sum(a * b for a, b in zip(lengths, took)) == max(s for s in sums if s <= budget)


def test_fit_of_one_long_and_many_short():
    """A text of two million words takes no room for bitsets of its length."""
    import tracemalloc

    tracemalloc.start()
    lengths = [*range(1, 301), 2_000_000]
    took = mixing.fit(lengths, [20] * 300 + [1], 700_000)
    assert sum(a * b for a, b in zip(lengths, took)) == 700_000 and tracemalloc.get_traced_memory()[1] < 20 << 20
    tracemalloc.stop()


def test_mixture(table):
    rng = random.Random(6)
    rows = [(i, " ".join("w" * 1 for _ in range(rng.randint(0, 60))), "en", rng.choice(["a", "b", "b", "b", "c", None]), 1) for i in range(600)] + [(7, None, "en", "a", 0), (8, "x y", "en", "é", 1), (8, "x y", "en", "é", 1), (None, "q", "en", "a", 1)]
    docs = table(rows)
    got = mixing.plan(docs).collect()
    assert len(got) == len(rows) and sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.plan(docs.repartition(3)).collect()), key=repr)
    by = {}
    for r in got:
        assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 3 * r["size"]
        s = by.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        s[0] += r["size"]
        s[1] += r["taken"]
    assert sum(s[2] for s in by.values()) == pytest.approx(sum(s[0] for s in by.values()))
    assert all(s[0] == s[3] and abs(s[1] - s[2]) <= 1 for s in by.values())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.where("size(split(text, ' ')) > 0 and text != ''").count() == sum(r["taken"] // r["size"] for r in got if r["size"])
    assert mixing.plan(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def test_shards(table):
    rng = random.Random(7)
    rows = [(i, "x" * (i % 50), "en", rng.choice(["a", "a", "b", None]), 1) for i in range(1003)] + [(5, "same", "en", "a", 1)] * 30 + [(None, None, None, None, None)]
    docs = table(rows)
    got = sharding.assign(docs, 40).collect()
    counts = Counter(r["shard"] for r in got)
    assert len(got) == len(rows) and set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(40):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    share = Counter((r["shard"], r["source"]) for r in got)
    for name, n in Counter(r[3] for r in rows).items():
        assert all(abs(share[s, name] - n / 40) <= 2 for s in range(40))
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, sharding.assign(docs.repartition(7), 40).collect()), key=repr)
    whole = sharding.shard_rows(docs.withColumn("shard", docs["doc_id"]), 3)
    assert whole.columns == [*docs.columns, "shard", "slot"] and whole.count() == len(rows) and {r[0] for r in whole.select("shard").distinct().collect()} == {0, 1, 2}
    assert sharding.assign(docs.limit(0), 40).count() == 0 and Counter(r["shard"] for r in sharding.assign(docs.limit(3), 40).collect()).most_common(1)[0][1] == 1
    with pytest.raises(ValueError):
        sharding.assign(docs, 0)


def test_very_long_texts(spark, table):
    """A text of megabytes beside null and empty ones, through every operator: all of it counts, to its last word."""
    from sievework.llm import langid, neardup, suffixarray, suffixtree, toxicity

    rng = random.Random(41)
    half = " ".join(f"w{rng.randrange(10**9)}" for _ in range(150_000))
    item = " ".join(f"q{i}" for i in range(14))
    long = f"{half} {half} {item}"
    near = long.split(" ")
    for at in rng.sample(range(300_000), 20_000):
        near[at] = f"x{at}"
    short = [(10 + i, " ".join(rng.choice(["the and of", "der und die", "le la des"][i % 3].split()) for _ in range(40)), ["en", "de", "fr"][i % 3], "s", 1) for i in range(90)]
    docs = table([(1, long, "en", "s", len(long)), (2, " ".join(near), "de", "t", 1), (3, None, None, None, None), (4, "", "en", "s", 0), *short]).repartition(3)

    words = {r["doc_id"]: r for r in suffixtree.dedup(docs.where("doc_id != 2")).collect()}
    assert (words[1]["n_words"], words[1]["n_removed"], words[3]["n_words"]) == (300_014, 150_000, 0) and words[1]["kept"] == f"{half} {item}"
    spans = {r["doc_id"]: r for r in suffixarray.dedup(docs.where("doc_id in (1, 3, 4)")).collect()}
    # The blank before the second half is not covered, and that after it only if the item's first byte follows it in the first half too.
    assert spans[1]["n_spans"] == 1 and abs(spans[1]["n_removed"] - len(half)) <= 1 and spans[3]["n_bytes"] == spans[4]["n_removed"] == 0
    found = {r["doc_id"]: r for r in decontaminate.contamination(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()}
    assert (found[1]["n_words"], found[1]["n_hit"], found[1]["items"]) == (300_014, 14, ["5"]) and found[3]["n_words"] == 0
    groups = {r["doc_id"]: r["group_id"] for r in neardup.groups(docs).collect()}
    assert groups[1] == groups[2] == 1 and groups[3] == groups[4] == 3
    named = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert named[3]["lang_pred"] == named[4]["lang_pred"] == "und" and 0 < named[1]["score"] <= 1
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(docs, spark.createDataFrame([(i, i % 2) for i in range(1, 100)], "doc_id long, toxic int")).collect()}
    assert scored[3] == scored[4] and all(0 <= s <= 1 for s in scored.values())
    stored = {r["doc_id"]: r for r in media.digest(media.media(docs)).collect()}
    assert stored[1]["n_bytes"] == len(long) and stored[1]["tail_crc32"] == zlib.crc32(media.payload_of(long.encode())[-32:])
    planned = {r["doc_id"]: r for r in mixing.plan(docs).collect()}
    assert planned[1]["size"] == 300_014 and planned[3]["size"] == planned[4]["taken"] == 0
    assert {r["doc_id"]: r["size"] for r in sharding.assign(docs, 3).collect()}[1] == len(long) + 16
    pages = spark.createDataFrame([(1, "u", "<nav>x</nav><article>" + f"<p>{PROSE}" * 20_000 + "</article>")], "page_id long, url string, html string")
    assert htmltext.main_text(pages).first()["n_chars"] == 20_000 * (len(" ".join(PROSE.split())) + 1) - 1
