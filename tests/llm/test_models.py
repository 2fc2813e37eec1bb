"""Language identification, toxicity, near duplicates and the pipeline."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sievework.llm import langid, neardup, toxicity
from sievework.llm.alignment import distance, similar
from sievework.operators.components import components

WORDS = {"en": "the and of to in that with which from have this they were would there their".split(), "de": "der und die das nicht sich auch eine werden über für zwischen können müssen".split(), "fr": "le la les des une dans pour être cette avec où était plus même après très".split()}


def text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "en" if lang == "de" else "s"]) for _ in range(n))


def test_languages_held_out(table):
    rng = random.Random(2)
    rows = [(i, text(rng, lang, rng.randint(5, 60)), lang, "s", 1) for i in range(900) for lang in [rng.choice(list(WORDS))]] + [(1000, None, None, None, None), (1001, "", "en", "s", 0), (1002, "123 $$ 456", "en", "s", 1), (None, "Das ist die und der", None, "s", 1)]
    docs = table(rows)
    got = langid.identify(docs, ~toxicity.held_out("doc_id", 5, 0), keep=docs.columns).collect()
    known = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 900]
    assert np.mean([r["lang"] == r["lang_pred"] for r in known if r["doc_id"] % 7 == 0]) > 0.97 and all(0 <= r["score"] <= 1 for r in got)
    assert [r["lang_pred"] for r in got if r["doc_id"] in (1000, 1001, 1002)] == ["und"] * 3 and next(r for r in got if r["doc_id"] is None)["lang_pred"] == "de"
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns and kept.where("doc_id >= 1000").count() == 0 and kept.count() > 890
    nothing = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and langid.identify(docs.limit(0)).count() == 0


def test_training_reads_whole_texts(table, monkeypatch):
    """The language of these texts shows only after a long head that all share; a long text is cut between words without a change."""
    rng = random.Random(3)
    head = " ".join(f"h{i}" for i in range(400))
    rows = [(i, head + " " + text(rng, lang, 400), lang, "s", 1) for i in range(240) for lang in [rng.choice(list(WORDS))]]
    docs = table(rows)
    got = langid.identify(docs, ~toxicity.held_out("doc_id", 5, 0), keep=["doc_id", "lang"]).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]) > 0.97
    data = np.frombuffer(("été x " * 300 + "y" * 500 + " Ä").encode(), np.uint8)
    for most in (7, 100):
        at, owner = langid.cut_long(data, np.array([0, 0, len(data)]), most)
        assert owner[0] == 0 and set(owner[1:]) == {1} and len(at) > 4
        pieces = np.concatenate([langid.subwords(data[i:j], np.array([0, j - i]))[0] for i, j in zip(at[:-1], at[1:])])
        assert sorted(pieces) == sorted(langid.subwords(data, np.array([0, len(data)]))[0])


def test_model_against_explicit_means(table):
    """Probabilities are the softmax of the layer on the mean embedding, n-gram by n-gram."""
    rng = random.Random(4)
    texts = [text(rng, lang, 30).encode() for lang in ("en", "de", "fr") * 20]
    grams = [langid.shares(np.frombuffer(t, np.uint8)) for t in texts]
    model = langid.train(grams, ["en", "de", "fr"] * 20)
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    got = model.probabilities(data, at)
    for k in (0, 1, 59):
        rows = langid.subwords(np.frombuffer(texts[k], np.uint8), np.array([0, len(texts[k])]))[0]
        z = (sum(model.table[r].astype(float) for r in rows) / len(rows) + model.bias) / model.temperature
        assert got[k] == pytest.approx(np.exp(z) / np.exp(z).sum(), abs=1e-6)


CLASHING = ("_lang_pred", "_score", "_rejected", "score", "_sw_k", "_sw_x", "_sw_r", "_sw_k0", "_sw_copies_", "_sw_rn", "_r", "_u", "shard", "Slot", "id", "g1", "n")


def test_clashing_names(spark, table):
    """Every filtering stage leaves extra columns as they are, whatever they are called."""
    from sievework.llm import decontaminate, mixing, sharding

    rng = random.Random(5)
    docs = table([(i, text(rng, "en", 40), "en", "ab"[i % 2], 1) for i in range(30)] + [(30, None, None, None, None)])
    for i, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.col("doc_id") * 100 + i)
    items = spark.createDataFrame([(1, "not in any text at all")], "item_id long, text string")
    for out, n in ((langid.keep_known(docs), 30), (neardup.keep_one(docs), 31), (decontaminate.clean(docs, items), 31), (mixing.mix(docs), None), (sharding.shard_rows(docs, 3), 31)):
        rows = out.collect()
        assert n is None or len(rows) == n
        assert all(r[name] == r["doc_id"] * 100 + i for r in rows for i, name in enumerate(CLASHING) if not (name in ("shard", "Slot") and "slot" in out.columns))
    assert len(langid.identify(docs, keep=docs.columns).columns) == len(docs.columns) + 3


def test_subwords_stay_inside_words_and_documents():
    data, at = np.frombuffer("Ab cd".encode() + "ab".encode(), np.uint8), np.array([0, 5, 5, 7])
    rows, who, begins = langid.subwords(data, at)
    ends = np.append(begins[1:], len(rows))
    by = {w: [] for w in range(3)}
    for w, lo, hi in zip(who, begins, ends):
        by[int(w)].append(rows[lo:hi].tolist())
    assert by[1] == [[], []] and by[2][0] == by[0][0][:2] and by[2][1] == by[0][1][:1]


@pytest.mark.parametrize("toxic", [lambda a, b: a and b, lambda a, b: a != b])
def test_toxicity_learns_pairs(spark, table, toxic):
    """An insult counts only beside a group, or exactly one of two words counts: no linear weights can tell."""
    rng = random.Random(3)
    filler = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(1600):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = rng.sample(filler, 8) + ["scum"] * insult + ["folk"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic(insult, group))))
    rows += [(5000, None), (5001, ""), (None, "scum folk")]
    got = {r["doc_id"]: r for r in toxicity.score(table(rows), spark.createDataFrame([*labels, (1, None), (None, 1)], "doc_id long, toxic int"), ~toxicity.held_out("doc_id", 4, 2)).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i]["predicted"] == labels[i][1] for i in held]) > 0.97
    assert got[5000]["score"] == got[5001]["score"] and all(0 <= r["score"] <= 1 for r in got.values())
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(table(rows), empty).collect()} == {0.0} and toxicity.score(table(rows).limit(0), empty).count() == 0


def test_margins_against_explicit_pairs():
    rng = np.random.default_rng(7)
    size = 1 << toxicity.SLOTS_LOG2
    machine = toxicity.Machine(0.3, rng.random(size) < 0.8, rng.normal(size=size), rng.normal(size=(size, toxicity.FACTORS)))
    documents = [rng.choice(size, n, False) for n in (0, 1, 2, 9, 40)]
    got = machine.margins(np.concatenate(documents), np.concatenate(([0], np.cumsum([len(d) for d in documents]))))
    for d, z in zip(documents, got):
        d = [s for s in d if machine.used[s]]
        want = 0.3 + sum(machine.linear[s] for s in d) + sum(machine.factors[s] @ machine.factors[t] for k, s in enumerate(d) for t in d[:k])
        assert z == pytest.approx(want)


def test_terms_against_plain_ones():
    """Two documents share a slot for every word, neighbouring pair, stem and repeat that they share; a long text is hashed like a short one."""
    docs = [b"Scum folk", b"folk scum SCUM", b"", b"scumbag! folk"]
    slots, at = toxicity.terms(np.frombuffer(b"".join(docs), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in docs]))))
    sets = [set(slots[i:j].tolist()) for i, j in zip(at[:-1], at[1:])]
    # scum, folk, their pair; with the pair and the repeat of scum; nothing; scumbag, its stems of 5 and 6 bytes, folk, their pair.
    assert [len(s) for s in sets] == [3, 5, 0, 5] and len(sets[0] & sets[1]) == 2 and len(sets[0] & sets[3]) == 1


def test_alignment_against_dynamic_programme():
    rng = random.Random(5)
    for _ in range(1500):
        k = rng.randint(1, 4)
        a = [rng.randint(0, k) for _ in range(rng.randint(0, 14))]
        b = [rng.randint(0, k) for _ in range(rng.randint(0, 14))] if rng.random() < 0.5 else [x for x in a if rng.random() < 0.85]
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
            row = new
        most = rng.randint(0, 14)
        assert distance(np.array(a), np.array(b), most) == (row[-1] if row[-1] <= most else None)
    assert similar(np.zeros(0), np.zeros(0), 0.8) == 1.0


def bucket(n, bins, group, **more):
    size = len(n)
    given = {"key": 5, "block": 0, "parts": 1, "g1": np.arange(size) * 31 - 40, "keys": [np.array([5])] * size, "texts": [b""] * size} | more
    return neardup.Bucket(given["key"], given["block"], given["parts"], n, given["g1"], group, bins, given["keys"], given["texts"])


def random_profiles(rng, size):
    inner = np.arange(neardup.WIDTH) < neardup.BINS
    base = rng.integers(0, 6, (4, neardup.WIDTH)) * inner
    bins = np.array([np.maximum(0, base[rng.integers(4)] + inner * (rng.random(neardup.WIDTH) < 0.12) * rng.integers(-2, 3, neardup.WIDTH)) for _ in range(size)]).astype(np.uint8)
    bins = bins[np.argsort(bins.sum(axis=1), kind="stable")]
    return bins, bins.sum(axis=1).astype(np.int64)


def test_every_pair_across_groups_is_met_once():
    """Over blocks and shared keys, every pair of two groups that the bound leaves is a candidate exactly once."""
    rng = np.random.default_rng(4)
    for parts in (1, 1, 3):
        for _ in range(15):
            size = 30
            bins, n = random_profiles(rng, size)
            group, g1 = rng.integers(0, 12, size), rng.permutation(1000)[:size] - 500
            keys = [np.sort(rng.permutation(6)[: rng.integers(1, 6)]) for _ in range(size)]
            within = {(i, j) for j in range(size) for i in range(j) if group[i] != group[j] and set(keys[i]) & set(keys[j]) and (np.abs(bins[i].astype(int) - bins[j]).sum() + abs(n[i] - n[j])) / 2 <= 0.2 * max(n[i], n[j])}
            met = []
            for key in range(6):
                for p in range(parts):
                    for q in range(p, parts):
                        of = np.array([k for k in range(size) if key in keys[k] and g1[k] % parts in (p, q)], int)
                        if len(of) > 1:
                            b = bucket(n[of], bins[of], group[of], key=key, block=p * parts + q, parts=parts, g1=g1[of], keys=[keys[k] for k in of])
                            met += [tuple(sorted((int(of[i]), int(of[j])))) for i, js in neardup.candidates(b) for j in js]
            assert len(met) == len(set(met)) and set(met) == within


@pytest.mark.parametrize("sizes", [(1, 1), (2, 2), (1, 1, 1), (2, 2, 2), (3, 3, 1), (1, 3, 3)])
def test_links_join_what_alike_pairs_join(monkeypatch, sizes):
    """Every two groups are tried, also equally large ones, until one alike pair joins them; alike are only their last members."""
    group = np.repeat(np.arange(len(sizes)) * 7 + 3, sizes)
    size = len(group)
    last = {int(np.flatnonzero(group == g)[-1]) for g in np.unique(group)}
    b = bucket(np.full(size, 20), np.ones((size, neardup.WIDTH), np.uint8), group, texts=[str(i).encode() for i in range(size)])
    number = {int(neardup.words_of(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0][0]): i for i, t in enumerate(b.texts)}
    monkeypatch.setattr(neardup, "similar", lambda x, y, least: 1.0 if {number[int(x[0])], number[int(y[0])]} <= last else None)
    found = neardup.links_of(b)
    assert len(found) == len(sizes) - 1 and all({i, j} <= last for i, j in found)
    assert len({p for i, js in neardup.candidates(b) for p in {(i, j) for j in js}}) == (size * size - sum(k * k for k in sizes)) // 2


def test_buckets_over_batches():
    """Buckets are whole whatever the batches' edges; no row is lost."""
    rng = np.random.default_rng(5)
    key = np.sort(rng.integers(0, 12, 60))
    rows = [key, np.zeros(60, np.int64), np.ones(60, np.int64), np.arange(60), np.arange(60) + 100, np.arange(60) % 3]
    columns = [pa.array(x, pa.int64()) for x in rows] + [neardup._binary(np.full((60, neardup.WIDTH), 7, np.uint8)), pa.array([[i] * (i % 3 + 1) for i in range(60)], pa.list_(pa.int64())), pa.array([f"t{i}" for i in range(60)])]
    whole = pa.RecordBatch.from_arrays(columns, ["key", "block", "parts", "n", "g1", "root", "bins", "keys", "text"])
    for step in (1, 7, 60):
        got = list(neardup._buckets(iter([whole.slice(i, step) for i in range(0, 60, step)])))
        assert [b.g1.tolist() for b in got] == [(np.flatnonzero(key == k) + 100).tolist() for k in range(12) if (key == k).sum() > 1]
        for b in got:
            assert b.bins.shape == (len(b.n), neardup.WIDTH) and b.texts == [f"t{i}".encode() for i in b.n] and [k.tolist() for k in b.keys] == [[i] * (i % 3 + 1) for i in b.n.tolist()]


def test_a_cut_bucket_loses_no_group(table, monkeypatch):
    """With blocks of a few members and of a few words the groups stay the same."""
    rng = random.Random(31)
    passage = [f"p{i}" for i in range(90)]
    texts = [[*passage, *(f"w{rng.randrange(500)}" for _ in range(rng.randint(25, 60)))] for _ in range(40)]
    texts += [edited(rng, t, 4) for t in texts[:20]]
    docs = table([(i, " ".join(map(str, t))) for i, t in enumerate(texts)])
    whole = {r["doc_id"]: r["group_id"] for r in neardup.groups(docs).collect()}
    assert all(whole[i] == whole[40 + i] for i in range(20)) and len(set(whole.values())) > 5
    monkeypatch.setattr(neardup, "BUCKET", 7)
    assert {r["doc_id"]: r["group_id"] for r in neardup.groups(docs).collect()} == whole


def edited(rng, words, edits):
    """``words`` after so many replaced, inserted or removed words."""
    out = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        out[at : at + (kind != 1)] = [] if kind == 2 else [rng.getrandbits(62)]
    return out


def test_bounds_are_bounds():
    """No pair that the bound excludes can be aligned with so few edits."""
    rng = random.Random(21)
    texts = [[rng.randrange(k) for _ in range(rng.randint(2, 30))] for k in (2, 5, 300) for _ in range(40)]
    texts += [edited(rng, t, rng.randint(0, 4)) for t in texts]
    words = np.array([(w + 1) * 0x9E3779B97F4A7C15 % 2**64 for t in texts for w in t], np.uint64)
    n = np.array([len(t) for t in texts])
    wide = neardup.profiles(words, np.concatenate(([0], np.cumsum(n)))).astype(np.int16)
    for i in range(0, len(texts), 3):
        bound = neardup._bounds(wide[i], wide, n[i], n)
        assert all(bound[j] <= distance(np.array(texts[i]), np.array(texts[j]), 99) for j in range(len(texts)))


@pytest.mark.parametrize("length, share", [*[(n, 1.0) for n in range(4, 41, 4)], (41, 0.9), (60, 0.9), (100, 0.93), (400, 0.95)])
def test_candidates_at_the_threshold(length, share):
    """Pairs with as many edits as the threshold allows have a common key: all where both are short, else nearly all."""
    rng = random.Random(length)
    left, right = [], []
    for k in range(400):
        a = [rng.getrandbits(62) if rng.random() < 0.9 else 7 for _ in range(length)]
        b = edited(rng, a, length // 5)
        if similar(np.array(a), np.array(b), neardup.SIMILARITY) is None or (length <= neardup.SHORT < len(b)):
            continue
        left.append(a)
        right.append(b)
    if length == 4:
        left, right = [[1, 2, 3, 4]] * 5, [[1, 2, 3, 4, 5], [5, 1, 2, 3, 4], [1, 5, 2, 3, 4], [1, 2, 5, 3, 4], [1, 2, 3, 5, 4]]
    keys, at = neardup.keys_of(np.array([w for t in left + right for w in t], np.uint64), np.concatenate(([0], np.cumsum([len(t) for t in left + right]))))
    sets = [set(keys[i:j].tolist()) for i, j in zip(at[:-1], at[1:])]
    met = [bool(sets[i] & sets[i + len(left)]) for i in range(len(left))]
    assert len(met) >= 5 and np.mean(met) >= share


def test_words_that_collide_modulo_a_power_of_two():
    """Thue and Morse's word and its complement are one number to any polynomial modulo 2**64, but not here."""
    one = bytes(b"ab"[bin(i).count("1") & 1] for i in range(4096))
    two = one.translate(bytes.maketrans(b"ab", b"ba"))
    data = np.frombuffer(one + b" " + two, np.uint8)
    words, per = neardup.words_of(data, np.array([0, len(data)]))
    assert len(words) == 2 and words[0] != words[1]
    spaced = [" ".join(t.decode()).encode() for t in (one, two)]
    assert neardup.identity(spaced[0]) != neardup.identity(spaced[1]) and neardup.identity(b" A\tb ") == neardup.identity(b"a B")


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    from sievework.llm import arrays

    rng = np.random.default_rng(8)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    lo = np.sort(rng.integers(0, 4900, 300))
    hi = np.minimum(lo + rng.integers(0, 400, 300), 5000)
    whole = arrays.span_hashes(data, lo, hi, arrays.BYTE_VALUES)
    mixed = rng.permutation(300)
    for piece in (50, 333, 4999):
        monkeypatch.setattr(arrays, "PIECE", piece)
        assert (arrays.span_hashes(data, lo, hi, arrays.BYTE_VALUES) == whole).all()
        assert (arrays.span_hashes(arrays.BYTE_VALUES[data], lo[mixed], hi[mixed]) == whole[mixed]).all()


def test_recall_against_all_pairs(table):
    """Groups of 1 000 documents against the alignment of all pairs: at least 0.9 of the links just above the threshold stay in one group."""
    rng = random.Random(12)
    texts = []
    for k in range(250):
        a = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([8, 20, 45, 80, 150]))]
        texts.append(a)
        for share in (0.05, 0.12, 0.19):
            b = list(a)
            for at in rng.sample(range(len(a)), int(share * len(a))):
                b[at] = f"w{rng.randrange(4000)}"
            texts.append(b)
    ids = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    coded = [np.array([ids[w] for w in t]) for t in texts]
    # Of all pairs those are aligned whose bags of words leave it possible.
    bags = np.zeros((len(texts), len(ids)), np.int16)
    for row, c in zip(bags, coded):
        np.add.at(row, c, 1)
    n = np.array([len(c) for c in coded])
    links = []
    for j in range(len(texts)):
        bound = (np.abs(bags[:j] - bags[j]).sum(axis=1) + np.abs(n[:j] - n[j])) / 2
        links += [(i, j) for i in np.flatnonzero(bound <= 0.2 * np.maximum(n[:j], n[j]) + 1e-9).tolist() if similar(coded[i], coded[j], 0.8) is not None]
    got = {r["doc_id"]: r["group_id"] for r in neardup.groups(table([(i, " ".join(t)) for i, t in enumerate(texts)])).collect()}
    held = [got[i] == got[j] for i, j in links]
    assert len(links) > 800 and np.mean(held) > 0.97
    # No two bases are alike.
    assert all(got[i] // 4 == i // 4 for i in got)


def test_pairs_with_the_hub_are_judged_once(spark, table, monkeypatch):
    """A bucket's hub has met all others: buckets of two have no second round, and of those of c texts c - 1 are dealt."""
    rng, seen, store = random.Random(5), {}, neardup.stored

    def counted(df, name):
        out = store(df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(neardup, "stored", counted)

    def prose(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    def groups(texts):
        seen.clear()
        return {r["doc_id"]: r["group_id"] for r in neardup.groups(table([(i, " ".join(x)) for i, x in enumerate(texts)])).collect()}

    passages = [prose(60) for _ in range(12)]
    # Two unlike texts of each passage.
    assert groups([p + prose(60) for p in passages for _ in range(2)]) == {i: i for i in range(24)}
    assert seen["shared"] > 0 and seen["open"] == 0 and "facts" not in seen
    # Beside an unlike one two that are alike, whichever of the three is the hub.
    texts = []
    for p in passages:
        one = p + prose(60)
        texts += [p + prose(60), one, one[:-4] + prose(4)]
    assert groups(texts) == {i: i - (i % 3 == 2) for i in range(36)}
    # No bucket has more rows than texts but its hub.
    assert groups([passages[0] + prose(60) for _ in range(20)]) == {i: i for i in range(20)}
    assert 0 < seen["open"] <= neardup.SKETCHES * 19


def test_joins_on_classes_make_a_row_a_class(spark, table, monkeypatch):
    """Texts that share many buckets: joins on the class make no row for each of its buckets."""
    rng, store, made = random.Random(5), neardup.stored, []

    def look(plan):
        if "QueryStage" in plan.nodeName():
            return look(plan.plan())
        if plan.nodeName() == "AdaptiveSparkPlan":
            return look(plan.executedPlan())
        if re.search(r"Join.* \[g1#\d+L\], \[g1#\d+L\], Inner", plan.simpleString(100)):
            made.append(plan.metrics().apply("numOutputRows").value())
        for i in range(plan.children().size()):
            look(plan.children().apply(i))

    def looked(df, name):
        run = df.select("*")
        run.collect()
        look(run._jdf.queryExecution().executedPlan())
        return store(df, name)

    monkeypatch.setattr(neardup, "stored", looked)
    passage = [f"w{rng.randrange(10**9)}" for _ in range(60)]
    texts = [passage + [f"w{rng.randrange(10**9)}" for _ in range(60)] for _ in range(20)]
    # Two that are alike beside the unlike ones.
    texts += [t[:-4] + ["x", "y", "z", "u"] for t in texts[-2:]]
    got = {r["doc_id"]: r["group_id"] for r in neardup.groups(table([(i, " ".join(x)) for i, x in enumerate(texts)])).collect()}
    assert got == {i: i if i < 20 else i - 2 for i in range(22)}
    assert made and max(made) <= 22


def test_short_near_duplicates(table):
    """Groups of short texts are those of all pairs by plain alignment."""
    rng = random.Random(6)
    texts = []
    for _ in range(60):
        a = [rng.getrandbits(62) for _ in range(rng.randint(4, 40))]
        texts += [a, edited(rng, a, max(1, len(a) // 5))]
    root = list(range(len(texts)))
    pairs = [(i, j) for j in range(len(texts)) for i in range(j) if max(len(texts[i]), len(texts[j])) <= neardup.SHORT and similar(np.array(texts[i]), np.array(texts[j]), 0.8) is not None]
    for i, j in pairs:
        root = [root[i] if r == root[j] else r for r in root]
    assert len(pairs) > 30
    got = {r["doc_id"]: r["group_id"] for r in neardup.groups(table([(i, " ".join(f"w{w}" for w in t)) for i, t in enumerate(texts)])).collect()}
    assert all(got[i] == got[j] for i, j in pairs) and all(got[i] == root[i] for i in got if max(len(texts[i]), len(texts[root[i]])) <= neardup.SHORT)


def test_near_duplicates(table):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(60, 300))] for _ in range(40)]
    rows, family, at = [], {}, 0
    for f, words in enumerate(base):
        for copy in range(4 if f < 20 else 1):
            w = list(words)
            if copy >= 2:
                for _ in range(len(w) // 25):
                    w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((at, ("  " if copy == 1 else " ").join(w)))
            family[at] = f
            at += 1
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    for _ in range(15):
        rows.append((at, " ".join(rng.choice(vocabulary) for _ in range(150)) + " " + passage))
        family[at] = at
        at += 1
    rows += [(900, None), (901, ""), (902, "a b"), (903, "A b"), (904, "c"), (0, rows[0][1]), (None, "a b")]
    docs = table(rows)
    got = {(r["doc_id"], r["text_hash"]): r for r in neardup.groups(docs).collect()}
    label = {k[0]: r["group_id"] for k, r in got.items()}
    first = {}
    for i, f in family.items():
        assert label[i] == first.setdefault(f, i)
    assert label[900] == label[901] == 900 and label[902] == label[903] == label[None] == 902 and label[904] == 904
    kept = neardup.keep_one(docs)
    ids = sorted(r[0] for r in kept.select("doc_id").collect())
    assert kept.columns == docs.columns and ids == sorted({*first.values(), 900, 902, 904})
    assert neardup.groups(docs.limit(0)).count() == 0 and neardup.keep_one(docs.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (5, 5)], "a long, b long")
    got = {r["id"]: r["root"] for r in components(edges).collect()}
    assert {got[i] for i in range(61)} == {0} and [got[i] for i in (100, 101, 103)] == [100] * 3
    assert components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [0, 1])
def test_pipeline_stages(spark, table, tmp_path, copies):
    rng = random.Random(11)
    rows = [(i, text(rng, "en", rng.randint(30, 60)) + f" {i}", "en", rng.choice("ab"), 1) for i in range(60 * copies)]
    item = " ".join(f"q{i}" for i in range(20))
    if copies:
        rows += [(200, rows[0][1], "en", "a", 1), (201, rows[1][1] + " " + item, "en", "b", 1), (202, None, None, None, None), (203, "%%%", "en", "a", 3)]
    table(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), name)
        if name != "shards":
            assert out.columns == docs.columns
        docs = out
    ids = {r["doc_id"] for r in docs.collect()}
    assert not ids & {200, 202, 203}
    assert docs.where(F.contains("text", F.lit("q3 q4"))).count() == 0 and {"shard", "slot"} <= set(docs.columns)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_seeded_sample_is_the_least(spark):
    from sievework.llm.ranks import seeded, seeded_sample

    rows = spark.range(5000).select("id", seeded(1, "id").alias("u"))
    got = [r["id"] for r in seeded_sample(rows, "u", 40, "id").collect()]
    assert got == [r["id"] for r in sorted(rows.collect(), key=lambda r: r["u"])[:40]] and seeded_sample(rows.limit(0), "u", 5).count() == 0
