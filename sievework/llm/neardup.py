"""Near-duplicate documents by Order MinHash and banded alignment.

A document is its sequence of lower-cased words. Its five-word shingles are labelled with their
occurrence (the second use of a shingle differs from the first). Each of ``SKETCHES`` hash
functions picks the ``PICKS`` least labelled shingles and keeps them in text order: two documents
share that key with a probability that follows their edit similarity, order included.

Short texts have too few shingles for that. Where the longer of two texts has up to ``SHORT``
words, d edits spoil at most 2d word pairs of either, so their 2d + 1 least labelled word pairs
of one seeded order have one in common: these are their keys, and no such pair is lost.

Equal word sequences (by 128 bits of BLAKE2b) first become one class, so copies meet as one row.
Classes that share a key are candidates. They are verified by banded alignment: two texts are
alike if at most 1 - ``SIMILARITY`` of the longer one's words must be edited. Connected texts
form a group, labelled by its least doc_id.

A bucket's pairs are not all aligned, yet no link between groups is lost. A lower bound of the
edit distance (lengths, and counts of words in bins) rules pairs out exactly. First round: each
member of a bucket is paired with the bucket's least class, which takes a partial minimum and
one narrow join, so a bucket of any size is one pair a member. Where the members of a bucket are
then one group, it is done: a pair inside a group cannot change the groups. Second round: the
least class of a bucket has met all others of it and stays out; of the buckets whose other members
are in several groups (of those with the same members, one) every pair across groups that the
bound leaves possible is judged, in one bucket of those that the two share, chosen by the pair.
First only profiles are dealt, and then the texts of members that are in such a pair; alignment
runs inside the bucket, nearest first, and members that it links are one group from there on. So
what travels grows with members, not with pairs, and only links come out.

Defined results: null, empty and blank texts have no words and are one group; texts under four words
are linked only when equal, which is all that 0.8 allows them; a null doc_id is no label if the
group has another; rows with equal id and text are members like others; an empty table gives no
rows; other columns are ignored, whatever their names. A text is held whole in one task, at about 40
bytes a byte of the longest. Nothing is collected but the emptiness of rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import components
from .alignment import similar
from .arrays import BYTE_VALUES, U64, longs, mix, pieces, span_hashes, utf8, word_hashes, word_spans
from .tables import drop, free_names, release, small_batches, stored

WORDS, SIMILARITY = 5, 0.8
SKETCHES, PICKS = 128, 2
#: Least words of a text that can be like a different one, and most words of a pair that is found for certain.
LEAST_WORDS, SHORT = 4, 40
#: Bins of the counts of words, and of word pairs.
BINS, PAIR_BINS = 256, 512
WIDTH = BINS + PAIR_BINS
#: Members of a bucket, and their words, that one task compares.
BUCKET, BUCKET_WORDS = 20_000, 8_000_000
_NO_ID = -(2**63)
_FOLDED = BYTE_VALUES.copy()
_FOLDED[0x41:0x5B] = _FOLDED[0x61:0x7B]
_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)) | U64(1)
_SHORT_SEED = U64(0xA0761D6478BD642F)
#: Bits of a shingle's place, below the bits that order it.
_PLACE = U64((1 << 24) - 1)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased (A-Z) words of a batch, and len + 1 offsets by document."""
    lo, hi, per = word_spans(data, offsets)
    return word_hashes(data, lo, hi, _FOLDED), per


def identity(text: bytes) -> bytes:
    """128 bits that equal sequences of lower-cased words share."""
    return hashlib.blake2b(b" ".join(text.lower().split()), digest_size=16).digest()


def labelled_shingles(words: np.ndarray, per: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k-word shingles with their occurrence label, and offsets by document; a shorter text has none."""
    sizes = np.maximum(np.diff(per) - k + 1, 0)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(offsets[-1]) + np.repeat(per[:-1] - offsets[:-1], sizes)
    if not len(at):
        return np.zeros(0, np.uint64), offsets
    shingles = span_hashes(mix(words), at, at + k)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    by = np.lexsort((shingles, owner))
    s, o = shingles[by], owner[by]
    new = np.ones(len(by), bool)
    new[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    again = np.empty(len(by), np.uint64)
    again[by] = (np.arange(len(by)) - first).astype(np.uint64)
    with np.errstate(over="ignore"):
        return np.where(again > 0, mix(shingles + again * U64(0xD1B54A32D192ED03)), shingles), offsets


def sketches(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of SKETCHES keys for each document: two least shingles of each order, in text order. Without a shingle: zeros.

    An order is the product with an odd number; 24 low bits hold the place (of documents of more
    shingles, modulo 2**24: equal texts still have equal keys).
    """
    docs = len(offsets) - 1
    out = np.zeros((docs, SKETCHES), np.uint64)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if not len(full):
        return out
    begin, size = offsets[full], np.diff(offsets)[full]
    place = (np.arange(len(shingles)) - np.repeat(begin, size)).astype(np.uint64) & _PLACE
    # The low bits stay zero under multiplication.
    high = shingles & ~_PLACE
    order = np.empty_like(high)
    with np.errstate(over="ignore"):
        for s, seed in enumerate(_SEEDS):
            np.multiply(high, seed, out=order)
            np.add(order, place, out=order)
            one = (np.minimum.reduceat(order, begin) & _PLACE).astype(np.int64)
            order[begin + one] = ~U64(0)
            two = (np.minimum.reduceat(order, begin) & _PLACE).astype(np.int64)
            # A document of one shingle repeats it.
            two = np.where(size > 1, two, one)
            key = mix(seed * U64(0xE7037ED1A0B428DB) + shingles[begin + np.minimum(one, two)])
            out[full, s] = mix(key * U64(0xE7037ED1A0B428DB) + shingles[begin + np.maximum(one, two)])
    return out


def short_keys(shingles: np.ndarray, offsets: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text of LEAST_WORDS to SHORT words the least labelled word pairs as keys, and their number by document."""
    # A text like this one has at most n / SIMILARITY words, and no more than SHORT.
    longest = np.minimum(np.floor(n / SIMILARITY + 1e-9), SHORT)
    edits = np.floor((1 - SIMILARITY) * longest + 1e-9).astype(np.int64)
    many = np.where((n >= LEAST_WORDS) & (n <= SHORT), np.minimum(2 * edits + 1, np.diff(offsets)), 0)
    owner = np.repeat(np.arange(len(n)), np.diff(offsets))
    held = many[owner] > 0
    owner, keys = owner[held], mix(shingles[held] ^ _SHORT_SEED)
    by = np.lexsort((keys, owner))
    owner, keys = owner[by], keys[by]
    new = np.ones(len(owner), bool)
    new[1:] = owner[1:] != owner[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(owner)), 0))
    return keys[np.arange(len(owner)) - first < many[owner]], many


def _only(words: np.ndarray, per: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of some documents; the others have none."""
    sizes = np.diff(per)
    return words[np.repeat(which, sizes)], np.concatenate(([0], np.cumsum(np.where(which, sizes, 0))))


def keys_of(words: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate keys of each document (sketches, then short keys), and len + 1 offsets into them."""
    n = np.diff(per)
    short, many = short_keys(*labelled_shingles(*_only(words, per, n <= SHORT), 2), n)
    # A text whose match has over SHORT words has sketches.
    long = n >= SIMILARITY * (SHORT + 1) - 1e-9
    at = np.concatenate(([0], np.cumsum(long * SKETCHES + many)))
    out = np.zeros(at[-1], np.uint64)
    out[at[:-1][long][:, None] + np.arange(SKETCHES)] = sketches(*labelled_shingles(*_only(words, per, long)))[long]
    out[np.repeat(at[1:] - np.cumsum(many), many) + np.arange(len(short))] = short
    return out, at


def _counts(values: np.ndarray, per: np.ndarray, bins: int) -> np.ndarray:
    docs = len(per) - 1
    cell = np.repeat(np.arange(docs), np.diff(per)) * bins + (values >> U64(64 - bins.bit_length() + 1)).astype(np.int64)
    return np.minimum(np.bincount(cell, minlength=docs * bins), 255).astype(np.uint8).reshape(docs, bins)


def profiles(words: np.ndarray, per: np.ndarray) -> np.ndarray:
    """Counts of words and of word pairs in bins, at most 255 each: a row of WIDTH for each document."""
    with np.errstate(over="ignore"):
        pairs = mix(words[:-1] * U64(0x9E3779B97F4A7C15) + words[1:]) if len(words) > 1 else words[:0]
    inner = np.ones(len(pairs), bool)
    edge = per[1:-1]
    inner[edge[(edge > 0) & (edge < len(words))] - 1] = False
    return np.hstack([_counts(words, per, BINS), _counts(pairs[inner], np.concatenate(([0], np.cumsum(np.maximum(np.diff(per) - 1, 0)))), PAIR_BINS)])


def _binary(rows: np.ndarray) -> pa.Array:
    """A row of bytes for each document as a binary column."""
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * rows.shape[1]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


SIGNED = "id long, x long, g1 long, g2 long, n long, keys array<long>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = utf8(batch.column(2))
        if not batch.num_rows:
            continue
        raw = data.tobytes()
        names = np.frombuffer(b"".join(identity(raw[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())), np.int64).reshape(-1, 2)
        n, keys, many = [], [], [np.zeros(1, np.int64)]
        for i, j in pieces(np.diff(at), 1 << 18):
            words, per = words_of(data[at[i] : at[j]], at[i : j + 1] - at[i])
            n.append(np.diff(per))
            flat, ends = keys_of(words, per)
            keys.append(flat)
            many.append(np.diff(ends))
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(many)), pa.int32()), pa.array(np.concatenate(keys).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(names[:, 0], pa.int64()), pa.array(names[:, 1], pa.int64()), pa.array(np.concatenate(n), pa.int64()), lists],
            ["id", "x", "g1", "g2", "n", "keys"],
        )


def _profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """g1, text -> g1, number of words and profile."""
    for batch in batches:
        data, at = utf8(batch.column(1))
        n, bins = [np.zeros(0, np.int64)], [np.zeros((0, WIDTH), np.uint8)]
        for i, j in pieces(np.diff(at), 1 << 18):
            words, per = words_of(data[at[i] : at[j]], at[i : j + 1] - at[i])
            n.append(np.diff(per))
            bins.append(profiles(words, per))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(n), pa.int64()), _binary(np.concatenate(bins))], ["g1", "n", "bins"])


def _bounds(one: np.ndarray, many: np.ndarray, n: np.ndarray, other: np.ndarray) -> np.ndarray:
    """At least so many edits lie between texts of these profiles and lengths (broadcast).

    An edit moves the word bins and the length by two together, the pair bins and the length by four.
    """
    length = np.abs(n - other)
    words = np.abs(many[:, :BINS] - one[..., :BINS]).sum(axis=1)
    pairs = np.abs(many[:, BINS:] - one[..., BINS:]).sum(axis=1)
    return np.maximum((words + length) / 2, (pairs + length) / 4)


def _near(least: float):
    """Pairs (a, b, lengths, bins) -> those that the bound leaves possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = longs(batch.column(2)), longs(batch.column(3))
            ba, bb = (utf8(batch.column(k))[0].reshape(-1, WIDTH).astype(np.int16) for k in (4, 5))
            yield batch.select(["a", "b"]).filter(pa.array(_bounds(ba, bb, na, nb) <= (1 - least) * np.maximum(na, nb) + 1e-9))

    return run


@dataclass
class Bucket:
    """One block of a bucket's members."""

    key: int
    #: The block's two parts, and the number of parts, that the bucket is cut into.
    block: int
    parts: int
    n: np.ndarray
    g1: np.ndarray
    group: np.ndarray
    bins: np.ndarray
    #: The keys of all open buckets each member is in; and its text, where alignment is at hand.
    keys: list[np.ndarray]
    texts: list[bytes]


def candidates(b: Bucket, least: float = SIMILARITY) -> Iterator[tuple[int, np.ndarray]]:
    """Each member with those of other groups that may be like it and are judged here, nearest first.

    A pair is met once: from the member of the smaller group (of equally large groups the last
    ranks highest, so that only the group of greatest rank has no larger one), in the block of
    their parts, in the bucket of the least of their shared keys in an order of the pair's own.
    """
    wide, n = b.bins.astype(np.int16), b.n
    _, codes, sizes = np.unique(b.group, return_inverse=True, return_counts=True)
    rank = sizes[codes] * len(n) + codes
    many = np.array([len(k) for k in b.keys])
    held = np.arange(max(1, many.max())) < many[:, None]
    keys = np.zeros(held.shape, np.int64)
    keys[held] = np.concatenate(b.keys)
    part = b.g1 % b.parts
    apart = b.block // b.parts != b.block % b.parts
    for i in np.flatnonzero(codes != codes[rank.argmax()]):
        js = np.flatnonzero((rank > rank[i]) & (n >= least * n[i] - 1) & (n * least <= n[i] + 1))
        if apart:
            js = js[part[js] != part[i]]
        if not len(js):
            continue
        bound = _bounds(wide[i], wide[js], n[i], n[js])
        near = bound <= (1 - least) * np.maximum(n[js], n[i]) + 1e-9
        js, bound = js[near], bound[near]
        if not len(js):
            continue
        order = mix((keys[js] ^ mix((b.g1[js] ^ b.g1[i]).view(np.uint64)).view(np.int64)[:, None]).view(np.uint64))
        order[~(held[js] & np.isin(keys[js], b.keys[i]))] = ~U64(0)
        here = keys[js, order.argmin(axis=1)] == b.key
        if here.any():
            yield int(i), js[here][np.argsort(bound[here], kind="stable")]


def links_of(b: Bucket, least: float = SIMILARITY) -> list[tuple[int, int]]:
    """Pairs that are alike, enough to join every two groups of the bucket that an alike pair judged here links."""
    root = {int(g): int(g) for g in b.group}
    words: dict[int, np.ndarray] = {}

    def find(g: int) -> int:
        while root[g] != g:
            root[g] = g = root[root[g]]
        return g

    def hashed(i: int) -> np.ndarray:
        if i not in words:
            words[i] = words_of(np.frombuffer(b.texts[i], np.uint8), np.array([0, len(b.texts[i])]))[0]
        return words[i]

    out = []
    for i, js in candidates(b, least):
        for j in js.tolist():
            one, two = find(int(b.group[i])), find(int(b.group[j]))
            if one != two and similar(hashed(i), hashed(j), least) is not None:
                root[one] = two
                out.append((i, j))
    return out


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
    """Batches sorted by (key, block) -> blocks of two members or more. Holds one block and one batch."""
    held: list[np.ndarray] | None = None
    for batch in _with_end(batches):
        if batch is not None and batch.num_rows:
            lists, texts = np.empty(batch.num_rows, object), np.empty(batch.num_rows, object)
            flat, at = longs(batch.column(7).flatten()), np.concatenate(([0], np.cumsum(np.asarray(batch.column(7).value_lengths()))))
            lists[:] = [flat[i:j] for i, j in zip(at[:-1], at[1:])]
            if batch.num_columns > 8:
                data, at = utf8(batch.column(8))
                texts[:] = [data[i:j].tobytes() for i, j in zip(at[:-1], at[1:])]
            now = [*(longs(batch.column(k)) for k in range(6)), utf8(batch.column(6))[0].reshape(-1, WIDTH), lists, texts]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
        if held is None or not len(held[0]):
            continue
        key, block = held[0], held[1]
        edge = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1, [len(key)]))
        stop = len(edge) - (1 if batch is None else 2)
        for lo, hi in zip(edge[:stop], edge[1 : stop + 1]):
            if hi - lo > 1:
                yield Bucket(int(key[lo]), int(block[lo]), int(held[2][lo]), *[x[lo:hi] for x in held[3:7]], list(held[7][lo:hi]), list(held[8][lo:hi]))
        held = [x[edge[stop] :] for x in held]


def _with_end(batches):
    yield from batches
    yield None


def _longs_batch(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _active(least: float):
    """Blocks -> the members that are in a pair to be judged there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _buckets(batches):
            met = np.zeros(len(b.n), bool)
            for i, js in candidates(b, least):
                met[i] = met[js] = True
            if met.any():
                size = int(met.sum())
                yield _longs_batch(["key", "block", "parts", "g1"], np.full(size, b.key), np.full(size, b.block), np.full(size, b.parts), b.g1[met])

    return run


def _judged(least: float):
    """Blocks with texts -> links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _buckets(batches):
            found = links_of(b, least)
            if found:
                yield _longs_batch(["a", "b"], [b.g1[i] for i, _ in found], [b.g1[j] for _, j in found])

    return run


def _verify(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = words_of(*utf8(batch.column(2))), words_of(*utf8(batch.column(3)))
            ok = [similar(one[0][one[1][i] : one[1][i + 1]], two[0][two[1][i] : two[1][i + 1]], least) is not None for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


_PAIR = "a long, b long"


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, n_words, class_id, group_id and group_size of every row.

    class_id is the least id of equal word sequences, group_id the least id of the group.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("x"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = stored(rows.mapInArrow(_sign, SIGNED), "signed")
    slim = stored(signed.select("id", "x", "g1", "g2", "n"), "slim")
    # A class is known by its content hash, as ids may repeat or be null.
    first = F.min(F.struct(F.col("id").isNull().alias("no"), "id", "x")).alias("r")
    classes = stored(signed.groupBy("g1", "g2", "n").agg(first, F.count("*").alias("copies"), F.first("keys").alias("keys")), "classes")
    drop(signed)
    release(spark)
    # Most keys have one member: they meet as (key, class) alone, and only what is shared goes on.
    keys = classes.select("g1", F.explode(F.array_distinct("keys")).alias("key")).repartition("key")
    hubs = keys.groupBy("key").agg(F.min("g1").alias("hub"), F.count("*").alias("many")).where("many > 1")
    shared = stored(keys.join(hubs, "key").select("key", "g1", "hub", "many"), "shared")
    release(spark)
    texts = stored(_texts(rows, classes, shared.select("g1").distinct()), "texts")
    narrow = stored(texts.mapInArrow(_profiled, "g1 long, n long, bins binary"), "narrow")
    release(spark)
    pairs = stored(_possible(shared.where("g1 != hub").select(F.col("hub").alias("a"), F.col("g1").alias("b")).distinct(), narrow, least), "pairs")
    roots = components(stored(_alike(pairs, texts, least), "links"))
    release(spark)
    # Second round: buckets whose members but the hub are in several groups; one of those that have the same members.
    named = narrow.select("g1", "n").join(roots.select(F.col("id").alias("g1"), "root"), "g1", "left").withColumn("root", F.coalesce("root", "g1"))
    # What is known of a class is joined once a class and goes to its buckets from there, so no join makes a row for each of its keys.
    held = shared.where("g1 != hub and many > 2").groupBy("g1").agg(F.collect_list(F.struct("key", "many")).alias("held"))
    now = stored(held.join(named, "g1").select("g1", "n", "root", F.inline("held")), "now")
    marks = [F.bit_xor(F.xxhash64(F.lit(s), "g1")).alias(f"m{s}") for s in (0, 1)]
    split = now.groupBy("key", "many").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.sum("n").alias("w"), *marks).where("lo != hi")
    split = split.groupBy("m0", "m1", "many", "w").agg(F.min("key").alias("key"))
    parts = F.ceil(F.greatest((F.col("many") - 1) / BUCKET, F.col("w") / BUCKET_WORDS)).cast("long")
    open_ = stored(now.drop("many").join(split.select("key", parts.alias("parts")), "key").select("key", "g1", "n", "root", "parts"), "open")
    drop(now)
    if not open_.isEmpty():
        facts = open_.groupBy("g1", "n", "root").agg(F.collect_set(F.struct("key", "parts")).alias("held")).join(narrow.select("g1", "bins"), "g1")
        facts = stored(facts.withColumn("keys", F.col("held.key")), "facts")
        active = stored(_sorted(_dealt(facts)).mapInArrow(_active(least), "key long, block long, parts long, g1 long"), "active")
        release(spark)
        met = active.groupBy("g1").agg(F.collect_list(F.struct("key", "block", "parts")).alias("blocks"))
        members = met.join(facts.hint("merge"), "g1").join(texts.hint("merge"), "g1").select("*", F.inline("blocks")).select(*_MEMBER, "text")
        roots = _folded(roots, stored(_sorted(members).mapInArrow(_judged(least), _PAIR), "found"))
        for used in (facts, active):
            drop(used)
    for used in (texts, shared, narrow, pairs, open_):
        drop(used)
    release(spark)
    named = classes.select("g1", "g2", "n", F.col("r.id").alias("class_id"), "copies").join(roots.select(F.col("id").alias("g1"), "root"), "g1", "left")
    named = named.withColumn("root", F.coalesce("root", "g1"))
    sums = named.groupBy("root").agg(F.min("class_id").alias("group_id"), F.sum("copies").alias("group_size"))
    named = named.join(sums, "root").select("g1", "g2", "n", "class_id", "group_id", "group_size", "root")
    out = slim.join(named, ["g1", "g2", "n"])
    return out.select(F.col("id").alias("doc_id"), F.col("x").alias("text_hash"), F.col("n").alias("n_words"), "class_id", "group_id", "group_size", F.col("root").alias("group_hash"))


def _texts(rows: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """g1 and one text of each wanted class."""
    owners = classes.join(wanted, "g1", "left_semi").select("g1", F.coalesce("r.id", F.lit(_NO_ID)).alias("k"), F.col("r.x").alias("x"))
    found = rows.withColumn("k", F.coalesce("id", F.lit(_NO_ID))).join(owners.hint("merge"), ["k", "x"])
    # A row repeated with its id and text gives its text once.
    return found.withColumn("i", F.row_number().over(Window.partitionBy("k", "x").orderBy("k"))).where("i = 1").select("g1", "text")


def _possible(pairs: DataFrame, narrow: DataFrame, least: float) -> DataFrame:
    """The pairs that the bound leaves possible."""
    with_a = pairs.join(narrow.select(F.col("g1").alias("a"), F.col("n").alias("na"), F.col("bins").alias("ba")).hint("merge"), "a")
    with_b = with_a.join(narrow.select(F.col("g1").alias("b"), F.col("n").alias("nb"), F.col("bins").alias("bb")).hint("merge"), "b")
    return with_b.select("a", "b", "na", "nb", "ba", "bb").mapInArrow(_near(least), _PAIR)


def _folded(roots: DataFrame, links: DataFrame) -> DataFrame:
    """id and root with further links taken in: roots stand for their groups, so only the new links are folded."""
    if links.isEmpty():
        return roots
    known = roots.select(F.col("id").alias("k"), F.col("root").alias("r"))
    ends = links.join(known, F.col("a") == F.col("k"), "left").select(F.coalesce("r", "a").alias("a"), "b")
    ends = ends.join(known, F.col("b") == F.col("k"), "left").select("a", F.coalesce("r", "b").alias("b"))
    new = ends.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(roots.select("id"), "id", "left_anti")
    every = roots.select("id", "root").unionByName(new.select("id", F.col("id").alias("root")))
    over = components(ends).select(F.col("id").alias("k"), F.col("root").alias("r"))
    return stored(every.join(over, F.col("root") == F.col("k"), "left").select("id", F.coalesce("r", "root").alias("root")), "roots")


_MEMBER = ("key", "block", "parts", "n", "g1", "root", "bins", "keys")


def _dealt(facts: DataFrame) -> DataFrame:
    """Classes by open bucket, with their facts; every two parts of a large bucket meet in a block of their own."""
    # The parts of members are numpy's remainders, never negative.
    mine = "pmod(g1, h.parts)"
    blocks = f"transform(sequence(0L, h.parts - 1), j -> struct(h.key as key, least(j, {mine}) * h.parts + greatest(j, {mine}) as block, h.parts as parts))"
    return facts.select("*", F.inline(F.expr(f"flatten(transform(held, h -> {blocks}))"))).select(*_MEMBER)


def _sorted(members: DataFrame) -> DataFrame:
    return members.repartition("key", "block").sortWithinPartitions("key", "block", "n", "g1")


def _alike(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs whose texts are alike. Joins that carry texts or profiles merge at every size, so that the plan does not turn with it."""
    with_a = pairs.join(texts.select(F.col("g1").alias("a"), F.col("text").alias("ta")).hint("merge"), "a")
    with_b = with_a.join(texts.select(F.col("g1").alias("b"), F.col("text").alias("tb")).hint("merge"), "b")
    return with_b.select("a", "b", "ta", "tb").mapInArrow(_verify(least), _PAIR)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group, the one of least id; columns unchanged."""
    found = groups(docs, id_col, text_col, least)
    k, x, r = free_names(docs.columns, "_sw_k", "_sw_x", "_sw_r")
    best = found.groupBy("group_hash").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_hash")).alias("r"))
    best = best.select(F.coalesce("r.doc_id", F.lit(_NO_ID)).alias(k), F.col("r.text_hash").alias(x))
    keyed = docs.select("*", F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias(k), F.xxhash64(F.col(text_col)).alias(x))
    kept = keyed.join(best, [k, x], "left_semi")
    # A row repeated with its id and text is kept once.
    alone = kept.withColumn(r, F.row_number().over(Window.partitionBy(k, x).orderBy(k))).where(F.col(r) == 1)
    return alone.select(*docs.columns)
