"""Repeated windows over a whole corpus: the frame that both substring-dedup operators share.

A document is a sequence of units (bytes, or words as 64-bit numbers). A window is ``window``
consecutive units of one document. A window repeats when an equal one starts earlier: in a
smaller document, or in the same document at an earlier start.

Suffixes that can be equal for a window must meet, without moving the corpus:

1. Each window has an anchor: its leftmost least hashed k-gram. Equal windows have equal anchors
   at equal offsets. Windows in a row with the same anchor form a run, described by the anchor's
   hash, a hash of the run's context (all units of its windows), document, start and length:
   one row for about every 40 bytes. Runs of one batch that repeat an earlier context are
   resolved in the batch, so that copies do not pile up on one key.
2. Rows meet by anchor. Runs with the same context as an earlier run repeat as wholes. An anchor
   with one context is done. Where an anchor has several, one run for each context goes on.
3. Only for these, the units are fetched, and an index (suffix array or suffix tree) over blocks
   of contexts finds equal windows of at least ``window`` units. An anchor with more contexts
   than a block holds is dealt over blocks; the first occurrence of each window in a block then
   meets those of other blocks by its hash.

Every step covers all windows; none is capped, sampled or dropped, and no key gathers rows in
memory beyond a block. Ties: rows with the same id and text are the same document (neither is
earlier); rows with the same id and other texts are ordered by the texts' CRC-32.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U64, longs, mix, pieces, powers, span_hashes, utf8
from .tables import release, small_batches, stored

#: Units handled at a time: keeps numpy's arrays in the processor's cache and bounds memory for texts of any length.
PIECE = 1 << 18
#: Contexts of one anchor that an index block takes, and units of a block.
BLOCK_CONTEXTS, BLOCK_UNITS = 2048, 1 << 20
_POSITION_BITS = 22
#: Stands for a null id: before every other document.
NULL_ID = -(2**63)


@dataclass(frozen=True)
class Units:
    """How texts become units. ``split`` gives the units of a batch and len + 1 offsets by document."""

    window: int
    gram: int
    split: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    #: Random 64-bit values of units, for hashing.
    values: Callable[[np.ndarray], np.ndarray]
    #: For runs of one block: (units, begin of each context, starts of each context) -> class of each start.
    classes: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _anchors_of_piece(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of the windows that start in [lo, hi) of each document part: start, length, anchor hash, context hash."""
    n = len(values)
    base = int(powers(2)[0][1])
    h, width = values, 1
    with np.errstate(over="ignore"):
        # Doubling gives k-gram hashes for the powers of two; the bits of `gram` join them.
        whole, done = None, 0
        left = gram
        while left:
            if left & 1:
                whole = h if whole is None else whole[: n - done - width + 1] * U64(pow(base, width, 2**64)) + h[done : n - width + 1]
                done += width
            left >>= 1
            if left:
                h = h[: len(h) - width] * U64(pow(base, width, 2**64)) + h[width:]
                width *= 2
    grams = mix(whole)
    span = window - gram + 1
    m = (grams & ~U64((1 << _POSITION_BITS) - 1)) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while step * 2 <= span:
        m = np.minimum(m[: len(m) - step], m[step:])
        step *= 2
    if step < span:
        m = np.minimum(m[: len(m) - (span - step)], m[span - step :])
    # m[i]: packed leftmost least gram of the window that starts at i; windows over a document's end are left out below.
    change = np.zeros(len(m) + 1, bool)
    change[1:-1] = m[1:] != m[:-1]
    change[lo] = change[hi] = True
    begin = np.flatnonzero(change)
    end = np.append(begin[1:], len(m))
    part = np.searchsorted(lo, begin, "right") - 1
    ok = (part >= 0) & (begin < len(m))
    ok[ok] &= begin[ok] < hi[part[ok]]
    begin, end = begin[ok], end[ok]
    at = (m[begin] & U64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    return begin, end - begin, grams[at], span_hashes(values, begin, end - 1 + window)


def anchors(seq: np.ndarray, offsets: np.ndarray, window: int, gram: int, values: Callable[[np.ndarray], np.ndarray] = lambda x: x) -> tuple[np.ndarray, ...]:
    """Runs of all documents: document, start in it, length, anchor hash, context hash (the hashes as int64). ``values`` is taken piece by piece."""
    out: list[tuple[np.ndarray, ...]] = []
    sizes = np.diff(offsets)
    for i, j in pieces(sizes, PIECE):
        for a in range(0, max(1, int(offsets[j] - offsets[i])), PIECE):
            # Several documents, or PIECE starts of one long document.
            lo = offsets[i:j] - offsets[i] - a if j - i > 1 else np.zeros(1, np.int64)
            first = int(offsets[i]) + a
            stop = int(offsets[j]) if j - i > 1 else min(int(offsets[j]), first + PIECE + window - 1)
            if j - i > 1 and a:
                break
            ends = offsets[i + 1 : j + 1] - offsets[i] if j - i > 1 else np.array([stop - first])
            hi = ends - window + 1
            use = hi > lo
            if not use.any():
                continue
            begin, length, h, c = _anchors_of_piece(values(seq[first:stop]), lo[use], hi[use], window, gram)
            ids = np.arange(i, j)[use]
            doc = ids[np.searchsorted(lo[use], begin, "right") - 1]
            out.append((doc, begin + first - offsets[doc], length, h.view(np.int64), c.view(np.int64)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*out))


def _merged(doc: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adjoining runs of starts, in order of (doc, start), as one."""
    if not len(doc):
        return doc, start, length
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + length[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], start[last] + length[last] - start[at]


RUNS = "h long, c long, d long, p long, n long"
#: kind 0: repeated starts; 1: a run to index; 2: the same, of an anchor dealt over blocks.
FOUND = "kind int, h long, part int, d long, p long, n long"


def _run_rows(units: Units):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(2))
            seq, offsets = units.split(data, at)
            doc, start, length, h, c = anchors(seq, offsets, units.window, units.gram, units.values)
            d, p = longs(batch.column(0))[doc], (longs(batch.column(1))[doc] << 31) | start
            order = np.lexsort((p, d, c, h))
            doc, d, p, length, h, c = (x[order] for x in (doc, d, p, length, h, c))
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
            head = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0)) if len(h) else np.zeros(0, np.int64)
            later = (d != d[head]) | (p != p[head])
            # Repeats within the batch are settled here; adjoining ones become one row, keyed by document.
            rd, rp, rn = d[later], p[later], length[later]
            by = np.lexsort((rp, rd))
            rd, rp, rn = _merged(rd[by], rp[by], rn[by])
            parts = [np.concatenate([a, b]) for a, b in ((h[new], mix(rd.view(np.uint64)).view(np.int64)), (c[new], np.zeros(len(rd), np.int64)), (d[new], rd), (p[new], rp), (length[new], -rn))]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in parts], ["h", "c", "d", "p", "n"])

    return run


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h, c, d, p): repeats of a context, and the contexts of anchors that have several.

    Holds the contexts of one anchor up to two blocks; a larger anchor is passed on block by block.
    """
    pool = [np.zeros(0, np.int64) for _ in range(4)]  # h, d, p, n of contexts whose anchor may go on
    flushed, part = None, 0  # the anchor of which blocks have gone out already, and how many
    last = None  # h, c, d, p of the current context's first run

    def batch_of(kind, h, part, d, p, n):
        if not len(h):
            return []
        return [pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(kind, h.shape), pa.int32()), pa.array(h, pa.int64()), pa.array(np.broadcast_to(part, h.shape), pa.int32()), *[pa.array(x, pa.int64()) for x in (d, p, n)]], ["kind", "h", "part", "d", "p", "n"])]

    def emit(final: bool):
        nonlocal pool, flushed, part
        h, d, p, n = pool
        if not len(h):
            return []
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(h)))
        group = np.cumsum(new) - 1
        inside = np.arange(len(h)) - at[group]
        earlier = np.zeros(len(at), np.int64)
        if flushed == h[0]:
            earlier[0] = part
        block = inside // BLOCK_CONTEXTS + earlier[group]
        hot = (size + earlier * BLOCK_CONTEXTS > BLOCK_CONTEXTS)[group]
        go = (size + earlier > 1)[group]
        if not final:
            # The last anchor may have more contexts to come: only its full blocks go, and only when it is surely hot.
            tail = at[-1]
            full = (size[-1] - 1) // BLOCK_CONTEXTS * BLOCK_CONTEXTS if size[-1] > BLOCK_CONTEXTS else 0
            out = np.arange(len(h)) < tail + full
            if full:
                flushed, part = h[-1], int(earlier[-1] + full // BLOCK_CONTEXTS)
            elif flushed is not None and flushed != h[-1]:
                flushed, part = None, 0
            pool = [x[~out] for x in pool]
            go &= out
        else:
            pool = [x[:0] for x in pool]
            flushed, part = None, 0
        return batch_of(np.where(hot, 2, 1)[go], h[go], block[go], d[go], p[go], n[go])

    for batch in batches:
        h, c, d, p, n = (longs(batch.column(i)) for i in range(5))
        done = n < 0
        if done.any():
            yield from batch_of(0, h[done], 0, d[done], p[done], -n[done])
            h, c, d, p, n = (x[~done] for x in (h, c, d, p, n))
        if not len(h):
            continue
        if last is not None:
            h, c, d, p, n = (np.concatenate(([a], x)) for a, x in zip((*last, 0), (h, c, d, p, n)))
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        head = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        later = (d != d[head]) | (p != p[head])
        yield from batch_of(0, h[later], 0, d[later], p[later], n[later])
        at = head[-1]
        if last is not None:
            new[0] = False
        last = (h[at], c[at], d[at], p[at])
        pool = [np.concatenate([a, x[new]]) for a, x in zip(pool, (h, d, p, n))]
        yield from emit(False)
    yield from emit(True)


CONTEXTS = "kind int, h long, part int, d long, p long, n long, units binary"


def _cut_contexts(units: Units):
    """Texts with the list of their runs -> one row for each run, with its units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(0))
            seq, offsets = units.split(data, at)
            runs = batch.column(1)
            flat, per = runs.flatten(), np.diff(np.asarray(runs.offsets))
            fields = {f.name: flat.field(i) for i, f in enumerate(flat.type)}
            p, n = longs(fields["p"]), longs(fields["n"])
            begin = offsets[np.repeat(np.arange(len(per)), per)] + (p & (2**31 - 1))
            size = n + units.window - 1
            # In slices, as the contexts of a text repeated within itself can exceed a batch.
            for i in range(0, len(p), 20_000):
                s, ends = size[i : i + 20_000], np.cumsum(size[i : i + 20_000])
                take = np.arange(ends[-1]) + np.repeat(begin[i : i + 20_000] - (ends - s), s)
                body = np.ascontiguousarray(seq[take])
                column = pa.Array.from_buffers(pa.binary(), len(s), [None, pa.py_buffer(np.concatenate(([0], ends * body.dtype.itemsize)).astype(np.int32)), pa.py_buffer(body)])
                yield pa.RecordBatch.from_arrays([*(fields[f].slice(i, 20_000) for f in ("kind", "h", "part", "d", "p", "n")), column], ["kind", "h", "part", "d", "p", "n", "units"])

    return run


REPEATED = "d long, p long, n long, w binary"


def _index_blocks(units: Units, dtype: type):
    """Contexts sorted by (h, part) -> repeated starts (w null), and first windows of dealt anchors (w their hash)."""

    def solve(rows: list[tuple[np.ndarray, ...]], bodies: list[np.ndarray]) -> pa.RecordBatch:
        kind, d, p, n = (np.concatenate([r[i] for r in rows]) for i in range(4))
        seq = np.concatenate(bodies)
        size = n + units.window - 1
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        classes = units.classes(seq, begin, n)
        owner = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        dd, pp, kk = d[owner], p[owner] + inside, kind[owner]
        order = np.lexsort((pp, dd, classes))
        cc = classes[order]
        new = np.ones(len(order), bool)
        new[1:] = cc[1:] != cc[:-1]
        head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        later = (dd[order] != dd[head]) | (pp[order] != pp[head])
        rep = np.sort(order[later])
        by = np.lexsort((pp[rep], dd[rep]))
        rd, rp, rn = _merged(dd[rep][by], pp[rep][by], np.ones(len(rep), np.int64))
        first = order[new]
        first = first[kk[first] == 2]
        at = begin[owner[first]] + inside[first]
        values = units.values(seq)
        one, two = span_hashes(values, at, at + units.window), span_hashes(mix(values), at, at + units.window)
        marks = np.stack([one, two], axis=1).tobytes()
        cols = [np.concatenate(x) for x in ((rd, dd[first]), (rp, pp[first]), (rn, np.ones(len(first), np.int64)))]
        w = pa.array([None] * len(rd) + [marks[16 * i : 16 * i + 16] for i in range(len(first))], pa.binary())
        return pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in cols], w], ["d", "p", "n", "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, bodies, size, key = [], [], 0, None
        for batch in batches:
            h, part = longs(batch.column(1)), longs(batch.column(2))
            data, at = utf8(batch.column(6))
            columns = [longs(batch.column(i)) for i in (0, 3, 4, 5)]
            seq = data.view(dtype)
            at = at // np.dtype(dtype).itemsize
            edge = np.flatnonzero((h[1:] != h[:-1]) | (part[1:] != part[:-1])) + 1
            lo = 0
            for hi in [*edge.tolist(), len(h)]:
                now = (h[lo], part[lo]) if lo < len(h) else key
                if size >= BLOCK_UNITS and now != key:
                    yield solve(rows, bodies)
                    rows, bodies, size = [], [], 0
                rows.append(tuple(x[lo:hi] for x in columns))
                bodies.append(seq[at[lo] : at[hi]].copy())
                size += int(at[hi] - at[lo])
                key, lo = now, hi
        if rows:
            yield solve(rows, bodies)

    return run


def repeated_starts(docs: DataFrame, units: Units, dtype: type) -> DataFrame:
    """For each document (d: id, x: CRC-32 of the text) with repeated windows: spans, the list of (p: start, n: starts)."""
    small_batches(docs.sparkSession)
    texts = _keyed(docs)
    runs = texts.mapInArrow(_run_rows(units), RUNS)
    # One row for about 40 bytes, of 40 bytes: rows meet by anchor and are sorted within their task, on disk where they must.
    found = stored(runs.repartition("h").sortWithinPartitions("h", "c", "d", "p").mapInArrow(_resolve, FOUND), "found")
    del runs
    release(docs.sparkSession)
    here = F.shiftright("p", 31).alias("x")
    lists = found.where("kind > 0").groupBy("d", here).agg(F.collect_list(F.struct("kind", "h", "part", "d", "p", "n")).alias("runs"))
    cut = texts.join(lists.hint("merge"), ["d", "x"]).select("text", "runs").mapInArrow(_cut_contexts(units), CONTEXTS)
    indexed = stored(cut.repartition("h", "part").sortWithinPartitions("h", "part").mapInArrow(_index_blocks(units, dtype), REPEATED), "indexed")
    release(docs.sparkSession)
    dealt = indexed.where("w is not null").select("d", "p", "w")
    first = dealt.groupBy("w").agg(F.min(F.struct("d", "p")).alias("first"), F.count("*").alias("k")).where("k > 1")
    over = dealt.join(first, "w").where(F.struct("d", "p") != F.col("first")).select("d", "p", F.lit(1).cast("long").alias("n"))
    spans = found.where("kind = 0").select("d", "p", "n").unionByName(indexed.where("w is null").select("d", "p", "n")).unionByName(over)
    return spans.groupBy("d", F.shiftright("p", 31).alias("x")).agg(F.collect_list(F.struct((F.col("p").bitwiseAND(2**31 - 1)).alias("p"), "n")).alias("spans"))


def _keyed(docs: DataFrame) -> DataFrame:
    """d (id), x (CRC-32 of the text) and text of documents."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("d"), F.crc32(text.cast("binary")).alias("x"), text.alias("text"))


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, text and spans (null: none) of every document."""
    keyed = docs.select("doc_id", *[c.alias(n) for c, n in ((F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), "d"), (F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")), "x"), (F.col("text"), "text"))])
    return keyed.join(spans.hint("merge"), ["d", "x"], "left").select("doc_id", "text", "spans")


def covered(starts: np.ndarray, counts: np.ndarray, window: int, n: int) -> np.ndarray:
    """Which of n units a repeated window covers, from runs of repeated starts."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + counts - 1 + window, -1)
    return np.cumsum(edge[:-1]) > 0
