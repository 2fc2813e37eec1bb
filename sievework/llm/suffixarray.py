"""Exact substring deduplication of bytes with two-stage suffix arrays.

Only suffixes smaller than their successors are sorted directly (by eight bytes at a time, ties
going on to the next eight); the others are induced by one scan over the first-byte buckets.
Adjacent common prefixes then show which windows are equal. The arrays are built over blocks of
candidate contexts that :mod:`repeats` brings together, not over the corpus.

``dedup`` removes each byte covered by a window of 100 bytes that also starts earlier (in a
smaller doc_id, or in the same document at an earlier start); what is earlier is judged on the
input, not on what is left.

Defined results: a null text is empty; a text under 100 bytes loses nothing; a null doc_id
stands before all others; rows with equal id and text are one document, each returned with the
same result; a text may be of any length (it is handled in pieces, and held whole in one task);
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import BYTE_VALUES, utf8
from .repeats import Units, covered, repeated_starts, with_spans

WINDOW, GRAM = 100, 16


def _keys(text: np.ndarray, pad: int) -> np.ndarray:
    """Eight bytes from each position as a big-endian number, zeros after the end; ``pad`` more positions."""
    x = np.zeros(len(text) + pad + 8, np.uint64)
    x[: len(text)] = text
    for width in (1, 2, 4):
        x[:-width] = (x[:-width] << np.uint64(8 * width)) | x[width:]
    return x[:-8]


def rising(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor (the end is the smallest of all)."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    if n:
        step[-1] = -1
    # Within a stretch of equal bytes the first change after it decides.
    at = np.where(step != 0, np.arange(n), n)
    decided = np.minimum.accumulate(at[::-1])[::-1]
    return step[decided] > 0 if n else np.zeros(0, bool)


def _sort_directly(keys: np.ndarray, which: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``which`` in order of their first ``depth`` bytes."""
    order = which[np.argsort(keys[which], kind="stable")]
    here = keys[order]
    group = np.concatenate(([0], np.cumsum(here[1:] != here[:-1]))) if len(order) else np.zeros(0, np.int64)
    tied = np.arange(len(order))
    for offset in range(8, depth, 8):
        size = np.bincount(group)
        keep = size[group] > 1
        tied, group = tied[keep], group[keep]
        if not len(tied):
            break
        at = order[tied]
        key = keys[at + offset]
        by = np.lexsort((key, group))
        order[tied] = at[by]
        key, group = key[by], group[by]
        group = np.concatenate(([0], np.cumsum((group[1:] != group[:-1]) | (key[1:] != key[:-1]))))
    return order


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """All suffixes of a byte array in order of their first ``depth`` bytes at least (default: wholly)."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    depth = n if depth is None else min(depth, n)
    up = rising(text)
    keys = _keys(text, depth)
    direct = _sort_directly(keys, np.flatnonzero(up), depth)
    if depth == n:
        direct = _shorter_first(text, direct, n)
    cuts = np.searchsorted(text[direct], np.arange(257))
    queues: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(places: np.ndarray, c: int) -> None:
        """Send the predecessors of ``places`` that are larger to their buckets, but for those in bucket ``c``."""
        before = places[places > 0] - 1
        before = before[~up[before]]
        first = text[before]
        rest, first = before[first != c], first[first != c]
        by = np.argsort(first, kind="stable")
        rest, first = rest[by], first[by]
        edge = np.flatnonzero(np.diff(first)) + 1
        for part in np.split(rest, edge) if len(rest) else ():
            queues[text[part[0]]].append(part)

    # How many equal bytes stand right before each position.
    new = np.concatenate(([True], text[1:] != text[:-1]))
    equal = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))

    queues[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        falling = np.concatenate(queues[c]) if queues[c] else np.zeros(0, np.int64)
        if len(falling):
            # Predecessors in the same bucket are larger suffixes with one more of the byte: a stretch of
            # it goes at once, all with one more, then all with two more, each in the order given.
            size = equal[falling] + 1
            more = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            by = np.argsort(more, kind="stable")
            falling = (np.repeat(falling, size) - more)[by]
            out.append(falling)
            induce(falling, c)
        if cuts[c + 1] > cuts[c]:
            own = direct[cuts[c] : cuts[c + 1]]
            out.append(own)
            induce(own, c)
    return np.concatenate(out)


def _shorter_first(text: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    """Padding made a suffix equal to itself with zero bytes after it: of such, the shorter is smaller."""
    raw = text.tobytes()
    for i in range(1, len(order)):
        j = i
        while j and order[j - 1] < order[j] and raw[order[j - 1] : order[j - 1] + n - order[j]] == raw[order[j] :]:
            order[j - 1], order[j] = order[j], order[j - 1]
            j -= 1
    return order


def common_prefixes(text: np.ndarray, places: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each place's suffix and the one before it in ``places``, counted up to ``most`` bytes."""
    out = np.zeros(len(places), np.int64)
    if len(places) < 2:
        return out
    keys = _keys(text, most)
    left = np.arange(1, len(places))
    for offset in range(0, most, 8):
        x = keys[places[left - 1] + offset] ^ keys[places[left] + offset]
        differ = x != 0
        # Leading zero bytes of the difference are equal bytes.
        equal = np.zeros(len(x), np.int64)
        for b in range(7, 0, -1):
            equal += (x >> np.uint64(8 * (8 - b))) == 0
        out[left] += np.where(differ, equal, 8)
        left = left[~differ]
    ends = len(text) - np.maximum(places[1:], places[:-1])
    out[1:] = np.minimum(np.minimum(out[1:], ends), most)
    return out


def window_classes(text: np.ndarray, begin: np.ndarray, counts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For starts begin[i] .. begin[i] + counts[i] - 1: a number that equal windows share."""
    owner = np.full(len(text), -1, np.int64)
    total = int(counts.sum())
    starts = np.arange(total) + np.repeat(begin - (np.cumsum(counts) - counts), counts)
    owner[starts] = np.arange(total)
    order = suffix_array(text, window)
    order = order[owner[order] >= 0]
    shared = common_prefixes(text, order, window)
    out = np.empty(total, np.int64)
    out[owner[order]] = np.cumsum(shared < window)
    return out


def byte_units(window: int = WINDOW, gram: int = GRAM) -> Units:
    return Units(window, gram, lambda data, at: (data, at), lambda seq: BYTE_VALUES[seq], lambda seq, begin, n: window_classes(seq, begin, n, window))


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary) and kept_sha256 of every document. ``docs`` has doc_id and text."""
    docs = docs.select("doc_id", "text")
    spans = repeated_starts(docs, byte_units(window), np.uint8)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"

    def run(batches):
        for batch in batches:
            data, at = utf8(batch.column(1))
            lists, out = batch.column(2), []
            for i in range(len(at) - 1):
                body = data[at[i] : at[i + 1]]
                found = lists[i].values
                if found is None or not len(found):
                    kept, removed, runs = body.tobytes(), 0, 0
                else:
                    gone = covered(found.field(0).to_numpy(), found.field(1).to_numpy(), window, len(body))
                    kept, removed = body[~gone].tobytes(), int(gone.sum())
                    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(body), removed, runs, kept, hashlib.sha256(kept).hexdigest()))
            kinds = [pa.int64()] * 3 + [pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return with_spans(docs, spans).mapInArrow(run, schema)
