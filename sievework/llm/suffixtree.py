"""Exact substring deduplication of words with prefix-partitioned suffix trees.

Suffixes are split by variable-length prefixes: by their first word, and where a prefix has more
suffixes than a group may hold, by one word more, until each group fits in memory. Each group's
subtree is grown level by level: a node's suffixes part by their next word, a suffix alone in its
node is a leaf, and the internal nodes that reach the window's depth are the repeats. The trees
are built over blocks of candidate contexts that :mod:`repeats` brings together.

``dedup`` removes each word covered by a window of 20 words whose sequence also starts earlier
(in a smaller doc_id, or in the same document at an earlier start), judged on the input.

Words are runs of bytes other than space and 0x09 to 0x0D, unchanged. Words are compared by
64-bit hashes (words over 1 024 bytes by BLAKE2b), windows by the sequence of them.

Defined results: a null text has no words; a text under 20 words loses nothing; a null doc_id
stands before all others; rows with equal id and text are one document, each returned with the
same result; a text may be of any length (hashed in pieces; its words are held in one task, at about
60 bytes a word); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import BYTE_VALUES, mix, utf8, word_hashes, word_spans
from .repeats import Units, covered, repeated_starts, with_spans

WINDOW, GRAM = 20, 5
#: Suffixes of one subtree.
GROUP = 1 << 16


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lo, hi, per = word_spans(data, offsets)
    return word_hashes(data, lo, hi, BYTE_VALUES), per


def prefix_groups(codes: np.ndarray, starts: np.ndarray, most: int, limit: int = GROUP) -> Iterator[tuple[int, np.ndarray]]:
    """Suffixes in groups of one common prefix of variable length (in words, up to ``most``), with at most ``limit`` each, or all equal up to ``most``."""
    waiting = [(0, starts)]
    while waiting:
        depth, group = waiting.pop()
        if depth == most or len(group) <= limit and depth:
            yield depth, group
            continue
        word = codes[group + depth]
        by = np.argsort(word, kind="stable")
        edge = np.flatnonzero(np.diff(word[by])) + 1
        small: list[np.ndarray] = []
        for part in np.split(group[by], edge):
            if len(part) > limit:
                waiting.append((depth + 1, part))
            elif len(part) > 1:
                small.append(part)
        # Small prefixes share a group: their subtrees grow together under the common parent.
        held, size = [], 0
        for part in small:
            if size + len(part) > limit and held:
                yield depth, np.concatenate(held)
                held, size = [], 0
            held.append(part)
            size += len(part)
        if held:
            yield depth, np.concatenate(held)


def deep_nodes(codes: np.ndarray, group: np.ndarray, depth: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Grow the subtree of suffixes that share ``depth`` words: those under internal nodes of depth ``most``, and their nodes."""
    node = np.zeros(len(group), np.int64)
    while depth < most and len(group):
        word = codes[group + depth]
        by = np.lexsort((word, node))
        group, node, word = group[by], node[by], word[by]
        new = np.ones(len(group), bool)
        new[1:] = (node[1:] != node[:-1]) | (word[1:] != word[:-1])
        node = np.cumsum(new) - 1
        inner = np.bincount(node)[node] > 1
        group, node = group[inner], node[inner]
        depth += 1
    return group, node


def window_classes(seq: np.ndarray, begin: np.ndarray, counts: np.ndarray, window: int = WINDOW, limit: int = GROUP) -> np.ndarray:
    """For starts begin[i] .. begin[i] + counts[i] - 1: a number that equal windows share."""
    total = int(counts.sum())
    starts = np.arange(total) + np.repeat(begin - (np.cumsum(counts) - counts), counts)
    number = np.full(len(seq), -1, np.int64)
    number[starts] = np.arange(total)
    _, codes = np.unique(seq, return_inverse=True)
    # Leaves are alone in their class.
    out = np.arange(total)
    last = total
    for depth, group in prefix_groups(codes, starts, window, limit):
        places, node = deep_nodes(codes, group, depth, window)
        if len(places):
            out[number[places]] = last + node
            last += int(node.max()) + 1
    return out


def maximal_repeats(seq: np.ndarray, least: int, limit: int = GROUP) -> list[tuple[int, list[int]]]:
    """Repeats of at least ``least`` units of one sequence that neither side can extend: (length, starts)."""
    _, codes = np.unique(seq, return_inverse=True)
    codes = np.concatenate([codes, -1 - np.arange(len(codes) + 1)])
    n, out = len(seq), []
    starts = np.arange(max(0, n - least + 1))
    nodes: list[tuple[int, np.ndarray]] = []
    for depth, group in prefix_groups(codes, starts, least, limit):
        places, node = deep_nodes(codes, group, depth, least)
        nodes += [(least, places[node == k]) for k in range(int(node.max()) + 1 if len(node) else 0)]
    while nodes:
        depth, places = nodes.pop()
        word = codes[places + depth]
        if len(set(word.tolist())) == 1:
            nodes.append((depth + 1, places))
            continue
        left = {int(codes[p - 1]) if p else -p - n - 7 for p in places.tolist()}
        if len(left) > 1:
            out.append((depth, sorted(places.tolist())))
        for w in set(word.tolist()):
            if (word == w).sum() > 1:
                nodes.append((depth + 1, places[word == w]))
    return sorted(out)


def word_units(window: int = WINDOW, gram: int = GRAM) -> Units:
    return Units(window, gram, split_words, mix, lambda seq, begin, n: window_classes(seq, begin, n, window))


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by a space) and kept_sha256 of every document. ``docs`` has doc_id and text."""
    docs = docs.select("doc_id", "text")
    spans = repeated_starts(docs, word_units(window), np.uint64)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, kept string, kept_sha256 string"

    def run(batches):
        for batch in batches:
            data, at = utf8(batch.column(1))
            raw, lists, out = data.tobytes(), batch.column(2), []
            for i in range(len(at) - 1):
                # Bytes split at the same six characters and at no others.
                words = raw[at[i] : at[i + 1]].split()
                found, removed = lists[i].values, 0
                n = len(words)
                if found is not None and len(found):
                    gone = covered(found.field(0).to_numpy(), found.field(1).to_numpy(), window, n)
                    removed = int(gone.sum())
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                kept = b" ".join(words)
                out.append((n, removed, kept.decode(), hashlib.sha256(kept).hexdigest()))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]], ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return with_spans(docs, spans).mapInArrow(run, schema)
