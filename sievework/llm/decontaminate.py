"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items make one automaton over all items. Every document's
words are streamed through it; the state gives the longest match that ends at each word, its
suffix links give the window of ``window`` words inside it and the items that hold that window.
A document word inside any occurrence of a window is hit. An item of fewer words, but not none,
is one window.

Words: A-Z in lower case, then runs of digits, a-z and all characters from U+0080 on.

A benchmark of more than ``AUTOMATON_WORDS`` words is cut into blocks of items. The driver reads
one block at a time, makes its automaton and sends that; documents are scanned block after block,
what a block hits is written down by text, and the hits of all blocks meet at the end. So neither
the driver nor a task ever holds more than one automaton of that bound (about 200 bytes a word).

Defined results: a null or empty text (or item) has no words; equal items each count; an item
row repeated with the same id counts once in ``items``; a null item_id is left out of the list
of ids but its windows hit; an empty benchmark hits nothing; equal texts have equal hits, so repeated
rows and ties need no order; an empty table gives no rows. Every word of a text is streamed,
however long it is (it is split in one task, at about 60 bytes a word). Other columns of both
tables are ignored, and ``clean`` keeps those of the documents, whatever their names.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import utf8
from .tables import free_names, small_batches, stored

#: Words of items that one automaton takes (a longer item stands alone); a larger benchmark is cut into several.
AUTOMATON_WORDS = 500_000
_KEEP = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


class Automaton:
    """Generalised suffix automaton of word sequences, with the items that hold each window.

    Most states have one way on: it stands in two flat rows, and only states of several have a
    dictionary. The root's ways stand apart, as they tell at once which words occur at all.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int) -> None:
        self.window = window
        self.root: dict[bytes, int] = {}
        self.word: list[bytes | None] = [None]
        self.to, self.link, self.length = array("i", [0]), array("i", [-1]), array("i", [0])
        self.more: dict[int, dict[bytes, int]] = {}
        known: dict[bytes, bytes] = {}
        items = [(name, [known.setdefault(w, w) for w in words]) for name, words in items]
        # A short item is a window of its own length, in the state of its last word.
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        ends = []
        for name, words in items:
            at = 0
            for w in words:
                at = self._extend(at, w)
            ends.append(at)
        # The items of each window, at the state that the window's string is in.
        # Most are of one item, whose tuple they share.
        self.names: dict[int, tuple[str] | set[str]] = {}
        for (name, words), end in zip(items, ends):
            if 0 < len(words) < window:
                self.short.setdefault(end, []).append((len(words), name))
            at, alone = 0, (name,)
            for i, w in enumerate(words):
                at = self._step(at, w)
                if name is not None and i + 1 >= window:
                    state = self._window_state(at)
                    if name not in (held := self.names.setdefault(state, alone)):
                        self.names[state] = {*held, name} if isinstance(held, tuple) else held
                        self.names[state].add(name)
        # Whether a short item ends on a state's suffix links.
        self.ends_short = bytearray(len(self.word))
        if self.short:
            for at in sorted(range(1, len(self.word)), key=self.length.__getitem__):
                self.ends_short[at] = at in self.short or self.ends_short[self.link[at]]

    def _window_state(self, at: int) -> int:
        while self.length[self.link[at]] >= self.window:
            at = self.link[at]
        return at

    def _step(self, at: int, w: bytes) -> int | None:
        if not at:
            return self.root.get(w)
        if self.word[at] == w:
            return self.to[at]
        more = self.more.get(at)
        return more.get(w) if more else None

    def _put(self, at: int, w: bytes, to: int) -> None:
        if not at:
            self.root[w] = to
        elif self.word[at] is None or self.word[at] == w:
            self.word[at], self.to[at] = w, to
        else:
            self.more.setdefault(at, {})[w] = to

    def _new(self, length: int, link: int) -> int:
        self.word.append(None)
        self.to.append(0)
        self.link.append(link)
        self.length.append(length)
        return len(self.word) - 1

    def _split(self, last: int, w: bytes, known: int) -> int:
        """The state of ``last``'s string and w, where ``known`` also stands for longer strings: a copy of it for the shorter ones."""
        twin = self._new(self.length[last] + 1, self.link[known])
        self.word[twin], self.to[twin] = self.word[known], self.to[known]
        if known in self.more:
            self.more[twin] = dict(self.more[known])
        self.link[known] = twin
        while last >= 0 and self._step(last, w) == known:
            self._put(last, w, twin)
            last = self.link[last]
        return twin

    def _extend(self, last: int, w: bytes) -> int:
        known = self._step(last, w)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, w, known)
        new, at = self._new(self.length[last] + 1, 0), last
        while at >= 0 and self._step(at, w) is None:
            self._put(at, w, new)
            at = self.link[at]
        if at >= 0:
            other = self._step(at, w)
            self.link[new] = other if self.length[other] == self.length[at] + 1 else self._split(at, w, other)
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans [begin, end) of hit words, in order and possibly overlapping, and the ids of the items hit."""
        root, word, to, more, link, length, window, ends_short = self.root, self.word, self.to, self.more, self.link, self.length, self.window, self.ends_short
        at = matched = 0
        spans: list[tuple[int, int]] = []
        states: set[int] = set()
        items: set[str] = set()
        for i, w in enumerate(words):
            if w not in root:
                at = matched = 0
                continue
            # The longest suffix of what is matched that goes on with this word.
            while at:
                if word[at] == w:
                    at = to[at]
                    break
                if at in more and w in more[at]:
                    at = more[at][w]
                    break
                at = link[at]
                matched = length[at]
            else:
                at = root[w]
            matched += 1
            if matched >= window:
                states.add(self._window_state(at))
                spans.append((i + 1 - window, i + 1))
            if ends_short[at]:
                up = at
                while up > 0 and ends_short[up]:
                    for n, name in self.short.get(up, ()):
                        if n <= matched:
                            spans.append((i + 1 - n, i + 1))
                            if name is not None:
                                items.add(name)
                    up = link[up]
        for s in states:
            items.update(self.names.get(s, ()))
        return spans, items


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, as maximal disjoint spans."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    block, size = [], 0
    for row in benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator():
        words = words_of((row[1] or "").encode())
        if words:
            block.append((row[0], words))
            size += len(words)
        if size >= AUTOMATON_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


SPANS, ITEMS = "array<struct<lo:long,hi:long>>", "array<string>"
_SPANS, _ITEMS = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])), pa.list_(pa.string())


def _found(automaton, text: bytes) -> tuple[int, list[tuple[int, int]], list[str]]:
    words = words_of(text)
    spans, items = automaton.scan(words) if automaton is not None else ([], set())
    return len(words), covered(spans), sorted(items)


def _span_rows(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"lo": lo, "hi": hi} for lo, hi in s] for s in spans], _SPANS)


def _texts(column: pa.Array) -> list[bytes]:
    data, at = utf8(column)
    raw = data.tobytes()
    return [raw[i:j] for i, j in zip(at[:-1].tolist(), at[1:].tolist())]


def _located(docs: DataFrame, text_col: str, benchmark: DataFrame, window: int, item_id: str, item_text: str):
    """``docs``, and how to find the hits of a batch: a list of (words, spans, items).

    With one block it is scanned with the automaton as it comes. With several, ``docs`` have
    two columns more, with what the passes have found.
    """
    spark = docs.sparkSession
    small_batches(spark)
    blocks = _blocks(benchmark, item_id, item_text)
    first, second = next(blocks, None), next(blocks, None)
    place = [c.lower() for c in docs.columns].index(text_col.lower())
    if second is None:
        shared = spark.sparkContext.broadcast(Automaton(first, window) if first else None)
        return docs, lambda batch: [_found(shared.value, t) for t in _texts(batch.column(place))]
    texts = docs.select(F.col(text_col).alias("t"), F.xxhash64(F.lit(1), F.col(text_col)).alias("h"), F.xxhash64(F.lit(2), F.col(text_col)).alias("g"))
    passes = []
    for block in chain([first, second], blocks):
        shared = spark.sparkContext.broadcast(Automaton(block, window))
        first = second = block = None

        def hits(batches, shared=shared):
            for batch in batches:
                got = [_found(shared.value, t) for t in _texts(batch.column(0))]
                hit = pa.array([bool(s) for _, s, _ in got], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), _span_rows([s for _, s, _ in got]), pa.array([x for _, _, x in got], _ITEMS)], ["h", "g", "spans", "items"]).filter(hit)

        # Copies of a text have the same hits.
        found = texts.mapInArrow(hits, f"h long, g long, spans {SPANS}, items {ITEMS}").groupBy("h", "g").agg(F.first("spans").alias("spans"), F.first("items").alias("items"))
        passes.append(stored(found, "hits"))
        shared.destroy()
    every = passes[0]
    for p in passes[1:]:
        every = every.unionByName(p)
    h, g, spans, items = free_names(docs.columns, "_sw_h", "_sw_g", "_sw_spans", "_sw_items")
    every = every.groupBy(F.col("h").alias(h), F.col("g").alias(g)).agg(F.flatten(F.collect_list("spans")).alias(spans), F.flatten(F.collect_list("items")).alias(items))
    keyed = docs.select("*", F.xxhash64(F.lit(1), F.col(text_col)).alias(h), F.xxhash64(F.lit(2), F.col(text_col)).alias(g))
    joined = keyed.join(every, [h, g], "left").select(*docs.columns, spans, items)
    width = len(docs.columns)

    def meet(batch):
        pairs = zip(_texts(batch.column(place)), batch.column(width).to_pylist(), batch.column(width + 1).to_pylist())
        return [(len(words_of(t)), covered([(x["lo"], x["hi"]) for x in s or ()]), sorted(set(i or ()))) for t, s, i in pairs]

    return joined, meet


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, spans (word positions), items (sorted ids) of every document."""
    rows, find = _located(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", benchmark, window, item_id, item_text)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_hit long, spans {SPANS}, items {ITEMS}"

    def run(batches):
        for batch in batches:
            out = find(batch)
            columns = [batch.column(0), pa.array([n for n, _, _ in out], pa.int64()), pa.array([sum(h - l for l, h in s) for _, s, _ in out], pa.int64()), _span_rows([s for _, s, _ in out]), pa.array([x for _, _, x in out], _ITEMS)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_hit", "spans", "items"])

    return rows.mapInArrow(run, schema)


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def _word_bytes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    kept = np.frombuffer(text.translate(_KEEP), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([0], kept.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, most_covered: float = 0.5, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without hit spans; a document of which more than ``most_covered`` of the words are hit goes as a whole.

    A removed span runs from the first byte of its first word to the first byte of the word after
    its last, so the text around it stays as it was. Columns and rows without a hit are unchanged.
    """
    rows, find = _located(docs, text_col, benchmark, window, item_id, item_text)
    schema, place = docs.schema, [c.lower() for c in docs.columns].index(text_col.lower())

    def cut(text: bytes, n: int, spans: list[tuple[int, int]]) -> bytes | None:
        if not spans:
            return text
        if sum(h - l for l, h in spans) > most_covered * n:
            return None
        begin, _ = _word_bytes(text)
        out, at = [], 0
        for l, h in spans:
            out.append(text[at : begin[l]])
            at = begin[h] if h < n else len(text)
        return b"".join(out) + text[at:]

    def run(batches):
        for batch in batches:
            given = batch.column(place).is_valid().to_numpy(zero_copy_only=False)
            texts = [cut(t, n, s) for t, (n, s, _) in zip(_texts(batch.column(place)), find(batch))]
            kept = pa.array([t is not None for t in texts], pa.bool_())
            column = pa.array([t.decode() if t is not None and g else None for t, g in zip(texts, given)], pa.string())
            yield pa.RecordBatch.from_arrays([column if i == place else c for i, c in enumerate(batch.columns[: len(schema)])], schema.names).filter(kept)

    return rows.mapInArrow(run, schema)
