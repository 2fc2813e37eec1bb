"""Toxicity by a factorization machine over hashed terms.

Terms are lower-cased words, their stems, pairs of neighbouring words and repeated ones, hashed to 2**18 slots; a document's
features are its distinct slots. A slot is used if enough training documents hold it and either
it occurs unlike in the two classes (chi-squared) or it does so together with another slot beyond
what both do alone (the contrast of the four cells of a pair, over all pairs of the
``PAIR_TERMS`` slots that most documents hold): the weights of others could only memorise.
Beside linear weights, each slot has a short vector; the product of two terms' vectors is the
weight of their meeting, so an insult that counts only beside a group mention is learnt, and also
two words that tell nothing each alone. Training is AdaGrad on the logistic loss in numpy, on at
most ``train_documents`` labelled rows (the least of a seeded hash): a documented bound. Scoring
reads whole texts.

Defined results: null and empty texts score as a document without terms (the bias alone); rows
without a label are not learnt from; without labels every score is 0; equal texts get equal
scores; a document with several label rows counts once for each; rows repeated with id and text
are learnt from like others, in the order of their texts' hashes where ids tie; an empty table
gives no rows; a very long text is held whole in one task, at about 60 bytes a byte; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import BYTE_VALUES, mix, pieces, span_hashes, utf8, word_hashes, word_spans
from .ranks import seeded, seeded_sample
from .tables import small_batches

SLOTS_LOG2, FACTORS = 18, 8
#: Bound of the training sample.
TRAIN_DOCUMENTS = 12_000
THRESHOLD = 0.3
#: Slots of which all pairs are tested, and the least contrast of a pair, in standard deviations (of two million pairs, chance leaves none) and in shares.
PAIR_TERMS, PAIR_Z, PAIR_CONTRAST = 2048, 6.0, 0.3
#: Stems are a longer word's first so many bytes; numbers of uses that make a term of their own.
STEMS, REPEATS = (5, 6, 7), (2, 3, 5)
_MASK = (1 << SLOTS_LOG2) - 1

# Words: letters, digits and everything from U+0080 on.
_STOPS = np.array([not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80) for b in range(256)])
_VALUES = BYTE_VALUES.copy()
_VALUES[0x41:0x5B] = _VALUES[0x61:0x7B]


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each document: slots, and len + 1 offsets into them."""
    docs = len(offsets) - 1
    lo, hi, per = word_spans(data, offsets, _STOPS)
    words = word_hashes(data, lo, hi, _VALUES)
    who = np.repeat(np.arange(docs), np.diff(per))
    with np.errstate(over="ignore"):
        pairs = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])[who[:-1] == who[1:]] if len(words) else words
    found, owner = [words, pairs], [who, who[:-1][who[:-1] == who[1:]]]
    for n in STEMS:
        long = hi - lo > n
        found.append(mix(span_hashes(data, lo[long], lo[long] + n, _VALUES) + np.uint64(n)))
        owner.append(who[long])
    key = (np.concatenate(found) >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64) | np.concatenate(owner) << SLOTS_LOG2
    key, times = np.unique(key, return_counts=True)
    # A term used again is a term of its own.
    more = [key] + [_again(key[times >= n], n) for n in REPEATS]
    key = np.unique(np.concatenate(more))
    return key & _MASK, np.searchsorted(key, np.arange(docs + 1) << SLOTS_LOG2)


def _again(key: np.ndarray, n: int) -> np.ndarray:
    return key & ~_MASK | (mix((key & _MASK).astype(np.uint64) + np.uint64(n << 40)) >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)


@dataclass
class Machine:
    bias: float
    used: np.ndarray
    linear: np.ndarray
    factors: np.ndarray

    def margins(self, slots: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        keep = self.used[slots]
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
        slots = slots[keep]
        n = np.diff(offsets)
        out = np.full(len(n), self.bias)
        full = np.flatnonzero(n)
        if len(full):
            begin = offsets[full]
            v = self.factors[slots]
            total = np.add.reduceat(v, begin, axis=0)
            squares = np.add.reduceat((v * v).sum(axis=1), begin)
            out[full] += np.add.reduceat(self.linear[slots], begin) + 0.5 * ((total * total).sum(axis=1) - squares)
        return out

    def scores(self, slots: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(slots, offsets), -40, 40)))


def telling(documents: list[np.ndarray], labels: np.ndarray, least: int = 5, chi2: float = 10.83) -> np.ndarray:
    """Slots that at least ``least`` documents hold and whose share differs between the classes (chi-squared, one degree), alone or with another."""
    size, n, ones = 1 << SLOTS_LOG2, len(documents), labels.sum()
    a = np.bincount(np.concatenate([d for d, y in zip(documents, labels) if y] or [np.zeros(0, np.int64)]), minlength=size).astype(float)
    df = np.bincount(np.concatenate(documents), minlength=size).astype(float)
    b, c, d = df - a, ones - a, n - ones - df + a
    with np.errstate(invalid="ignore", divide="ignore"):
        value = n * (a * d - b * c) ** 2 / (df * (n - df) * ones * (n - ones))
    return (df >= least) & (np.nan_to_num(value) >= chi2) | _meeting(documents, labels, df, least)


def _meeting(documents: list[np.ndarray], labels: np.ndarray, df: np.ndarray, least: int) -> np.ndarray:
    """Slots of pairs whose meeting changes the share of positives beyond what both terms do alone."""
    n, out = len(documents), np.zeros(len(df), bool)
    common = np.argsort(-df, kind="stable")[:PAIR_TERMS]
    # A term that nearly all documents hold has no cell without it.
    common = common[(df[common] >= least) & (df[common] <= n - least)]
    size = len(common)
    place = np.full(len(df), -1)
    place[common] = np.arange(size)
    both, good = np.zeros((size, size), np.float32), np.zeros((size, size), np.float32)
    for at in range(0, n, 512):
        x = np.zeros((min(512, n - at), size), np.float32)
        for row, document in zip(x, documents[at : at + 512]):
            here = place[document]
            row[here[here >= 0]] = 1
        both += x.T @ x
        x = x[labels[at : at + 512] > 0]
        good += x.T @ x
    share, held, ones = labels.mean() if n else 0.0, np.diag(both).copy(), np.diag(good).copy()
    for i in range(size):
        # Documents and positives of the four cells: both, the first, the second, neither.
        cells = np.stack([both[i], held[i] - both[i], held - both[i], n - held[i] - held + both[i]])
        hits = np.stack([good[i], ones[i] - good[i], ones - good[i], labels.sum() - ones[i] - ones + good[i]])
        enough = (cells >= least).all(axis=0)
        rate = hits[:, enough] / cells[:, enough]
        spread = np.sqrt(max(share * (1 - share), 1e-9) * (1 / cells[:, enough]).sum(axis=0))
        found = np.flatnonzero(enough)[np.abs(rate[0] - rate[1] - rate[2] + rate[3]) > PAIR_Z * spread]
        if len(found):
            out[common[found]] = out[common[i]] = True
    return out


def train(documents: list[np.ndarray], labels: np.ndarray, epochs: int = 15, rate: float = 0.2, decay: float = 1e-3, seed: int = 6) -> Machine:
    """AdaGrad on single documents' gradients, in seeded order, with weight decay."""
    rng = np.random.Generator(np.random.PCG64(seed))
    size = 1 << SLOTS_LOG2
    used = telling(documents, labels)
    linear, factors = np.zeros(size), np.zeros((size, FACTORS))
    factors[used] = rng.normal(0, 0.05, (int(used.sum()), FACTORS))
    g_linear, g_factors, g_bias = np.ones(size), np.ones((size, FACTORS)), 1.0
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    documents = [d[used[d]] for d in documents]
    order = np.arange(len(documents))
    for _ in range(epochs):
        rng.shuffle(order)
        for i in order:
            s = documents[i]
            v = factors[s]
            total = v.sum(axis=0)
            z = bias + linear[s].sum() + 0.5 * ((total * total).sum() - (v * v).sum())
            err = 1 / (1 + np.exp(-min(max(z, -40), 40))) - labels[i]
            g_bias += err * err
            bias -= rate * err / np.sqrt(g_bias)
            if len(s):
                d = err + decay * linear[s]
                g_linear[s] += d * d
                linear[s] -= rate * d / np.sqrt(g_linear[s])
                dv = err * (total - v) + decay * v
                g_factors[s] += dv * dv
                factors[s] -= 0.5 * rate * dv / np.sqrt(g_factors[s])
    return Machine(float(bias), used, linear.astype(np.float32), factors.astype(np.float32))


def score(docs: DataFrame, labels: DataFrame, learnable: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """doc_id, score and predicted for every row of ``docs``; learns from the rows of ``labels`` (id and label) that are ``learnable``."""
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (F.lit(True) if learnable is None else learnable))
    known = known.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("l"), seeded(6, id_col).alias("u"))
    chosen = seeded_sample(known, "u", train_documents, "_id", "l")
    # The sample has a fixed bound, so it is broadcast; texts become term lists where they are read.
    got = docs.select(id_col, text_col).join(F.broadcast(chosen), F.col(id_col) == F.col("_id")).select(F.col(text_col).alias("t"), "l", "u", F.xxhash64(F.col(text_col)).alias("h"))

    def lists(batches):
        for batch in batches:
            slots, at = terms(*utf8(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(slots, pa.int32())), *batch.columns[1:]], ["s", "l", "u", "h"])

    rows = got.mapInArrow(lists, "s array<int>, l int, u long, h long").toArrow().sort_by([("u", "ascending"), ("l", "ascending"), ("h", "ascending")])
    machine = None
    if rows.num_rows:
        found = rows.column("s").combine_chunks()
        documents = [np.asarray(x.values, np.int64) if x.values is not None else np.zeros(0, np.int64) for x in found]
        machine = train(documents, rows.column("l").to_numpy().astype(float))
    shared = spark.sparkContext.broadcast(machine)  # a fixed 2**18 slots
    schema = docs.select(F.col(id_col).alias("doc_id")).schema.add("score", "double").add("predicted", T.IntegerType())

    def run(batches):
        m = shared.value
        for batch in batches:
            data, at = utf8(batch.column(1))
            out = np.zeros(len(at) - 1)
            if m is not None:
                for i, j in pieces(np.diff(at), 1 << 18):
                    out[i:j] = m.scores(*terms(data[at[i] : at[j]], at[i : j + 1] - at[i]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out), pa.array((out >= THRESHOLD).astype(np.int32))], schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` modulo ``parts`` (a null id as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts == part
