"""Language identification: averaged hashed subword embeddings under a linear softmax.

Each word, lower-cased with a marker on both sides, gives its character trigrams and fourgrams
(over UTF-8 bytes); each n-gram is hashed to a row of an embedding table, a document is the mean
of its rows and a linear layer with softmax scores the languages. Embeddings and layer are
trained by stochastic gradient descent in numpy. Since the mean and the layer are both linear,
prediction uses their product: one row of class scores for each hash.

Rejection is calibrated on labelled documents kept out of training: a temperature makes the
probabilities match the accuracy, and a document is rejected when its score is under a
threshold that at most ``reject_share`` of them fall below.

The model is trained on at most ``train_documents`` rows with a label (the least of a seeded
hash): a documented bound. Training, calibration and prediction all read whole texts; a text
chosen for training is counted where it is read and sends its hashes with their shares, at most
2**16 of them however long it is.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected;
with no label to learn from, every document is ``und``; equal texts get equal results; null
labels are not learnt from; a row repeated with its id, text and label is learnt once; an empty
table gives no rows; a very long text is scored in pieces cut between words; result columns that
would clash with kept ones get a longer name; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import pieces, utf8
from .ranks import seeded, seeded_sample
from .tables import free_names, small_batches, trim

ROWS_LOG2, DIMENSIONS = 16, 16
UNDETERMINED = "und"
#: Bound of the training sample.
TRAIN_DOCUMENTS = 4_000
#: Bytes after which a text is cut at the next end of a word.
LONG = 1 << 20
_LETTER = regex.compile(r"\p{L}")

# Bytes of words: A-Z lower-cased, letters and everything from 0x80 on kept, the rest a marker.
_FOLD = np.full(256, 0x20, np.uint8)
for _b in range(256):
    if 0x61 <= _b <= 0x7A or _b >= 0x80:
        _FOLD[_b] = _b
    elif 0x41 <= _b <= 0x5A:
        _FOLD[_b] = _b + 32


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of each document: (rows, document of each run, run begins). No n-gram spans two words."""
    n = len(data)
    # One marker before each document and one at the end.
    docs = len(offsets) - 1
    x = np.full(n + docs + 1, 0x20, np.uint32)
    sizes = np.diff(offsets)
    x[np.arange(n) + np.repeat(np.arange(docs), sizes) + 1] = _FOLD[data]
    owner_begin = offsets[:-1] + np.arange(docs)
    with np.errstate(over="ignore"):
        tri = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
        four = (tri[:-1] << np.uint32(8)) | x[3:]
        h3 = (tri * np.uint32(0x9E3779B1)) >> np.uint32(32 - ROWS_LOG2)
        h4 = ((four ^ (four >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(32 - ROWS_LOG2)
    inner = x[1:-1] != 0x20
    ok3 = inner  # its middle is a letter: "_a_", "_ab", "abc", "bc_"
    ok4 = inner[:-1] & inner[1:]
    at3, at4 = np.flatnonzero(ok3), np.flatnonzero(ok4)
    rows = np.concatenate([h3[at3], h4[at4]])
    begins = np.concatenate([np.searchsorted(at3, owner_begin), len(at3) + np.searchsorted(at4, owner_begin)])
    return rows, np.concatenate([np.arange(docs)] * 2), begins


def _sums(table: np.ndarray, rows: np.ndarray, who: np.ndarray, begins: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of table rows and their number, for each document."""
    out, count = np.zeros((docs, table.shape[1])), np.zeros(docs, np.int64)
    ends = np.append(begins[1:], len(rows))
    full = np.flatnonzero(ends > begins)
    if len(full):
        got = np.add.reduceat(table[rows], begins[full], axis=0)
        np.add.at(out, who[full], got)
        np.add.at(count, who[full], (ends - begins)[full])
    return out, count


def cut_long(data: np.ndarray, offsets: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Offsets with texts over ``most`` bytes cut between words (their n-grams stay the same), and the document of each piece."""
    most = most or LONG
    if not (np.diff(offsets) > most).any():
        return offsets, np.arange(len(offsets) - 1)
    ends, owner = [0], []
    for d, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        while hi - lo > most:
            gap, at = None, lo + most
            while at < hi and gap is None:
                stops = np.flatnonzero(_FOLD[data[at : min(at + most, hi)]] == 0x20)
                gap, at = (at + int(stops[0]) if len(stops) else None), at + most
            if gap is None:
                break
            ends.append(gap)
            owner.append(d)
            lo = gap
        ends.append(hi)
        owner.append(d)
    return np.array(ends), np.array(owner)


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray  # hash -> class scores (embeddings times layer)
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        docs = len(offsets) - 1
        total, count = np.zeros((docs, len(self.labels))), np.zeros(docs, np.int64)
        at, owner = cut_long(data, offsets)
        for i, j in pieces(np.diff(at), 1 << 18):
            more, many = _sums(self.table, *subwords(data[at[i] : at[j]], at[i : j + 1] - at[i]), j - i)
            np.add.at(total, owner[i:j], more)
            np.add.at(count, owner[i:j], many)
        return softmax((total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def shares(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed n-grams of one whole text, and the share of its n-grams that each has."""
    at, _ = cut_long(text, np.array([0, len(text)]))
    counts = sum(np.bincount(subwords(text[i:j], np.array([0, j - i]))[0], minlength=1 << ROWS_LOG2) for i, j in zip(at[:-1].tolist(), at[1:].tolist()))
    rows = np.flatnonzero(counts)
    return rows.astype(np.uint16), (counts[rows] / max(1, counts.sum())).astype(np.float32)


def train(grams: list[tuple[np.ndarray, np.ndarray]], labels: list[str], epochs: int = 4, rate: float = 8.0, seed: int = 2, reject_share: float = 0.001) -> Model:
    """Mini-batch SGD on documents as (distinct hashes, shares); a tenth of them calibrates the temperature and the rejection threshold."""
    names = sorted(set(labels))
    y = np.array([names.index(v) for v in labels])
    rng = np.random.Generator(np.random.PCG64(seed))
    order = rng.permutation(len(grams))
    held = order[: len(order) // 10]
    learn = order[len(held) :]
    size, classes = 1 << ROWS_LOG2, len(names)
    emb = (rng.random((size, DIMENSIONS)) - 0.5) / DIMENSIONS
    layer = (rng.random((DIMENSIONS, classes)) - 0.5) / DIMENSIONS
    bias = np.zeros(classes)
    batch, steps, done = 16, max(1, epochs * -(-len(learn) // 16)), 0
    for _ in range(epochs):
        rng.shuffle(learn)
        for b in range(0, len(learn), batch):
            ids = [i for i in learn[b : b + batch] if len(grams[i][0])]
            if not ids:
                continue
            lr = rate * (1 - done / steps)
            done += 1
            sizes = np.array([len(grams[i][0]) for i in ids])
            rows = np.concatenate([grams[i][0] for i in ids]).astype(np.int64)
            share = np.concatenate([grams[i][1] for i in ids])[:, None]
            mean = np.add.reduceat(emb[rows] * share, np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0)
            err = softmax(mean @ layer + bias)
            err[np.arange(len(ids)), y[ids]] -= 1
            back = err @ layer.T
            layer -= lr / len(ids) * mean.T @ err
            bias -= lr / len(ids) * 0.1 * err.sum(axis=0)
            np.subtract.at(emb, rows, lr / len(ids) * np.repeat(back, sizes, axis=0) * share)
    model = Model(names, (emb @ layer).astype(np.float32), bias, 1.0, 0.0)
    use = [i for i in held if len(grams[i][0])]
    if use:
        plain = np.log(np.maximum(softmax(np.stack([grams[i][1] @ model.table[grams[i][0]] for i in use]) + bias), 1e-300))
        grid = np.geomspace(0.05, 20, 60)
        model.temperature = float(min(grid, key=lambda t: -np.log(np.maximum(softmax(plain / t)[np.arange(len(use)), y[use]], 1e-12)).sum()))
        best = softmax(plain / model.temperature).max(axis=1)
        # No more than reject_share of known documents may fall; never above an even bet.
        model.threshold = float(min(0.5, np.quantile(best, reject_share)))
    return model


def sample(docs: DataFrame, learnable: Column, id_col: str, text_col: str, label_col: str, train_documents: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[str]]:
    """Shares and labels of the training rows, in seeded order, so that every run learns the same."""
    rows = docs.where(learnable & F.col(label_col).isNotNull() & (F.coalesce(F.col(text_col), F.lit("")) != ""))
    u = seeded(2, id_col)
    rows = rows.select(F.col(text_col).alias("t"), F.col(label_col).cast("string").alias("l"), u.alias("u"), F.xxhash64(F.col(text_col)).alias("h"))
    # The sample has a fixed bound, so it is broadcast; texts become shares where they are read.
    chosen = seeded_sample(rows.select("u", "h", "l"), "u", train_documents, "h", "l").distinct()

    def lists(batches):
        for batch in batches:
            data, at = utf8(batch.column(0))
            found = [shares(data[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array([r.tobytes() for r, _ in found], pa.binary()), pa.array([s.tobytes() for _, s in found], pa.binary())], ["l", "u", "h", "rows", "shares"])

    got = rows.join(F.broadcast(chosen), ["l", "u", "h"]).select("t", "l", "u", "h").mapInArrow(lists, "l string, u long, h long, rows binary, shares binary")
    got = got.groupBy("u", "h", "l").agg(F.first("rows").alias("rows"), F.first("shares").alias("shares")).toArrow().sort_by([("u", "ascending"), ("h", "ascending"), ("l", "ascending")])
    grams = [(np.frombuffer(r.as_py(), np.uint16), np.frombuffer(s.as_py(), np.float32)) for r, s in zip(got.column("rows"), got.column("shares"))]
    return grams, got.column("l").to_pylist()


def has_letter(text: bytes) -> bool:
    return _LETTER.search(text.decode("utf-8", "replace")) is not None


def identify(docs: DataFrame, learnable: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", train_documents: int = TRAIN_DOCUMENTS, keep: list[str] | None = None, names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """The columns of ``keep`` (by default the id) of every row, then its language, score and whether it is rejected.

    These three are named by ``names``, lengthened where a kept column has the name.
    """
    spark = docs.sparkSession
    small_batches(spark)
    learnable = F.lit(True) if learnable is None else learnable
    grams, labels = sample(docs, learnable, id_col, text_col, label_col, train_documents)
    model = spark.sparkContext.broadcast(train(grams, labels) if labels else None)  # a fixed 2**16 rows
    del grams, labels
    trim()
    keep = [id_col] if keep is None else keep
    place = [c.lower() for c in keep].index(text_col.lower()) if text_col.lower() in [c.lower() for c in keep] else None
    rows = docs.select(*keep) if place is not None else docs.select(*keep, text_col)
    at_text = len(keep) if place is None else place
    schema = docs.select(*keep).schema
    for name, kind in zip(free_names(keep, *names), ("string", "double", "boolean")):
        schema = schema.add(name, kind)
    columns = schema.names

    def run(batches):
        m = model.value
        for batch in batches:
            data, at = utf8(batch.column(at_text))
            n = len(at) - 1
            pred, score = np.full(n, UNDETERMINED, object), np.zeros(n)
            raw = data.tobytes()
            known = np.array([has_letter(raw[at[i] : at[i + 1]]) for i in range(n)], bool)
            if m is not None and n:
                p = m.probabilities(data, at)
                pred[:] = np.array(m.labels, object)[p.argmax(axis=1)]
                score[:] = p.max(axis=1)
            pred[~known], score[~known] = UNDETERMINED, 0.0
            rejected = ~known | (score < (m.threshold if m is not None else 2.0))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(pred, pa.string()), pa.array(score), pa.array(rejected)], columns)

    return rows.mapInArrow(run, schema)


def keep_known(docs: DataFrame, learnable: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """``docs`` without the documents that are rejected, columns unchanged."""
    marked = identify(docs, learnable, id_col, text_col, label_col, keep=docs.columns)
    return marked.where(~F.col(marked.columns[-1])).select(*docs.columns)
