"""Media columns: texts as greyscale PNG images, read back and hashed by their low frequencies.

A payload (UTF-8 bytes, then bytes 255 up to a positive multiple of ``WIDTH * 24``) becomes the
samples of an 8-bit greyscale PNG ``WIDTH`` wide. Rows are filtered, compressed with zlib and
stored in chunks with their CRC-32. Reading checks the signature, every chunk's checksum, the
sizes and the filter bytes, then undoes the filters in numpy. The feature is a 64-bit hash of
the lowest 8 by 8 cosine-transform coefficients of the image reduced to 32 by 32, against their median.

Defined results: null and empty texts are one block of padding; equal texts give equal values;
a long text is one image of as many rows as it needs (at most 2**31 - 1, a PNG's limit), made in
one task; repeated rows are rows like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import utf8
from .tables import small_batches

#: Samples of a row; 24 rows make the unit of 576.
WIDTH = 24
UNIT = 576
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Compressed bytes of one IDAT chunk.
CHUNK = 1 << 20


class BadImage(ValueError):
    """A stored image that fails a check."""


def payload_of(text: bytes) -> bytes:
    return text + b"\xff" * (max(1, -(-len(text) // UNIT)) * UNIT - len(text))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(body, zlib.crc32(kind)))


def encode(payload: bytes, width: int = WIDTH) -> bytes:
    """An 8-bit greyscale PNG whose samples are the payload; rows take the filter (none, sub, up) of least absolute sum."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, width)
    left, above = np.zeros_like(rows), np.zeros_like(rows)
    left[:, 1:], above[1:] = rows[:, :-1], rows[:-1]
    made = np.stack([rows, rows - left, rows - above])
    size = np.abs(made.view(np.int8).astype(np.int16)).sum(axis=2)
    # Text compresses best unfiltered; a filter is worth it only where it nearly empties a row.
    best = np.where(size.min(axis=0) < size[0] // 8, size.argmin(axis=0), 0)
    out = np.empty((len(rows), width + 1), np.uint8)
    out[:, 0] = best
    out[:, 1:] = made[best, np.arange(len(rows))]
    body = zlib.compress(out.tobytes(), 1)
    head = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + b"".join(_chunk(b"IDAT", body[i : i + CHUNK]) for i in range(0, len(body), CHUNK)) + _chunk(b"IEND", b"")


def _unfilter(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Undo PNG filters 0 to 4 for samples of one byte; runs of one kind go together where they can."""
    out = rows.copy()
    n, width = rows.shape
    edges = np.concatenate(([0], np.flatnonzero(np.diff(kinds)) + 1, [n])) if n else np.zeros(1, int)
    for lo, hi in zip(edges[:-1], edges[1:]):
        kind = kinds[lo]
        prior = out[lo - 1] if lo else np.zeros(width, np.uint8)
        if kind == 1:
            np.cumsum(rows[lo:hi], axis=1, dtype=np.uint8, out=out[lo:hi])
        elif kind == 2:
            out[lo:hi] = np.cumsum(np.vstack([prior, rows[lo:hi]]), axis=0, dtype=np.uint8)[1:]
        elif kind in (3, 4):
            for y in range(lo, hi):
                above, now = (out[y - 1] if y else np.zeros(width, np.uint8)).tolist(), rows[y].tolist()
                a = c = 0
                for x in range(width):
                    b = above[x]
                    if kind == 3:
                        a = (now[x] + (a + b) // 2) & 255
                    else:
                        p = a + b - c
                        pa_, pb, pc_ = abs(p - a), abs(p - b), abs(p - c)
                        a = (now[x] + (a if pa_ <= pb and pa_ <= pc_ else b if pb <= pc_ else c)) & 255
                    c = b
                    now[x] = a
                out[y] = now
    return out


def decode(image: bytes) -> np.ndarray:
    """The samples (rows, width) of an 8-bit greyscale PNG; raises BadImage where a check fails."""
    if image[:8] != SIGNATURE:
        raise BadImage("signature")
    at, size, body, ended = 8, None, [], False
    while at < len(image) and not ended:
        if at + 12 > len(image):
            raise BadImage("a chunk is cut off")
        (n,), kind = struct.unpack_from(">I", image, at), image[at + 4 : at + 8]
        data, crc = image[at + 8 : at + 8 + n], image[at + 8 + n : at + 12 + n]
        if len(crc) < 4 or struct.unpack(">I", crc)[0] != zlib.crc32(data, zlib.crc32(kind)):
            raise BadImage(f"checksum of {kind!r}")
        if size is None and kind != b"IHDR":
            raise BadImage("no header")
        if kind == b"IHDR":
            if n != 13:
                raise BadImage("header size")
            width, height, *form = struct.unpack(">IIBBBBB", data)
            if form != [8, 0, 0, 0, 0]:
                raise BadImage("not 8-bit greyscale without interlace")
            size = (height, width)
        elif kind == b"IDAT":
            body.append(data)
        elif kind == b"IEND":
            ended = True
        elif not kind[0] & 32:
            raise BadImage(f"critical chunk {kind!r}")
        at += 12 + n
    if size is None or not ended:
        raise BadImage("no header or no end")
    try:
        raw = zlib.decompress(b"".join(body))
    except zlib.error as e:
        raise BadImage(str(e)) from None
    if len(raw) != size[0] * (size[1] + 1):
        raise BadImage("sample count")
    rows = np.frombuffer(raw, np.uint8).reshape(size[0], size[1] + 1)
    if size[0] and rows[:, 0].max() > 4:
        raise BadImage("filter type")
    return rows[:, 1:].copy() if not rows[:, 0].any() else _unfilter(rows[:, 0], rows[:, 1:])


_SIDE, _LOW = 32, 8
_COSINES = np.cos(np.pi * (2 * np.arange(_SIDE)[None, :] + 1) * np.arange(_LOW)[:, None] / (2 * _SIDE))


def _averages(size: int) -> tuple[np.ndarray, np.ndarray]:
    lo = np.arange(_SIDE) * size // _SIDE
    return lo, np.maximum(lo + 1, (np.arange(_SIDE) + 1) * size // _SIDE)


def feature_of(samples: np.ndarray) -> str:
    """16 hex digits: which of the 64 lowest cosine coefficients of the 32 by 32 reduction exceed their median."""
    (y0, y1), (x0, x1) = _averages(samples.shape[0]), _averages(samples.shape[1])
    down = np.zeros((samples.shape[0] + 1, samples.shape[1]))
    np.cumsum(samples, axis=0, dtype=np.float64, out=down[1:])
    rows = (down[y1] - down[y0]) / (y1 - y0)[:, None]
    across = np.zeros((_SIDE, samples.shape[1] + 1))
    np.cumsum(rows, axis=1, out=across[:, 1:])
    small = (across[:, x1] - across[:, x0]) / (x1 - x0)
    low = np.round(_COSINES @ small @ _COSINES.T, 6).ravel()
    return np.packbits(low > np.median(low)).tobytes().hex()


def media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, the stored PNG (``media``), and the payload's digests and feature as read back from it."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ["doc_id", "n_bytes", "media", "payload_bytes", "payload_sha256", "tail_crc32", "media_sha256", "feature"]
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_sha256 string, feature string"

    def run(batches):
        for batch in batches:
            data, at = utf8(batch.column(1))
            raw, out = data.tobytes(), []
            for i in range(len(at) - 1):
                image = encode(payload_of(raw[at[i] : at[i + 1]]))
                samples = decode(image)
                back = samples.tobytes()
                out.append((int(at[i + 1] - at[i]), image, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), hashlib.sha256(image).hexdigest(), feature_of(samples)))
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]], names)

    return rows.mapInArrow(run, schema)


def digest(stored: DataFrame) -> DataFrame:
    return stored.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.octet_length("media").cast("long").alias("media_bytes"), "media_sha256", "feature")
