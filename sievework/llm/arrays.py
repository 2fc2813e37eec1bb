"""Arrow columns as numpy buffers, without a Python object for each row."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Words of more bytes are hashed by BLAKE2b.
LONG_WORD = 1024
#: Bytes that end a word: space and 0x09 to 0x0D.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.Generator(np.random.PCG64(20240229))
#: Random odd 64-bit value of each byte, and the odd base of the polynomial hashes (modulo 2**64).
BYTE_VALUES = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 2**64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, and len + 1 offsets into them. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        # Chunks that together pass 2 GB would stay apart in a type of 32-bit offsets.
        wide = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
        column = column.cast(wide).combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if offsets is not None and len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def longs(column: pa.Array, null: int = 0) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return (pc.fill_null(column, null) if column.null_count else column).to_numpy(zero_copy_only=False)


_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse."""
    if len(_POWERS["up"]) < n:
        size = 1 << (n - 1).bit_length()
        with np.errstate(over="ignore"):
            for key, base in (("up", BASE), ("down", _INVERSE)):
                out = np.ones(size, np.uint64)
                out[1:] = U64(base)
                _POWERS[key] = np.multiply.accumulate(out)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (in a new array)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
        x = (x ^ (x >> U64(27))) * U64(0x81DADEF4BC2DD44D)
        return x ^ (x >> U64(33))


#: Values whose prefix sums are held at a time; bounds the tables of powers as well.
PIECE = (1 << 20) - 1


def span_hashes(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each values[lo:hi]; equal spans have equal hashes wherever they stand.

    With ``table``, ``values`` are small numbers that stand for its entries. Long arrays are handled in pieces.
    """
    if len(values) <= PIECE:
        return _piece_hashes(values if table is None else table[values], lo, hi)
    out = np.empty(len(lo), np.uint64)
    order = np.argsort(lo, kind="stable") if len(lo) > 1 and (lo[1:] < lo[:-1]).any() else np.arange(len(lo))
    # The end of a piece is the greatest end of its spans.
    starts, ends = lo[order], np.maximum.accumulate(hi[order])
    i = 0
    while i < len(order):
        j = int(np.searchsorted(ends, starts[i] + PIECE, "right"))
        if j <= i:
            out[order[i]] = _long_hash(values, int(lo[order[i]]), int(hi[order[i]]), table)
            i += 1
            continue
        here, base = order[i:j], starts[i]
        part = values[base : ends[j - 1]]
        out[here] = _piece_hashes(part if table is None else table[part], lo[here] - base, hi[here] - base)
        i = j
    return out


def _piece_hashes(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    up, down = powers(len(values) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=total[1:])
        return _closed((total[hi] - total[lo]) * down[lo], hi - lo)


def _long_hash(values: np.ndarray, lo: int, hi: int, table: np.ndarray | None) -> np.uint64:
    total = np.zeros(1, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(lo, hi, PIECE):
            part = values[at : min(at + PIECE, hi)]
            part = part if table is None else table[part]
            total += (part * powers(len(part))[0]).sum(dtype=np.uint64) * U64(pow(BASE, at - lo, 2**64))
    return _closed(total, np.array([hi - lo]))[0]


def _closed(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(sums + lengths.astype(np.uint64) * U64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word, through ``table``.

    Polynomials modulo 2**64 can be made to collide by words of two thousand bytes and more
    (Thue and Morse's sequence), so a long word is hashed by BLAKE2b.
    """
    out = span_hashes(data, lo, hi, table)
    for i in np.flatnonzero(hi - lo > LONG_WORD).tolist():
        digest = hashlib.blake2b(digest_size=8)
        for at in range(int(lo[i]), int(hi[i]), PIECE):
            digest.update(table[data[at : min(at + PIECE, int(hi[i]))]].tobytes())
        out[i] = int.from_bytes(digest.digest(), "little")
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, stops: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of bytes not in ``stops``, within each document, and len + 1 offsets into them by document."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~stops[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    lo, hi = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return lo, hi, np.searchsorted(lo, offsets)


def pieces(counts: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of documents [i, j) whose counts sum to about ``most``; a larger document stands alone."""
    out, i, n = [], 0, len(counts)
    total = np.concatenate(([0], np.cumsum(counts)))
    while i < n:
        j = max(i + 1, int(np.searchsorted(total, total[i] + most, "right")) - 1)
        out.append((i, j))
        i = j
    return out
