"""Banded alignment of word sequences."""

from __future__ import annotations

import numpy as np


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the common beginning and end, which an optimal alignment matches."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    lead = int(differ[0]) if len(differ) else n
    a, b = a[lead:], b[lead:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    return a[: len(a) - tail], b[: len(b) - tail]


def distance(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edits (insert, delete, replace a word) between a and b, or None if more than ``most``.

    Bit-parallel alignment inside a diagonal band: a column holds the 2 * most + 1 rows next to
    the diagonal as the bits of one integer (whether the cell below is one more, or one less),
    and the band moves down one row with each column. Cells outside cannot be on an alignment
    of ``most`` edits. The distance is followed along the diagonal that ends in the last cell,
    where it never falls, so a pair that is too far apart ends early.
    """
    a, b = _trimmed(a, b)
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if n - m > most:
        return None
    if not m:
        return n
    most = min(most, n)
    width = 2 * most + 1
    mask = (1 << width) - 1
    rows: dict[int, int] = dict.fromkeys(b.tolist(), 0)
    bit = 1
    for w in a.tolist():
        if w in rows:
            rows[w] |= bit
        bit <<= 1
    # Bit r of column j stands for row j + r - most; vertical differences are kept for the next column's rows.
    plus, minus = mask & ~((1 << most) - 1), 0
    end = n - m + most
    edits = n - m
    shift = -most
    for w in b.tolist():
        found = rows[w]
        found = (found >> shift if shift >= 0 else found << -shift) & mask
        diagonal = ((((found & plus) + plus) ^ plus) | found | minus) & mask
        right_plus = minus | (mask & ~(diagonal | plus))
        right_minus = diagonal & plus
        below = diagonal >> 1
        plus = right_minus | (mask & ~(below | right_plus))
        minus = below & right_plus
        if not diagonal >> end & 1:
            edits += 1
            if edits > most:
                return None
        shift += 1
    return edits


def similar(a: np.ndarray, b: np.ndarray, least: float) -> float | None:
    """1 - distance / longer length, or None if under ``least``. Two empty sequences are alike."""
    n = max(len(a), len(b))
    if not n:
        return 1.0
    d = distance(a, b, int((1 - least) * n + 1e-9))
    return None if d is None else 1 - d / n
