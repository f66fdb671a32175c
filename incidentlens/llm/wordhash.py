"""Hashes of words and of runs of words, for many texts at once in numpy.

A word is a run of bytes other than blank and 9 to 13 (hex 09-0D) of the UTF-8 text.
Hashes are 64 bits: a sum of random values of the bytes times powers of an odd
number, then a finishing mix; runs of words combine those in order."""

from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1
U = np.uint64


def _sequence(seed: int, n: int) -> np.ndarray:
    """The first n values of a splitmix sequence."""
    out, state = [], seed
    for _ in range(n):
        state = (state + 0x9E3779B97F4A7C15) & _MASK
        z = ((state ^ (state >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK
        out.append(z ^ (z >> 31))
    return np.array(out, U)


BYTES = _sequence(1, 256)
BASE = int(_sequence(2, 1)[0]) | 1
RUN = U(int(_sequence(3, 1)[0]) | 1)
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
LOWERED_BYTES = BYTES[LOWER]
_powers = np.ones(1, U)


def powers(n: int) -> np.ndarray:
    """BASE to the powers 0 to n-1, modulo 2**64."""
    global _powers
    while len(_powers) < n:
        _powers = np.concatenate((_powers, _powers * U(pow(BASE, len(_powers), 1 << 64))))
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and which text it is in.  `bounds` are the
    offsets of the texts in `data`."""
    solid = ~BLANK[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edges = bounds[1:-1][bounds[1:-1] < len(data)]
    first[edges] = solid[edges]
    starts = np.flatnonzero(first)
    last = solid.copy()
    last[:-1] &= ~solid[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def word_hashes(data: np.ndarray, starts, ends, lower: bool = False) -> np.ndarray:
    if len(starts) == 0:
        return np.zeros(0, U)
    lens = ends - starts
    from_ = np.cumsum(lens) - lens
    solid = data[np.repeat(starts - from_, lens) + np.arange(int(lens.sum()))]
    place = np.arange(len(solid)) - np.repeat(from_, lens)
    table = LOWERED_BYTES if lower else BYTES
    values = table[solid] * powers(int(lens.max()))[place]
    return mix(np.add.reduceat(values, from_) + lens.astype(U))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words from each one on (the last few have none)."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.zeros(n, U)
    for k in range(length):
        out = out * RUN + hashes[k : k + n]
    return mix(out)


def arrow_texts(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column, and the offsets of its texts in them.
    Nulls are empty."""
    import pyarrow as pa

    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if column.type == pa.large_string() else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]
