"""Arrow string columns as flat byte arrays, and hashes of words computed on whole slices.

Everything here runs inside tasks. A batch is worked on in slices of about ``SLICE`` bytes, so
the memory a task takes follows the longest text and not the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20

_U = np.uint64


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    col = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64, len(col) + 1, col.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows of about ``limit`` bytes."""
    raw, off = texts(column)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """The first ``n`` odd numbers of a reproducible sequence."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


_weights = stream(11, 4096)


def _factors(n: int) -> np.ndarray:
    global _weights
    if n > len(_weights):
        _weights = stream(11, 1 << int(n).bit_length())
    return _weights


def spaced(keep: str) -> np.ndarray:
    """A byte table that lower-cases A-Z and turns what is no word byte into 0.

    ``keep="words"``: all but white space (space and \\t to \\r) is a word byte.
    ``keep="letters"``: ASCII letters, digits and every byte of other characters are.
    """
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    if keep == "words":
        table[[32, *range(9, 14)]] = 0
        table[0] = 65  # a word byte like any other; no other byte is A after lower-casing
    else:
        ascii_ = np.arange(128)
        word = ((ascii_ >= 48) & (ascii_ < 58)) | ((ascii_ >= 65) & (ascii_ < 91)) | ((ascii_ >= 97) & (ascii_ < 123))
        table[:128][~word] = 0
    return table


def word_hashes(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, its first byte, words before each document); words never cross documents."""
    b = table[data]
    word = b != 0
    start = word.copy()
    start[1:] &= ~word[:-1]
    first = off[:-1][off[:-1] < off[1:]]
    start[first] = word[first]
    at = np.flatnonzero(start)
    if not len(at):
        return np.zeros(0, np.uint64), at, np.zeros(len(off), np.int64)
    kept = b[word].astype(np.uint64)
    begins = np.flatnonzero(start[word])
    sizes = np.diff(np.append(begins, len(kept)))
    place = np.arange(len(kept)) - np.repeat(begins, sizes)
    kept *= _factors(int(sizes.max()))[place]
    hashes = mix(np.add.reduceat(kept, begins) + sizes.astype(np.uint64))
    return hashes, at, np.searchsorted(at, off)


_places = stream(23, 64)


def shingles(hashes: np.ndarray, doc: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each document's runs of ``size`` words.

    A document of fewer words has one: its whole sequence. One without words has none.
    """
    n = len(hashes)
    runs = np.zeros(max(0, n - size + 1), np.uint64)
    for j in range(size):
        if len(runs):
            runs += hashes[j:j + len(runs)] * _places[j]
    runs = mix(runs)
    out = []
    for lo, hi in zip(doc[:-1].tolist(), doc[1:].tolist()):
        if hi - lo >= size:
            out.append(np.unique(runs[lo:hi - size + 1]))
        elif hi > lo:
            part = (hashes[lo:hi] * _places[:hi - lo]).sum(dtype=np.uint64) + _U(hi - lo)
            out.append(mix(np.array([part], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
