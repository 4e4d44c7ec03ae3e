"""Hashes of words and word runs, for whole Arrow batches at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Fixed values of a 64-bit mixing function and an odd multiplier for polynomial hashes.
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15 | 1
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit mix of each value; different salts give independent hashes."""
    x = x + np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


LETTER_HASHES = mix(np.arange(1, 257, dtype=np.uint64), 1)


# One block of text_blocks; longer rows have their powers worked out anew.
KEPT_POWERS = (1 << 20) + 1
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the next call up to a fixed length."""
    have = _POWERS.get(base)
    if have is not None and len(have) >= n:
        return have[:n]
    out = np.ones(max(n, 1), np.uint64)
    filled = 1
    while filled < n:
        take = min(filled, n - filled)
        out[filled: filled + take] = out[:take] * np.uint64(pow(base, filled, 1 << 64))
        filled += take
    if n <= KEPT_POWERS:
        _POWERS[base] = out
    return out[:n]


def sums(values: np.ndarray, base: int = BASE) -> np.ndarray:
    """Prefix sums of values[i] * base**i, one longer than ``values``."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=total[1:])
    return total


def run_hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Mixed hashes of the runs [starts, ends), equal for equal runs wherever they stand."""
    inverse = pow(base, -1, 1 << 64)
    back = powers(inverse, len(total))
    return mix((total[ends] - total[starts]) * back[starts])


def text_blocks(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of consecutive rows of about ``most`` bytes; null rows are empty.

    A longer text is a block of its own.
    """
    texts = texts.fill_null("")
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, data[offsets[row]: offsets[stop]], offsets[row: stop + 1] - offsets[row]
        row = stop


def words_in(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space: (starts, ends, hashes, first word of each row and the end).

    ``lower`` folds A-Z in the hashes. Words do not cross rows.
    """
    gap = SPACES[data]
    # A word starts where a letter follows a gap or begins a row.
    begins = np.zeros(len(data) + 1, bool)
    begins[1:-1] = gap[:-1] & ~gap[1:]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = ~gap[firsts]
    stops = np.zeros(len(data) + 1, bool)
    stops[1:-1] = ~gap[:-1] & gap[1:]
    lasts = offsets[1:][offsets[:-1] < offsets[1:]]
    stops[lasts] |= ~gap[lasts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    letters = LOWER[data] if lower else data
    hashes = run_hashes(sums(LETTER_HASHES[letters]), starts, ends)
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words and each row's first shingle (and the end).

    A row of fewer words, but not none, has one shingle of all its words.
    """
    counts = np.diff(first)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(len(counts)), n)
    at = first[row] + np.arange(begin[-1]) - begin[row]
    stop = np.minimum(at + size, first[row + 1])
    return run_hashes(sums(words), at, stop) if len(at) else np.zeros(0, np.uint64), begin
