"""Substring deduplication of word sequences with an FM-index per shard.

Candidate stretches are dealt to shards so that equal 35-word windows meet (see repeats). A shard indexes its
stretches: suffix array by prefix doubling, Burrows-Wheeler transform, and a wavelet tree (level by level, as
bit vectors packed into machine words with a rank directory). The stretches are then streamed against the
index: backward search gives, for every word, how far back the text up to it also occurs elsewhere (its
matching statistic), and stretches of at least the window's length are reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.llm import repeats
from qaloom.llm.hashing import text_blocks, words_in
from qaloom.session import materialize

SHAPE = repeats.Shape(window=35, gram=6, grid=15)
# Stretches of one index; larger groups are split by the window's own hash.
MOST_TOGETHER = 20_000


class Bits:
    """A bit vector packed into 64-bit words, with the ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])[:-1]
        self.zeros = len(bits) - int(bits.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletTree:
    """Rank of any symbol in a sequence; the nodes of a level lie side by side, zeros before ones."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels, now = [], symbols
        self.shifts = list(range(max(int(size - 1).bit_length(), 1) - 1, -1, -1))
        for shift in self.shifts:
            bit = (now >> shift & 1).astype(np.uint8)
            self.levels.append(Bits(bit))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        # Where a symbol's run begins on the last level.
        self.begin = np.searchsorted(self.order(now), self.order(np.arange(size)))

    def order(self, symbols: np.ndarray) -> np.ndarray:
        """Sort key of a symbol on the last level: its bits in reverse."""
        key = np.zeros(len(symbols), np.int64)
        for k, shift in enumerate(self.shifts):
            key |= (symbols >> shift & 1).astype(np.int64) << k
        return key

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        for bits, shift in zip(self.levels, self.shifts):
            ones = bits.ones(at)
            at = np.where(symbols >> shift & 1, bits.zeros + ones, at - ones)
        return at - self.begin[symbols]


def suffix_array(text: np.ndarray, longest: int) -> np.ndarray:
    """Suffixes in order, compared over their first ``longest`` symbols at least (prefix doubling)."""
    n, rank, step = len(text), text.astype(np.int64), 1
    while True:
        following = np.zeros(n, np.int64)
        if step < n or step == 1:
            following[: max(n - step, 0)] = rank[step:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + following
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]) if n else []
        step *= 2
        if step >= longest or (n and rank[order[-1]] == n - 1):
            return order


class FMIndex:
    """Backward search over concatenated stretches; symbol 0 ends each of them and is never searched."""

    def __init__(self, text: np.ndarray, size: int, longest: int):
        suffixes = suffix_array(text, longest)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        self.tree = WaveletTree(text[suffixes - 1], size)

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
        """For each end (exclusive), the longest stretch of ``text`` up to it that occurs at least twice,
        looking back ``most`` symbols. Searches that become unique are dropped at once."""
        length = np.zeros(len(ends), np.int64)
        alive = np.arange(len(ends))
        symbol = text[ends - 1]
        low, high = self.first[symbol], self.first[symbol + 1]
        for back in range(1, most + 1):
            if back > 1:
                symbol = text[ends[alive] - back]
                both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
                low, high = self.first[symbol] + both[: len(symbol)], self.first[symbol] + both[len(symbol):]
            keep = np.flatnonzero((high - low > 1) & (symbol > 0))
            alive, low, high = alive[keep], low[keep], high[keep]
            length[alive] = back
            if not len(alive):
                break
        return length


def shard_marks(group: np.ndarray, lead: np.ndarray, times: np.ndarray, stretches: list[bytes], shape: repeats.Shape) -> np.ndarray:
    """Marks (stretch, window place) of windows that occur in another stretch of the shard or in copies."""
    sizes = np.array([len(s) // 8 for s in stretches])
    words = np.frombuffer(b"".join(stretches), np.uint64)
    names, dense = np.unique(words, return_inverse=True)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.zeros(begin[-1], np.int64)
    own = np.repeat(np.arange(len(sizes)), sizes)
    text[np.arange(len(words)) + own] = dense + 1
    index = FMIndex(text, len(names) + 1, shape.columns)
    count = sizes - shape.window + 1
    which = np.repeat(np.arange(len(sizes)), count)
    place = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    marks = np.zeros((len(sizes), shape.grid), bool)
    found = np.zeros(len(which), bool)
    for at in range(0, len(which), 1 << 16):  # the stream
        part = slice(at, at + (1 << 16))
        ends = begin[which[part]] + place[part] + shape.window
        found[part] = index.matching_statistics(text, ends, shape.window) >= shape.window
    found |= times[which] > 1
    marks[which[found], place[found] + lead[which[found]]] = True
    return marks


def find_chunks(docs: DataFrame, shape: repeats.Shape, text_col: str) -> DataFrame:
    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keys = part.column(0).to_numpy(zero_copy_only=False)
            for at, data, offsets in text_blocks(part.column(1)):
                _, _, words, first = words_in(data, offsets, lower=False)
                row, start, lead, count, core, context = repeats.chunks(words, first, shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)), pa.array(context.view(np.int64)), pa.array(keys[at + row]), pa.array(start),
                     pa.array(lead.astype(np.int16)), pa.array(count.astype(np.int16))], names=list(repeats.CHUNK_COLUMNS))

    return docs.select("key", text_col).mapInArrow(cut, "core long, context long, key long, start long, lead short, count short")


def read_stretches(docs: DataFrame, contexts: DataFrame, window: int, text_col: str) -> DataFrame:
    """``contexts`` plus ``data``: the word hashes of each stretch, read again from one document each."""

    def read(text: pa.Scalar, start: np.ndarray, count: np.ndarray) -> list[bytes]:
        data = np.frombuffer(text.as_buffer(), np.uint8)
        _, _, words, _ = words_in(data, np.array([0, len(data)]), lower=False)
        return [words[s: s + c - 1 + window].tobytes() for s, c in zip(start.tolist(), count.tolist())]

    return repeats.read_stretches(docs, contexts, read, text_col)


def repeated_words(docs: DataFrame, shape: repeats.Shape = SHAPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, <text>, key, runs``: every row with the word ranges that repeated windows cover (null: none).

    Words are runs of anything but ASCII white space, unchanged. A window of ``shape.window`` words is
    repeated if it also starts anywhere else, in the same text or another. Null texts have no words.
    Repeated rows are occurrences of their own and get equal results. Words are compared by
    64-bit hashes.
    """
    keyed = docs.select(id_col, text_col).withColumn("key", F.xxhash64(id_col, text_col))
    kept, contexts = repeats.repeated_chunks(materialize(find_chunks(keyed, shape, text_col), "chunks"))
    stretches = read_stretches(keyed, contexts, shape.window, text_col)
    hits = repeats.repeated_windows(stretches, shape, shard_marks, MOST_TOGETHER, unit=8)
    runs = materialize(repeats.covered_runs(kept, materialize(hits, "hits"), shape.window), "runs")
    return repeats.with_runs(keyed, runs)


def remove_repeats(docs: DataFrame, shape: repeats.Shape = SHAPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, n_words, n_removed, kept``: the words no repeated window covers, joined by one space."""
    found = repeated_words(docs, shape, id_col, text_col)

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, removed, kept = [], [], []
            for at, data, offsets in text_blocks(part.column(1)):
                starts, ends, _, first = words_in(data, offsets, lower=False)
                text = data.tobytes()
                for k in range(len(offsets) - 1):
                    low, high = int(first[k]), int(first[k + 1])
                    left = np.ones(high - low, bool)
                    for a, b in repeats.merged(part.column(2)[at + k].as_py()):
                        left[a:b] = False
                    chosen = np.flatnonzero(left) + low
                    sizes.append(high - low)
                    removed.append(int((~left).sum()))
                    kept.append(b" ".join(text[a:b] for a, b in zip(starts[chosen].tolist(), ends[chosen].tolist())))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                                             names=[id_col, "n_words", "n_removed", "kept"])

    return found.select(F.col(id_col).cast("long"), text_col, "runs").mapInArrow(
        keep, f"`{id_col}` long, n_words long, n_removed long, kept binary")
