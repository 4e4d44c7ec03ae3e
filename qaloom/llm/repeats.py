"""Repeated windows of a fixed length: which parts of which rows can hold one, dealt so that equal windows meet.

Every window of ``window`` symbols picks an anchor: its run of ``gram`` symbols with the smallest hash, the
leftmost of equals. Equal windows pick the same anchor. Windows of one row with one anchor, cut at a grid
counted from the anchor, form a chunk; all windows of a chunk share its core of
``window - grid + 1`` symbols. Equal windows lie in chunks with equal cores and at equal places there, so only
chunks whose core occurs twice matter, and they can be compared column by column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.llm.hashing import mix, run_hashes, sums
from qaloom.session import checked_broadcast, materialize

_PLACE = (1 << 20) - 1
_MOST = 1 << 19
# Bits of the bitmap that tells which texts may take part: 8 MB.
KEY_BITS = 1 << 26
CHUNK_COLUMNS = ("core", "context", "key", "start", "lead", "count")


@dataclass(frozen=True)
class Shape:
    window: int
    gram: int
    grid: int

    @property
    def columns(self) -> int:
        """Symbols that a chunk spans at most."""
        return self.grid - 1 + self.window


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1: n])


def _chunks(values: np.ndarray, first: np.ndarray, shape: Shape) -> tuple[np.ndarray, ...]:
    n, w, g = len(values), shape.window, shape.grid
    empty = np.zeros(0, np.int64)
    if n < w:
        return empty, empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    total = sums(values)
    at = np.arange(n - shape.gram + 1)
    grams = run_hashes(total, at, at + shape.gram)
    anchor = (sliding_least((grams & ~np.uint64(_PLACE)) | at.astype(np.uint64), w - shape.gram + 1) & np.uint64(_PLACE)).astype(np.int64)
    start = np.arange(n - w + 1)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = row[: n - w + 1] == row[w - 1:]
    start, anchor, row = start[whole], anchor[whole], row[: n - w + 1][whole]
    cut = (anchor - start) // g
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (cut[1:] != cut[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(start)))
    begin, row, anchor, cut = start[begin], row[new], anchor[new], cut[new]
    earliest, latest = anchor - (cut + 1) * g + 1, anchor - cut * g
    lead = begin - earliest
    core = mix(run_hashes(total, latest, earliest + w) + cut.astype(np.uint64))
    context = mix(run_hashes(total, begin, begin + count - 1 + w) + (lead * g + count).astype(np.uint64))
    return row, begin - first[row], lead, count, core, context


def chunks(values: np.ndarray, first: np.ndarray, shape: Shape) -> tuple[np.ndarray, ...]:
    """(row, start in the row, lead, count, core hash, context hash) of all chunks of the rows.

    ``values``: mixed hashes of symbols. ``count`` windows start at ``start``; ``lead`` is their place
    on the chunk's grid. Work is cut into bounded pieces; a long row into pieces that overlap.
    """
    parts, row = [], 0
    while row < len(first) - 1:
        stop = max(row + 1, int(np.searchsorted(first, first[row] + _MOST, "right")) - 1)
        begin, end = int(first[row]), int(first[stop])
        if end - begin <= _PLACE:
            found = _chunks(values[begin:end], first[row: stop + 1] - begin, shape)
            parts.append((found[0] + row, *found[1:]))
        else:  # one long row
            for at in range(begin, end, _MOST):
                piece = values[at: min(at + _MOST + shape.window - 1, end)]
                found = _chunks(piece, np.array([0, len(piece)]), shape)
                parts.append((found[0] + row, found[1] + (at - begin), *found[2:]))
        row = stop
    return tuple(np.concatenate(c) for c in zip(*parts)) if parts else _chunks(values[:0], np.zeros(1, np.int64), shape)


def repeated_chunks(found: DataFrame, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """From all chunks (CHUNK_COLUMNS): those whose core occurs more than once, and their distinct contexts.

    The second table has one row for each (core, context): how often it occurs (``times``) and where one
    occurrence is. Copies are counted before anything else moves, so a passage that a
    third of all rows share is one row. With ``most``, cores of more chunks than that go to every task (as far
    as they fit), so that no task gets all chunks of a common core; at most one core in ``most`` chunks is.
    """
    often = found.groupBy("core").agg(F.count("*").alias("_n")).where("_n > 1")
    if most is None:
        met = found.join(often.select("core"), "core")
    else:
        often = materialize(often, "often")
        common = checked_broadcast(often.where(F.col("_n") > most).select("core"))
        rest = often.where(F.col("_n") <= most).select("core")
        met = found.join(common, "core", "left_semi").unionByName(found.join(common, "core", "left_anti").join(rest, "core"))
    kept = materialize(met, "repeated")
    place = F.min(F.struct("key", "start", "lead", "count")).alias("_at")
    distinct = kept.groupBy("core", "context").agg(F.count("*").alias("times"), place)
    return kept, materialize(distinct.select("core", "context", "times", "_at.*"), "contexts")


def read_stretches(docs: DataFrame, contexts: DataFrame, read: Callable, text_col: str) -> DataFrame:
    """``contexts`` plus ``data``: their stretches, read again from one document each (``key`` and text in
    ``docs``). ``read(text, starts, counts)`` returns their bytes."""
    wanted = contexts.groupBy("key").agg(F.collect_list(F.struct("core", "context", "times", "start", "lead", "count")).alias("_chunks"))
    wanted = materialize(wanted, "wanted")
    likely = marked(docs.select("key", text_col), wanted).where("_likely")
    met = likely.join(wanted, "key").select(F.col(text_col).cast("binary"), "_chunks")
    names = ["core", "context", "times", "lead", "data"]

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for text, items in zip(part.column(0), part.column(1)):
                chunk = items.values
                pieces = read(text, chunk.field("start").to_numpy(), chunk.field("count").to_numpy())
                yield pa.RecordBatch.from_arrays([*(chunk.field(c) for c in names[:4]), pa.array(pieces, pa.binary())], names=names)

    # Repeated rows share a key: each stretch is kept once.
    return met.mapInArrow(cut, "core long, context long, times long, lead short, data binary").dropDuplicates(["core", "context"])


def _stretch_hits(marks: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, first, last) of runs of marked windows, counted from the stretch's start."""
    wide = np.zeros((len(marks), marks.shape[1] + 2), np.int8)
    wide[:, 1:-1] = marks
    step = np.diff(wide, axis=1)
    k, low = np.nonzero(step == 1)
    _, high = np.nonzero(step == -1)
    return k, low - lead[k], high - 1 - lead[k]


def repeated_windows(stretches: DataFrame, shape: Shape, marks_of: Callable, most: int, unit: int = 1) -> DataFrame:
    """``core, context, low, high``: first and last window of each stretch of repeated windows.

    ``marks_of(group, lead, times, stretches, shape)`` judges whole groups of at most ``most`` distinct
    stretches together; larger groups are judged by the windows' own content. A symbol takes
    ``unit`` bytes of ``data``.
    """
    stretches = materialize(stretches, "stretches")
    sizes = stretches.groupBy("core").agg(F.count("*").alias("_n"))
    large = materialize(sizes.where(F.col("_n") > most).select("core"), "large")
    usual = stretches.join(checked_broadcast(large), "core", "left_anti")

    def build(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(table: pa.Table) -> pa.RecordBatch:
            lead = table.column("lead").to_numpy().astype(np.int64)
            marks = marks_of(table.column("core").to_numpy(), lead, table.column("times").to_numpy(), table.column("data").to_pylist(), shape)
            k, low, high = _stretch_hits(marks, lead)
            return pa.RecordBatch.from_arrays(
                [pa.array(table.column("core").to_numpy()[k]), pa.array(table.column("context").to_numpy()[k]), pa.array(low), pa.array(high)],
                names=["core", "context", "low", "high"])

        held, size = [], 0
        for part in parts:
            held.append(part)
            size += part.num_rows
            if size >= most:
                table = pa.Table.from_batches(held)
                cores = table.column("core").to_numpy()
                # The last group may go on in the next batch.
                done = int(np.searchsorted(cores, cores[-1]))
                if done:
                    yield solve(table.slice(0, done))
                held = table.slice(done).to_batches()
                size -= done
        if size:
            yield solve(pa.Table.from_batches(held))

    wire = "core long, context long, low long, high long"
    built = usual.repartition("core").sortWithinPartitions("core").select("core", "context", "times", "lead", "data").mapInArrow(build, wire)
    return built.unionByName(by_window(stretches.join(checked_broadcast(large), "core", "left_semi"), shape, unit))


def by_window(stretches: DataFrame, shape: Shape, unit: int) -> DataFrame:
    """The same for groups too large for one construction: windows are dealt by place and content, so
    the group is spread out and counted where its rows are before anything is shuffled."""

    def windows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for core, context, times, lead, data in zip(*(part.column(k).to_pylist() for k in range(5))):
                n = len(data) // unit - shape.window + 1
                content = [hashlib.blake2b(data[k * unit: (k + shape.window) * unit], digest_size=16).digest() for k in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([core] * n), pa.array([context] * n), pa.array([times] * n), pa.array([lead + k for k in range(n)]),
                                                  pa.array(range(n)), pa.array(content)], names=["core", "context", "times", "place", "at", "content"])

    each = stretches.select("core", "context", "times", F.col("lead").cast("long"), "data").mapInArrow(
        windows, "core long, context long, times long, place long, at long, content binary")
    often = each.groupBy("core", "place", "content").agg(F.sum("times").alias("n")).where("n > 1")
    met = each.join(often, ["core", "place", "content"])
    return met.select("core", "context", F.col("at").alias("low"), F.col("at").alias("high"))


def covered_runs(kept: DataFrame, hits: DataFrame, window: int) -> DataFrame:
    """``key, runs``: symbol ranges (start, end exclusive) that repeated windows cover, unmerged, per row.

    ``hits``: ``core, context, low, high``, the first and last repeated window of a stretch, counted
    from the chunk's start.
    """
    met = kept.join(hits, ["core", "context"]).select(
        "key", F.struct((F.col("start") + F.col("low")).alias("start"), (F.col("start") + F.col("high") + window).alias("end")).alias("run"))
    return met.groupBy("key").agg(F.sort_array(F.collect_set("run")).alias("runs"))


def marked(docs: DataFrame, keys: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """``docs`` plus ``_likely``: false only for rows whose ``key`` is not in ``keys``.

    A bitmap of hashed keys, of a fixed size whatever the input, goes to every task, so the texts
    of rows that surely take no part are not shuffled. Rows marked by chance fall out of the join after.
    """
    slot = F.pmod(F.xxhash64(F.col("key")), F.lit(bits))
    place = F.bitmap_bit_position(slot)
    maps = materialize(keys.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(F.bitmap_construct_agg(place).alias("_bits")), "bitmap")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.expr("CAST(_place DIV 8 AS INT) + 1"), F.lit(1))), 16, 10).cast("int")
    met = docs.withColumn("_bucket", F.bitmap_bucket_number(slot)).withColumn("_place", place).join(F.broadcast(maps), "_bucket", "left")
    set_ = byte.bitwiseAND(F.expr("CAST(shiftleft(1, CAST(_place % 8 AS INT)) AS INT)")) > 0
    return met.withColumn("_likely", F.coalesce(set_, F.lit(False))).drop("_bucket", "_place", "_bits")


def with_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """``docs`` (with ``key``) plus ``runs``; null for rows without any."""
    both = marked(docs, runs)
    none = both.where(~F.col("_likely")).withColumn("runs", F.lit(None).cast(runs.schema["runs"].dataType))
    return both.where("_likely").join(runs, "key", "left").unionByName(none).drop("_likely")


def merged(runs: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs from sorted, overlapping or touching ones."""
    out: list[list[int]] = []
    for r in runs or []:
        if out and r["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r["end"])
        else:
            out.append([r["start"], r["end"]])
    return [(a, b) for a, b in out]
