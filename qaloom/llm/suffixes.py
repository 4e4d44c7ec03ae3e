"""Suffix-array deduplication of byte strings by column-wise construction over many documents.

Candidate stretches are dealt to tasks so that equal 400-byte windows meet at equal places (see repeats). A
task lays its stretches out as columns in an external file and reads it once, from the last column to the
first: each round inserts one symbol per stretch, in the order of what follows it. That order, the
inserted symbols in that order (the collection's Burrows-Wheeler transform, a column a round) and the common
prefixes of neighbours are updated from the round before; neighbours that share 400 symbols mark a
repeated window.

Because stretches are aligned, a round costs as much as it inserts. The unaligned construction gives the
same windows but reads the whole transform again for every symbol of the longest document.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.llm import repeats
from qaloom.llm.hashing import LETTER_HASHES, text_blocks
from qaloom.session import materialize

SHAPE = repeats.Shape(window=400, gram=40, grid=192)
# Stretches that one construction takes; larger groups are split by the window's own hash.
MOST_TOGETHER = 20_000
# Chunks of one core that a join may bring together; those of more frequent cores stay where they are.
MOST_OF_A_CORE = 10_000


def find_chunks(docs: DataFrame, shape: repeats.Shape, text_col: str) -> DataFrame:
    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keys = part.column(0).to_numpy(zero_copy_only=False)
            for at, data, offsets in text_blocks(part.column(1)):
                row, start, lead, count, core, context = repeats.chunks(LETTER_HASHES[data], offsets, shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)), pa.array(context.view(np.int64)), pa.array(keys[at + row]), pa.array(start),
                     pa.array(lead.astype(np.int16)), pa.array(count.astype(np.int16))], names=list(repeats.CHUNK_COLUMNS))

    return docs.select("key", text_col).mapInArrow(cut, "core long, context long, key long, start long, lead short, count short")


def read_stretches(docs: DataFrame, contexts: DataFrame, window: int, text_col: str) -> DataFrame:
    """``contexts`` plus ``data``, the bytes of each stretch, read again from one document each."""

    def read(text: pa.Scalar, start: np.ndarray, count: np.ndarray) -> list[bytes]:
        view = memoryview(text.as_buffer())
        return [bytes(view[s: s + c - 1 + window]) for s, c in zip(start.tolist(), count.tolist())]

    return repeats.read_stretches(docs, contexts, read, text_col)


def construct(group: np.ndarray, lead: np.ndarray, times: np.ndarray, stretches: list[bytes], shape: repeats.Shape) -> np.ndarray:
    """Marks (stretch, window place) of windows that occur in another stretch of the group or in copies.

    Rounds go from the last column to the first. ``order`` sorts the stretches by group and by what
    follows in their columns; ``common[i]`` is how many symbols order[i] shares with order[i - 1].
    """
    n, columns = len(stretches), shape.columns
    marks = np.zeros((n, shape.grid), bool)
    order = np.argsort(group, kind="stable")
    common = np.zeros(n, np.int32)
    _, dense = np.unique(group, return_inverse=True)
    with tempfile.TemporaryFile() as file:
        # One column after another, last first; 0 stands for "outside the stretch" and equals nothing.
        for low in range(0, columns, 64):
            high = min(low + 64, columns)
            block = np.zeros((high - low, n), np.uint16)
            for k, piece in enumerate(stretches):
                a, b = columns - int(lead[k]) - len(piece), columns - int(lead[k])  # columns counted from the last
                x, y = max(a, low), min(b, high)
                if x < y:
                    block[x - low: y - low, k] = np.frombuffer(piece, np.uint8)[::-1][x - a: y - a].astype(np.uint16) + 1
            file.write(block.tobytes())
        file.seek(0)
        for column in range(columns):
            symbols = np.frombuffer(file.read(2 * n), np.uint16)
            inserted = symbols[order]  # the transform's column of this round
            rank = np.argsort(dense[order] * 257 + inserted, kind="stable")
            new_order = order[rank]
            # Neighbours in the new order share one symbol more than the least of what lay between them.
            old_at, same = rank, np.zeros(n, bool)
            same[1:] = (inserted[rank][1:] == inserted[rank][:-1]) & (dense[new_order][1:] == dense[new_order][:-1]) & (inserted[rank][1:] > 0)
            fresh = np.zeros(n, np.int32)
            pairs = np.flatnonzero(same)
            if len(pairs):
                bounds = np.stack([old_at[pairs - 1] + 1, old_at[pairs] + 1], 1).ravel()
                fresh[pairs] = np.minimum.reduceat(np.append(common, 0), bounds)[::2] + 1
            order, common = new_order, fresh
            place = columns - 1 - column
            if place < shape.grid:
                long = common >= shape.window
                hit = long.copy()
                hit[:-1] |= long[1:]
                marks[order[hit], place] = True
    for k in np.flatnonzero(times > 1):
        marks[k, lead[k]: lead[k] + len(stretches[k]) - shape.window + 1] = True
    return marks


def repeated_spans(docs: DataFrame, shape: repeats.Shape = SHAPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, <text>, key, runs``: every row with the byte ranges that repeated windows cover (null: none).

    A window of ``shape.window`` bytes is repeated if it also starts anywhere else, in the same text or
    another. Windows lie within one text; null texts are empty. Repeated rows are occurrences
    of their own and get equal results. Equal windows are recognised by 64-bit hashes of their
    surroundings first and compared symbol by symbol after.
    """
    keyed = docs.select(id_col, text_col).withColumn("key", F.xxhash64(id_col, text_col))
    kept, contexts = repeats.repeated_chunks(materialize(find_chunks(keyed, shape, text_col), "chunks"), MOST_OF_A_CORE)
    hits = repeats.repeated_windows(read_stretches(keyed, contexts, shape.window, text_col), shape, construct, MOST_TOGETHER)
    runs = materialize(repeats.covered_runs(kept, materialize(hits, "hits"), shape.window), "runs")
    return repeats.with_runs(keyed, runs)


def remove_repeats(docs: DataFrame, shape: repeats.Shape = SHAPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, n_bytes, n_removed, n_spans, kept``: texts (binary) without the bytes that repeated windows cover."""
    found = repeated_spans(docs, shape, id_col, text_col)

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, removed, spans, kept = [], [], [], []
            for text, runs in zip(part.column(1), part.column(2).to_pylist()):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                cover = repeats.merged(runs)
                pieces, at = [], 0
                for a, b in cover:
                    pieces.append(data[at:a])
                    at = b
                kept.append(b"".join([*pieces, data[at:]]))
                sizes.append(len(data))
                removed.append(sum(b - a for a, b in cover))
                spans.append(len(cover))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), pa.array(removed), pa.array(spans), pa.array(kept, pa.binary())],
                                             names=[id_col, "n_bytes", "n_removed", "n_spans", "kept"])

    return found.select(F.col(id_col).cast("long"), text_col, "runs").mapInArrow(
        keep, f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept binary")
