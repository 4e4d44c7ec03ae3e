"""Pattern packing by non-negative least squares.

Token counts of all pieces form a histogram of at most ``max_tokens`` lengths, so planning has a
fixed size whatever the corpus. Patterns of a few lengths that fill a sequence exactly are
enumerated, their repeat counts are fitted to the histogram by non-negative least squares, rounded
within what the histogram holds, and what is left is packed by best fit, many equal sequences at a
time. Pieces then look up their place by their rank among pieces of the same length.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qaloom.llm.common import released
from qaloom.session import materialize

MAX_TOKENS = 2048
# Rows of one length are ranked in this many separate groups, so a hot length is no hot task.
RANK_GROUPS = 1024
_RANK_BITS = 44
# Shares of the fitted repeat counts that are tried, rounded up and down, and when the latter is preferred.
SHARES = (1.0, 0.9, 0.7)
DOWN_SHARES = (1.0, 0.95, 0.8, 0.5, 0.2)
WORTH = 1000


# --- tokens ---------------------------------------------------------------------------------

# Runs beyond this go to the slower library, whose merges are not quadratic in a run's length.
LONG_RUN = re.compile(r"\S{20000}|\s{20000}")
SPECIAL = "<|endoftext|>"


def encoder(vocabulary: str, ranks: str | None = None):
    """text -> token ids of the ``tokenizers`` file ``vocabulary``.

    ``ranks`` names the same vocabulary as a rank file; where given, ordinary texts go through the
    quicker library, which gives the same ids (tests compare them). Texts with the special
    token's string or with very long runs go through ``tokenizers`` in any case.
    """
    loaded = []

    def encode_slow(text: str) -> list[int]:
        if not loaded:  # only where a text needs it
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            loaded.append(Tokenizer.from_file(vocabulary))
        return loaded[0].encode(text, add_special_tokens=False).ids

    if not ranks:
        return encode_slow
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    quick = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def encode(text: str) -> list[int]:
        return encode_slow(text) if SPECIAL in text or LONG_RUN.search(text) else quick.encode_ordinary(text)

    return encode


def cut_pieces(docs: DataFrame, vocabulary: str, ranks: str | None = None, max_tokens: int = MAX_TOKENS,
               end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Token pieces of every row: ``doc_id, piece, start, length, ids_crc32`` and, if asked, ``ids``.

    A row is its token ids and then ``end_id``; null texts count as empty. Rows over ``max_tokens``
    are cut into full pieces, the remainder first. Other columns are dropped; repeated rows are
    rows of their own; a null id stays null.
    """
    fields = [pa.field("doc_id", pa.int64()), pa.field("piece", pa.int32()), pa.field("start", pa.int64()),
              pa.field("length", pa.int64()), pa.field("ids_crc32", pa.int64())]
    if keep_ids:
        fields.append(pa.field("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        for part in parts:
            rows: list[list] = [[] for _ in fields]
            for key, text in zip(part.column(0).to_pylist(), part.column(1)):
                ids = np.array(encode(text.as_py() or "") + [end_id], "<u4")
                at, piece = 0, 0
                while at < len(ids):
                    size = len(ids) % max_tokens or max_tokens if at == 0 else max_tokens
                    chunk = ids[at:at + size]
                    values = (key, piece, at, size, zlib.crc32(chunk.tobytes()), chunk.tolist())
                    for column, value in zip(rows, values):
                        column.append(value)
                    at, piece = at + size, piece + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    wanted = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(released(cut), wanted)


# --- planning: driver work of a fixed size ----------------------------------------------------

@dataclass
class Plan:
    """Rank ranges per length. ``keys`` = length << 44 | first rank of the range, ascending.

    A range holds ``copies`` pieces of that length in each sequence, from ``offset`` on, for the
    sequences from ``first`` on.
    """

    keys: np.ndarray
    starts: np.ndarray
    copies: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    sequences: int


def exact_patterns(present: np.ndarray, max_tokens: int) -> np.ndarray:
    """All multisets of two or three present lengths that sum to ``max_tokens``; 0 pads pairs."""
    have = np.zeros(max_tokens + 1, bool)
    have[present] = True
    have[0] = True
    found = []
    for a in present[present < max_tokens]:
        rest = max_tokens - a
        b = np.arange((rest + 1) // 2, min(a, rest) + 1)
        b = b[have[b] & have[rest - b] & (b > 0)]
        found.append(np.stack([np.full(len(b), a), b, rest - b], 1))
    return np.concatenate(found) if found else np.zeros((0, 3), int)


def fit_repeats(patterns: np.ndarray, counts: np.ndarray, steps: int = 100) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared distance of (lengths used by x) to ``counts``.

    Accelerated projected gradient. The incidence matrix is sparse (three entries a column), so
    products are gathers and bin counts.
    """
    size, x = len(counts), np.zeros(len(patterns))
    weight = np.concatenate([[0.0], np.ones(size - 1)])
    uses = np.bincount(patterns.ravel(), minlength=size) * weight
    step = 1.0 / max(1.0, 3.0 * uses.max())
    # Each length's own step: rows used by many patterns would force a tiny common step.
    scale = 1.0 / np.maximum(1.0, uses)[patterns].max(1) / 3.0
    look, momentum = x, 1.0
    for _ in range(steps):
        used = sum(np.bincount(patterns[:, k], look, size) for k in range(3)) * weight
        gradient = (used - counts * weight)[patterns].sum(1)
        new = np.maximum(0.0, look - np.maximum(step, scale) * gradient)
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        look = new + (momentum - 1) / following * (new - x)
        if gradient @ (new - x) > 0:
            look, following = new, 1.0
        x, momentum = new, following
    return x


def round_repeats(patterns: np.ndarray, x: np.ndarray, counts: np.ndarray, up: bool = True) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Whole repeat counts, never beyond what is left of a length: (lengths, sequences) of each pattern, and the rest.

    Counts are rounded down first; then the largest remainders are rounded up, one sequence each, as long as their
    lengths last. The fit spreads over many more patterns than there are lengths, so most of it lies in
    the remainders. ``up=False`` leaves them to best fit.
    """
    left, chosen = counts.copy(), Counter()

    def take(k: int, n: int) -> None:
        uses = Counter(int(v) for v in patterns[k] if v)
        n = min(n, *(int(left[v]) // used for v, used in uses.items()))
        if n > 0:
            chosen[k] += n
            for v, used in uses.items():
                left[v] -= n * used

    whole = np.floor(x).astype(np.int64)
    for k in np.flatnonzero(whole):
        take(int(k), int(whole[k]))
    if up:
        remainder = x - whole
        order = np.argsort(-remainder, kind="stable")
        for k in order[: np.count_nonzero(remainder > 0)]:
            if left[patterns[k][patterns[k] > 0]].all():
                take(int(k), 1)
    return [(tuple(int(v) for v in patterns[k] if v), n) for k, n in chosen.items()], left


def pack_rest(left: np.ndarray, max_tokens: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit packing of a histogram: the longest length first, then always the longest that fits.

    Equal sequences are made at once, so the work follows the number of lengths, not of rows.
    """
    left, chosen = left.copy(), []
    present = [int(v) for v in np.flatnonzero(left)]
    while present:
        lengths, room, k = [], max_tokens, len(present)
        while room and (k := bisect_right(present, room, 0, k)):
            v = present[k - 1]
            fits = min(int(left[v]), room // v)
            lengths += [v] * fits
            room -= v * fits
            k -= 1
        uses = Counter(lengths)
        n = min(int(left[v]) // used for v, used in uses.items())
        chosen.append((tuple(lengths), n))
        for v, used in uses.items():
            left[v] -= n * used
            if not left[v]:
                present.remove(v)
    return chosen


def plan_packing(counts: np.ndarray, max_tokens: int = MAX_TOKENS) -> Plan:
    """Places for every rank of every length; ``counts[v]`` pieces have length ``v``."""
    present = np.flatnonzero(counts)
    patterns = exact_patterns(present, max_tokens)
    chosen, left = [], counts.astype(np.int64).copy()
    if left[max_tokens]:
        chosen.append(((max_tokens,), int(left[max_tokens])))
        left[max_tokens] = 0
    repeats = fit_repeats(patterns, left.astype(float))
    # The share of the fit with fewest sequences counts. Rounding down only, which leaves most to best fit, must
    # save one sequence in WORTH to be taken instead.
    options = {}
    for up, shares in ((True, SHARES), (False, DOWN_SHARES)):
        tried = []
        for share in shares:
            fitted, rest = round_repeats(patterns, share * repeats, left, up)
            option = fitted + pack_rest(rest, max_tokens)
            tried.append((sum(n for _, n in option), -sum(n for _, n in fitted), option))
        options[up] = min(tried, key=lambda o: o[:2])
    chosen += options[options[True][0] * (WORTH - 1) <= options[False][0] * WORTH][2]

    taken = np.zeros(max_tokens + 1, np.int64)
    rows, sequences = [], 0
    for lengths, n in chosen:
        offset = 0
        for v in sorted(set(lengths), reverse=True):
            copies = lengths.count(v)
            rows.append(((v << _RANK_BITS) + int(taken[v]), int(taken[v]), copies, sequences, offset))
            taken[v] += n * copies
            offset += v * copies
        sequences += n
    rows.sort()
    keys, starts, copies, first, offsets = (np.array(c, np.int64) for c in (zip(*rows) if rows else [[]] * 5))
    return Plan(keys, starts, copies, first, offsets, sequences)


# --- the operator -----------------------------------------------------------------------------

def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, rank_groups: int = RANK_GROUPS) -> DataFrame:
    """``pieces`` (any columns, with ``length`` 1..max_tokens) plus ``sequence_id`` and ``offset``.

    ``pieces`` is read twice: pass a written table. Only (length, number of pieces) reaches the
    driver. Ranks are taken within (length, hash group), then shifted by the smaller groups of that
    length, so a length that holds a third of all rows is spread over ``rank_groups`` tasks.
    Empty input gives no rows; equal rows get different places.
    """
    rows = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    counts = np.zeros(max_tokens + 1, np.int64)
    for r in rows:
        counts[r["length"]] = r["n"]
    plan = plan_packing(counts, max_tokens)

    kept = pieces.columns
    order = [c for c, kind in pieces.dtypes if not kind.startswith(("map", "variant"))]
    group = F.pmod(F.xxhash64(*order), F.lit(rank_groups)).cast("int")
    local = Window.partitionBy("length", "_group").orderBy(*[c for c in order if c != "length"])
    ranked = pieces.withColumn("_group", group).withColumn("_rank", F.row_number().over(local).cast("long") - 1)
    sizes = pieces.groupBy("length", group.alias("_group")).agg(F.count("*").alias("_n"))
    below = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_group", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_below"))
    placed = ranked.join(sizes, ["length", "_group"]).select(*kept, (F.col("_rank") + F.col("_below")).alias("_rank"))

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        v, r = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        k = np.searchsorted(plan.keys, (v << _RANK_BITS) + r, "right") - 1
        at = r - plan.starts[k]
        return pa.StructArray.from_arrays(
            [pa.array(plan.first[k] + at // plan.copies[k]), pa.array(plan.offset[k] + at % plan.copies[k] * v)],
            ["sequence_id", "offset"])

    return placed.withColumn("_place", place("length", "_rank")).select(*kept, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, vocabulary: str, ranks: str | None = None, max_tokens: int = MAX_TOKENS,
                   keep_ids: bool = False, **names: str) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its sequence and place there."""
    pieces = cut_pieces(docs, vocabulary, ranks, max_tokens, keep_ids=keep_ids, **names)
    return pack(materialize(pieces, "pieces"), max_tokens)


def assemble(packed: DataFrame) -> DataFrame:
    """``sequence_id, tokens``: pieces with ``ids`` put together; a sequence is at most ``max_tokens`` ids."""
    part = F.struct("offset", "ids")
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["ids"])).alias("tokens"))
