"""Alignment of two tokenizations of the same bytes by diagonal run skipping.

Both sides are arrays of token ends. As long as tokens correspond one to one, ends agree at a fixed shift between the
two indices; such stretches are compared slice by slice, each twice as long as the last, and jumped as a whole. Where
ends differ, the two sides advance past each other's ends until they meet again: that irregular group changes the
shift, and the next stretch runs on the new diagonal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.llm.common import flat_ranges, released
from qaloom.llm.packing import LONG_RUN
from qaloom.session import materialize

# Texts aligned together, and so the size of a group of the last join; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20
FIRST_PROBE = 4
# Groups of more id pairs than this are counted by distinct ids, and pairs are reduced whenever so many are held.
WIDE_GROUP = 1 << 10
HELD_PAIRS = 1 << 22


def irregular_groups(a: list[int], b: list[int]) -> list[tuple[int, int, int, int]]:
    """Groups that are not one token to one: (first, after last) of ``a``, then of ``b``.

    ``a`` and ``b`` are strictly ascending ends with the same last value, or both empty.
    """
    found = []
    i = j = 0
    n = len(a)
    while i < n:
        # The diagonal: slices of 4, 8, 16, ... ends at the shift j - i.
        width = FIRST_PROBE
        while i < n:
            ours, theirs = a[i: i + width], b[j: j + width]
            if ours != theirs:
                break
            i += len(ours)
            j += len(ours)
            width *= 2
        else:
            break
        for x, y in zip(ours, theirs):
            if x != y:
                break
            i += 1
            j += 1
        # Off the diagonal: whichever side is behind takes its next token, until both end at one place.
        first_i, first_j = i, j
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i += 1
        j += 1
        found.append((first_i, i, first_j, j))
    return found


def group_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of tokens of each side before the end of each group: every place where both sides end."""
    groups = irregular_groups(a.tolist(), b.tolist())
    found = np.fromiter(chain.from_iterable(groups), np.int64, 4 * len(groups)).reshape(-1, 4)
    ends = []
    for side, (first, after) in zip((a, b), ((found[:, 0], found[:, 1]), (found[:, 2], found[:, 3]))):
        last = np.ones(len(side), bool)
        last[flat_ranges(first, after - first - 1)] = False
        ends.append(np.flatnonzero(last) + 1)
    return ends[0], ends[1]


# --- the two tokenizers -----------------------------------------------------------------------

class BytePieces:
    """Ids of a byte-level vocabulary; texts are encoded after one space, special strings are ordinary text."""

    def __init__(self, vocabulary: str, ranks: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._vocabulary = vocabulary
        self._slow = None
        self._quick = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
        self.pieces = [b""] * (max(merges.values()) + 1)
        for token, rank in merges.items():
            self.pieces[rank] = token

    def encode(self, text: str) -> np.ndarray:
        if not LONG_RUN.search(text):
            # No string is special here, so none is looked for.
            return np.array(self._quick.encode_ordinary(" " + text), np.int64)
        # Merges of the quicker library are quadratic in a run's length.
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self._vocabulary)
            self._slow.encode_special_tokens = True
        return np.array(self._slow.encode(" " + text, add_special_tokens=False).ids, np.int64)


class SentencePieces:
    """Ids of a sentencepiece model, which adds the space before the text itself."""

    def __init__(self, model: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=model)
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.pieces = [bytes([int(name[3:5], 16)]) if self._model.is_byte(i) else name.replace("▁", " ").encode()
                       for i, name in enumerate(names)]

    def encode(self, text: str) -> np.ndarray:
        return np.array(self._model.encode(text, num_threads=1), np.int64)


class Pool:
    """Byte strings end to end; ``take`` joins those of many ids at once."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.array([len(x) for x in strings])
        self._starts = np.cumsum(self.sizes) - self.sizes
        self._data = np.frombuffer(b"".join(strings), np.uint8)

    def take(self, ids: np.ndarray) -> bytes:
        return self._data[flat_ranges(self._starts[ids], self.sizes[ids])].tobytes()


# --- blocks of texts --------------------------------------------------------------------------

def link_keys(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a << 32 | b, number of links) of the id pairs of one document, each pair once.

    Every token of a group is linked with every token of its other side. Wide groups are counted by their
    distinct ids, and what is held is reduced as it grows, so memory follows the distinct pairs.
    """
    starts_a, starts_b = np.concatenate([[0], ends_a[:-1]]), np.concatenate([[0], ends_b[:-1]])
    n_a, n_b = ends_a - starts_a, ends_b - starts_b
    links = n_a * n_b
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def add(keys: np.ndarray, counts: np.ndarray) -> None:
        nonlocal held, size
        held.append((keys, counts))
        size += len(keys)
        if size > HELD_PAIRS:
            held = [reduced(held)]
            size = len(held[0][0]) // 2

    # Most groups are one token to one: their pairs need no division.
    one = np.flatnonzero(links == 1)
    narrow = np.flatnonzero((links > 1) & (links <= WIDE_GROUP))
    step = HELD_PAIRS // WIDE_GROUP * 64
    for at in range(0, max(len(one), len(narrow)), step):
        rows, single = narrow[at: at + step], one[at: at + step]
        of = np.repeat(rows, links[rows])
        place = np.arange(len(of)) - np.repeat(np.cumsum(links[rows]) - links[rows], links[rows])
        across, down = np.divmod(place, n_b[of])
        left = np.concatenate([ids_a[starts_a[single]], ids_a[starts_a[of] + across]])
        right = np.concatenate([ids_b[starts_b[single]], ids_b[starts_b[of] + down]])
        # Each counts once, so they are sorted without their places.
        add(*np.unique(left << 32 | right, return_counts=True))
    for g in np.flatnonzero(links > WIDE_GROUP):
        left, times = np.unique(ids_a[starts_a[g]: ends_a[g]], return_counts=True)
        right, counts = np.unique(ids_b[starts_b[g]: ends_b[g]], return_counts=True)
        for x, k in zip(left, times):
            add(x << 32 | right, k * counts)
    return held[0] if len(held) == 1 and not (links > WIDE_GROUP).any() else reduced(held)


def reduced(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys once, their counts added."""
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, counts = (np.concatenate(x) for x in zip(*held))
    found, place = np.unique(keys, return_inverse=True)
    return found, np.bincount(place, counts, len(found)).astype(np.int64) if len(found) else counts


def groups_text(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, names: Pool) -> bytes:
    """``a1,a2|b1;a3|b2``: ids of each group, both sides in order. ``names`` holds id * 3 + separator as text."""
    # A token of A stands behind all tokens of earlier groups, one of B also behind its own group's A.
    sizes_a, sizes_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
    before_b = ends_b - sizes_b
    codes = np.zeros(len(ids_a) + len(ids_b), np.int64)
    codes[np.arange(len(ids_a)) + np.repeat(before_b, sizes_a)] = ids_a * 3
    codes[np.arange(len(ids_b)) + np.repeat(ends_a, sizes_b)] = ids_b * 3
    codes[ends_a + before_b - 1] += 1
    codes[ends_a + ends_b - 1] += 2
    return names.take(codes)[:-1]


FIELDS = pa.schema([
    ("block", pa.string()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("codes", pa.binary()), ("times", pa.binary()),
    ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.int64()), ("code", pa.int32()),
])
FIELDS_SQL = ("block string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, "
              "times binary, a int, b int, docs long, code int")


def aligned_rows(docs: DataFrame, vocabulary: str, ranks: str, model: str, id_col: str, text_col: str) -> DataFrame:
    """Two kinds of rows: one a document (``a`` is null), and one for each id pair of a block of documents.

    A block numbers its pairs (``code``) and says in how many of its documents each is linked; a document
    lists its pairs by number and how many links each has.
    """

    def align(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        first, second = BytePieces(vocabulary, ranks), SentencePieces(model)
        pools = [Pool(side.pieces) for side in (first, second)]
        names = Pool([f"{i}{sep}".encode() for i in range(max(len(p.sizes) for p in pools)) for sep in ",|;"])
        number = 0
        keys: list[int | None] = []
        texts: list[str] = []
        held = 0

        def block() -> Iterator[pa.RecordBatch]:
            name = f"{task}-{number}"
            rows, pairs = [], []
            for key, text in zip(keys, texts):
                whole = (" " + text).encode()
                a, b = (side.encode(text) if text else np.zeros(0, np.int64) for side in (first, second))
                if not text or any(pool.take(ids) != whole for pool, ids in zip(pools, (a, b))):
                    rows.append((key, 0, 0, 0, 0, ""))
                    pairs.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    continue
                ends_a, ends_b = group_ends(*(np.cumsum(pool.sizes[ids]) for pool, ids in zip(pools, (a, b))))
                digest = hashlib.sha256(groups_text(a, b, ends_a, ends_b, names)).hexdigest()
                linked, times = link_keys(a, b, ends_a, ends_b)
                rows.append((key, len(a), len(b), len(ends_a), int(times.sum()), digest))
                pairs.append((linked, times))
            found, code, in_docs = np.unique(np.concatenate([p for p, _ in pairs]), return_inverse=True, return_counts=True)
            cuts = np.cumsum([len(p) for p, _ in pairs])[:-1]
            codes = [c.astype("<u4").tobytes() for c in np.split(code, cuts)]
            times = [t.astype("<u4" if t.max(initial=0) < 1 << 32 else "<u8").tobytes() for _, t in pairs]
            columns = [[name] * len(rows), *zip(*rows), codes, times]
            empty = [pa.nulls(len(rows), f.type) for f in list(FIELDS)[9:]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FIELDS)] + empty, schema=FIELDS)
            for at in range(0, len(found), 1 << 16):
                some = found[at: at + (1 << 16)]
                values = [pa.array(x.astype(t)) for x, t in ((some >> 32, np.int32), (some & 0xFFFFFFFF, np.int32), (in_docs[at: at + len(some)], np.int64), (np.arange(at, at + len(some)), np.int32))]
                empty = [pa.nulls(len(some), f.type) for f in list(FIELDS)[1:9]]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), *empty, *values], schema=FIELDS)

        for part in parts:
            for key, text in zip(part.column(0).to_pylist(), part.column(1)):
                keys.append(key)
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held >= BLOCK_BYTES:
                    yield from block()
                    keys, texts, held, number = [], [], 0, number + 1
        if keys:
            yield from block()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(released(align), FIELDS_SQL)


def align_documents(docs: DataFrame, vocabulary: str, ranks: str, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row.

    A is the byte-level vocabulary (``ranks`` names the same vocabulary as a rank file), B the sentencepiece ``model``.
    The count of an id pair is the number of rows that hold it linked; ``n_best`` counts links whose pair has the highest
    count of its A id, ``count_sum`` adds the counts of all links. Rows whose text is null, empty, or
    not given back by both vocabularies have zeros and ''. Repeated rows count each; null ids stay; other columns are
    dropped. No rows in, no rows out.

    Pairs are counted in blocks first; what is shuffled by pair is one row a block and pair, and counts go back to blocks
    the same way, so no link row is ever shuffled. A group of the last join is one block, of ``BLOCK_BYTES`` or one text.
    """
    rows = materialize(aligned_rows(docs, vocabulary, ranks, model, id_col, text_col), "aligned")
    pairs = rows.where("a IS NOT NULL").select("block", "a", "b", "docs", "code")
    counts = materialize(pairs.groupBy("a", "b").agg(F.sum("docs").alias("n")), "pair-counts")
    # One row an id of the vocabulary.
    best = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("most")))
    counts = counts.join(best, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    known = pairs.join(counts, ["a", "b"]).select(F.col("block").alias("of_block"), "code", "n", "best")
    told = rows.where("a IS NULL").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times")

    def tell(left: pa.Table, right: pa.Table) -> pa.Table:
        code = right.column("code").to_numpy()
        n, top = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        n[code], top[code] = right.column("n").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        sums = []
        for codes, times in zip(left.column("codes"), left.column("times")):
            place = np.frombuffer(codes.as_py(), "<u4")
            links = np.frombuffer(times.as_py(), "<u4" if len(times.as_py()) == 4 * len(place) else "<u8").astype(np.int64)
            sums.append((int(links @ top[place]), int(links @ n[place])))
        added = [pa.array([s[k] for s in sums], pa.int64()) for k in (0, 1)]
        kept = left.drop_columns(["block", "codes", "times"])
        return kept.append_column("n_best", added[0]).append_column("count_sum", added[1])

    wanted = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return told.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(tell, wanted).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
