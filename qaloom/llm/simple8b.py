"""Token ids in word-aligned files: Simple-8b with escapes and per-block offsets.

A 64-bit word holds a 4-bit selector and 60 bits of payload; the selector says how many ids the word holds and how
wide each is. Ids come in blocks of ``BLOCK``. A block has a limit: ids from there on are written as the limit
itself and stand whole in the block's escapes: ids of over 60 bits, and others where that takes less room. Blocks know their
first word and first escape, so any block decodes on its own, and all words of a selector decode at once.

A file is a run of segments, each followed by one newline byte. A segment (all numbers little-endian)::

    "S8B1" 0000 | u64 documents, ids, blocks, words, escapes
    i64 document ids | u8 1 where the id is known | u64 ends of the documents, in ids
    u64 first word of each block | u64 first escape of each block | u64 limit of each block
    u64 words | u64 escapes
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qaloom.llm.common import batches, flat_ranges, kept, released
from qaloom.llm.hashing import LETTER_HASHES, LOWER, run_hashes, sums, text_blocks
from qaloom.session import checked_broadcast

BLOCK = 1024
# A multiple of BLOCK.
SEGMENT_IDS = 1 << 18
SEGMENTS_PER_FILE = 96
KEPT_PIECES = 500_000
BLOCK_BYTES = 1 << 19
# Marks that no token joins with a letter; the apostrophe can begin a token of letters.
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Kinds of bytes: 1 a letter, 2 a mark, 3 a space or line end, 0 anything else.
_KINDS = np.zeros(256, np.uint8)
_KINDS[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
_KINDS[list(_MARKS)] = 2
_KINDS[list(b" \n")] = 3
MAGIC = b"S8B1\0\0\0\0"
_HEAD = "<8s5Q"

# Fixed values of the coding: payload bits and ids a word, by selector.
BITS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
NO_LIMIT = (1 << 64) - 1

_COUNT = np.array(COUNTS)
_POWERS = np.array([1 << b for b in range(64)], np.uint64)
# Limits that a block may choose: none, or all ones of a width.
_WIDTHS = sorted({b for b in BITS if b})
_LIMITS = np.array([NO_LIMIT] + [(1 << b) - 1 for b in _WIDTHS], np.uint64)


def _choice_costs() -> np.ndarray:
    """Bits that an id of each width (0 to 64) takes under each limit of ``_LIMITS``."""
    slot = [64 / max(c for b, c in zip(BITS, COUNTS) if b >= w) if w <= 60 else np.inf for w in range(65)]
    costs = [[slot[w]] + [slot[w] if w <= top else slot[top] + 64 for top in _WIDTHS] for w in range(65)]
    return np.array(costs)


_COSTS = _choice_costs()


def widths(values: np.ndarray) -> np.ndarray:
    """Bits each value needs; 0 for 0."""
    return np.searchsorted(_POWERS, values, "right")


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block, first escape of each block, limits, escapes) of non-negative 64-bit ids."""
    values = np.ascontiguousarray(ids, np.uint64)
    n = len(values)
    starts = np.arange(0, n, block)
    if not n:
        none = np.zeros(0, np.uint64)
        return none, none, none, none, none
    of_block = np.arange(n) // block
    width = widths(values)
    histogram = np.bincount(of_block * 65 + width, minlength=len(starts) * 65).reshape(-1, 65)
    # An infinite cost counts only where there is such an id.
    cost = np.where(np.isinf(_COSTS), 0.0, _COSTS)
    total = histogram @ cost
    total[:, 0] = np.where(histogram[:, 61:].any(1), np.inf, total[:, 0])
    limits = _LIMITS[total.argmin(1)]
    limit = limits[of_block]
    wide = values >= limit
    if wide.any():
        escapes = values[wide]
        values = np.minimum(values, limit)
        width = widths(values)
    else:
        escapes = np.zeros(0, np.uint64)
    first_escape = np.concatenate([[0], np.cumsum(np.add.reduceat(wide, starts))])[:-1]

    # The selector of most ids that all fit, for a word that would begin at each id.
    at = np.arange(n, dtype=np.int32)
    block_end = np.minimum((of_block + 1) * block, n).astype(np.int32)
    width = width.astype(np.int8)
    best = np.full(n, len(BITS) - 1, np.int8)
    room, last = None, None
    for selector in range(len(BITS) - 2, -1, -1):
        if BITS[selector] != last:
            last = BITS[selector]
            narrow = width <= last
            if np.count_nonzero(narrow) < COUNTS[selector]:
                break
            # Up to the next id that does not fit, or the end of the block.
            stop = np.where(narrow, block_end, at)
            room = np.minimum.accumulate(stop[::-1])[::-1] - at
        best[room >= COUNTS[selector]] = selector

    # Words follow each other; all blocks take their steps at once.
    begins = np.zeros(n, bool)
    here, end = starts.copy(), block_end[starts]
    while len(here):
        begins[here] = True
        here = here + _COUNT[best[here]]
        inside = here < end
        here, end = here[inside], end[inside]
    first = np.flatnonzero(begins)
    selectors = best[first]
    words = np.zeros(len(first), np.uint64)
    for selector in np.unique(selectors):
        rows = np.flatnonzero(selectors == selector)
        steps = np.arange(COUNTS[selector])
        shifts = (4 + BITS[selector] * steps).astype(np.uint64)
        if BITS[selector]:
            words[rows] = np.bitwise_or.reduce(values[first[rows][:, None] + steps] << shifts, axis=1)
        words[rows] |= np.uint64(selector)
    return words, np.searchsorted(first, starts).astype(np.uint64), first_escape.astype(np.uint64), limits, escapes


def decode(words: np.ndarray, limits: np.ndarray, escapes: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The ids of consecutive whole blocks."""
    selectors = (words & np.uint64(15)).astype(np.int64)
    ends = np.cumsum(_COUNT[selectors])
    ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    first = ends - _COUNT[selectors]
    for selector in np.unique(selectors):
        if not BITS[selector]:
            continue
        rows = np.flatnonzero(selectors == selector)
        steps = np.arange(COUNTS[selector])
        shifts = (4 + BITS[selector] * steps).astype(np.uint64)
        mask = np.uint64((1 << BITS[selector]) - 1)
        ids[first[rows][:, None] + steps] = (words[rows][:, None] >> shifts) & mask
    if len(escapes):
        ids[ids == np.repeat(limits, block)[: len(ids)]] = escapes
    return ids


class Segment:
    """One segment of a file, read in place: document ids and ends, and ids by range of positions."""

    def __init__(self, data: memoryview, at: int):
        magic, docs, self.n_ids, blocks, words, escapes = struct.unpack_from(_HEAD, data, at)
        if magic != MAGIC:
            raise ValueError("not a segment")
        at += struct.calcsize(_HEAD)

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found

        self.doc_ids, self.known, self.ends = take(docs, "<i8"), take(docs, "u1"), take(docs, "<u8").astype(np.int64)
        self._word, self._escape, self._limits = take(blocks, "<u8"), take(blocks, "<u8"), take(blocks, "<u8")
        self._words, self._escapes = take(words, "<u8"), take(escapes, "<u8")
        self.stop = at + 1

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids at the positions [start, stop); only their blocks are decoded."""
        if start >= stop:
            return np.zeros(0, np.uint64)
        low, high = start // BLOCK, -(-stop // BLOCK)
        cut = [int(a[high]) if high < len(a) else len(whole) for a, whole in ((self._word, self._words), (self._escape, self._escapes))]
        found = decode(self._words[int(self._word[low]): cut[0]], self._limits[low:high], self._escapes[int(self._escape[low]): cut[1]])
        return found[start - low * BLOCK: stop - low * BLOCK]


def segments(content: bytes) -> Iterator[Segment]:
    """The segments of a file, one after the other."""
    data, at = memoryview(content), 0
    while at < len(data):
        segment = Segment(data, at)
        yield segment
        at = segment.stop


def pack_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """The bytes of a segment. A very long document is encoded a run of blocks at a time."""
    runs = [encode(ids[at: at + SEGMENT_IDS]) for at in range(0, max(len(ids), 1), SEGMENT_IDS)]
    words, limits, escapes = (np.concatenate([run[k] for run in runs]) for k in (0, 3, 4))
    word_at, escape_at = (np.concatenate([run[k] + np.uint64(before) for run, before in zip(runs, np.cumsum([0] + [len(run[w]) for run in runs]))])
                          for k, w in ((1, 0), (2, 4)))
    parts = [
        struct.pack(_HEAD, MAGIC, len(doc_ids), len(ids), len(limits), len(words), len(escapes)),
        np.array([d or 0 for d in doc_ids], "<i8"), np.array([d is not None for d in doc_ids], "u1"), np.cumsum(lengths, dtype="<u8"),
        *(a.astype("<u8") for a in (word_at, escape_at, limits, words, escapes)),
    ]
    return b"".join(p if isinstance(p, bytes) else p.tobytes() for p in parts)


# --- documents --------------------------------------------------------------------------------

class WordIds:
    """Ids of texts piece by piece, the ids of pieces being kept.

    For vocabularies that drop white space, fold case, mark ends of words and never join letters with punctuation. Texts are
    cut at spaces and line ends, and between a Latin letter and a mark of ``_MARKS``; all else stays together and
    is the library's to cut. Pieces are known by a 64-bit hash and the sum of their bytes' hashes. Up to ``KEPT_PIECES`` are kept, those
    met least lately go first. One object serves a Python worker for all its tasks.
    """

    def __init__(self, vocabulary: str):
        self._encode = plain_encoder(vocabulary)
        tokenizer = self._encode.__self__
        self._special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self._ends = np.zeros(tokenizer.get_vocab_size(), bool)
        self._ends[[i for token, i in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self._forget(np.zeros(0, np.int64))

    def _forget(self, keep: np.ndarray) -> None:
        """Only the pieces at ``keep`` stay."""
        if not len(keep):
            self._hash, self._other = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
            self._at, self._n, self._pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        else:
            self._pool = self._pool[flat_ranges(self._at[keep], self._n[keep])]
            self._hash, self._other, self._n = self._hash[keep], self._other[keep], self._n[keep]
            self._at = np.cumsum(self._n) - self._n
        self._met = np.zeros(len(self._hash), bool)

    def _texts(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self._encode(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[np.ndarray]:
        """Words of letters only, many in one text: each ends with a token that the vocabulary marks as a word's end."""
        found = []
        for at in range(0, len(words), 1000):
            some = words[at: at + 1000]
            ids = self._texts([" ".join(some)])[0]
            cuts = np.flatnonzero(self._ends[ids]) + 1
            found += np.split(ids, cuts[:-1]) if len(cuts) == len(some) else self._texts(some)
        return found

    def _learn(self, hashes: np.ndarray, others: np.ndarray, pieces: list[str], plain: np.ndarray) -> None:
        """Takes in pieces with ascending new hashes."""
        ids: list[np.ndarray] = [None] * len(pieces)
        for kind, of in ((plain, self._words), (~plain, self._texts)):
            rows = np.flatnonzero(kind).tolist()
            for row, own in zip(rows, of([pieces[r] for r in rows])):
                ids[row] = own
        sizes = np.array([len(x) for x in ids])
        place = np.searchsorted(self._hash, hashes)
        starts = len(self._pool) + np.cumsum(sizes) - sizes
        self._pool = np.concatenate([self._pool, *ids])
        for name, values in (("_hash", hashes), ("_other", others), ("_at", starts), ("_n", sizes), ("_met", np.ones(len(sizes), bool))):
            setattr(self, name, np.insert(getattr(self, name), place, values))

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, first id of each row and the end)."""
        kind = _KINDS[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)  # letters of two bytes, but for the two signs among them
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = 1
        begins = np.zeros(len(data) + 1, bool)
        begins[1:-1] = (kind[1:] != 3) & ((kind[:-1] == 3) | (kind[:-1] + kind[1:] == 3) & (kind[:-1] != 0) & (kind[1:] != 0))
        filled = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[filled] = kind[filled] != 3
        starts = np.flatnonzero(begins)
        # A piece ends at the next start or gap, or with its row.
        stops = begins.copy()
        stops[:-1] |= kind == 3
        stops[offsets] = True
        marks = np.flatnonzero(stops)
        ends = marks[np.searchsorted(marks, starts, "right")]
        odd = np.concatenate([[0], np.cumsum(kind != 1)])
        plain = odd[starts] == odd[ends]
        spelt = LOWER[data]
        kept_case = flat_ranges(starts[~plain], (ends - starts)[~plain])
        spelt[kept_case] = data[kept_case]
        letters = LETTER_HASHES[spelt]
        hashes = run_hashes(sums(letters), starts, ends)
        up_to = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters)])
        others = up_to[ends] - up_to[starts]
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        for attempt in (0, 1):
            place = np.minimum(np.searchsorted(self._hash, unique), max(len(self._hash) - 1, 0))
            known = self._hash[place] == unique if len(self._hash) else np.zeros(len(unique), bool)
            if attempt or known.all():
                break
            if len(self._hash) + len(unique) > KEPT_PIECES:
                self._met[place[known]] = True
                keep = np.flatnonzero(self._met)
                self._forget(keep if len(keep) < KEPT_PIECES // 2 else keep[:0])
                place = np.minimum(np.searchsorted(self._hash, unique), max(len(self._hash) - 1, 0))
                known = self._hash[place] == unique if len(self._hash) else known & False
            new = first[~known]
            self._learn(unique[~known], others[new], [spelt[a:b].tobytes().decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())], plain[new])
        self._met[place] = True
        of_piece = place[inverse]
        if (self._other[of_piece] != others).any():
            raise HashClash
        sizes = self._n[of_piece]
        ids = self._pool[flat_ranges(self._at[of_piece], sizes)]
        before = np.concatenate([[0], np.cumsum(sizes)])
        return ids, before[np.searchsorted(starts, offsets)]

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        texts = texts.fill_null("")
        whole = np.zeros(len(texts), bool)
        for special in self._special:
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        for row, data, offsets in text_blocks(texts, BLOCK_BYTES):
            rows = range(row, row + len(offsets) - 1)
            try:
                ids, first = self._block(data, offsets) if len(data) else (np.zeros(0, np.uint32), offsets)
            except HashClash:
                whole[row: rows.stop] = True
            for k, r in enumerate(rows):
                yield self._texts([texts[r].as_py()])[0] if whole[r] else ids[first[k]: first[k + 1]]


class HashClash(Exception):
    """Two pieces of one hash."""


def plain_encoder(vocabulary: str) -> Callable:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary).encode_batch_fast


def batch_encoder(vocabulary: str, by_word: bool) -> Callable[[pa.Array], Iterator[np.ndarray]]:
    """texts -> token ids of the ``tokenizers`` file ``vocabulary``, without added special tokens. ``by_word``: see ``WordIds``."""
    if by_word:
        return kept(f"words of {vocabulary}", lambda: WordIds(vocabulary))
    encode_texts = kept(f"ids of {vocabulary}", lambda: plain_encoder(vocabulary))

    def ids_of(texts: pa.Array) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), 64):
            for found in encode_texts([t or "" for t in texts[at: at + 64].to_pylist()], add_special_tokens=False):
                yield np.array(found.ids, "<u4")

    return ids_of


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
              by_word: bool = False, partitions: int | None = None) -> None:
    """Token ids of all rows, each followed by ``end_id``, as files under ``path``/ids in ascending order of ``id_col``.

    ``path``/files says for each file which of all ids it begins with. Null texts count as empty, null ids come first,
    rows of one id stand next to each other in the order of their texts' hashes; other columns are left out. No rows give no segments.

    Rows are range-partitioned by id (ties by text hash and place, so one repeated id is many ranges) and encoded
    where they lie; a task holds one segment, or one document where that is longer. The text writer puts the bytes
    down as they are, each segment with its newline, and Spark's commit makes rerun tasks harmless.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(
        "*", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("place"))
    order = ["id", "tie", "place"]
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = batch_encoder(vocabulary, by_word)
        held_ids: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def segment() -> pa.RecordBatch:
            data = pack_segment(held_ids, [len(x) for x in held], np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["segment"])

        for part in parts:
            for key, ids in zip(part.column(0).to_pylist(), encode_texts(part.column(1))):
                held_ids.append(key)
                held.append(np.append(ids, np.uint32(end_id)))
                size += len(held[-1])
                if size >= SEGMENT_IDS:
                    yield segment()
                    held_ids, held, size = [], [], 0
        if held:
            yield segment()

    coded = ranged.sortWithinPartitions(*order).select("id", "text").mapInArrow(released(cut), "segment binary")
    coded.select(F.col("segment").cast("string")).write.option("lineSep", "\n").option("compression", "none").option(
        "maxRecordsPerFile", SEGMENTS_PER_FILE).text(f"{path}/ids")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for name, content in zip(part.column(0).to_pylist(), part.column(1)):
                sizes = [(len(s.doc_ids), s.n_ids) for s in segments(content.as_py())]
                values = [name, sum(d for d, _ in sizes), sum(n for _, n in sizes)]
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["file", "n_docs", "n_ids"])

    # One row a file, so the window is over a table of files.
    sizes = id_files(docs.sparkSession, path).mapInArrow(released(count), "file string, n_docs long, n_ids long")
    numbers = [F.regexp_extract("file", r"part-(\d+)-.*?(?:-c(\d+))?\.[a-z]+$", k) for k in (1, 2)]
    before = Window.orderBy(*[F.coalesce(x.try_cast("long"), F.lit(0)) for x in numbers]).rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("*", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first_id")).write.parquet(f"{path}/files")


def id_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, content) of every file of ids."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def read_ids(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document under ``path`` and, if asked, its ``ids``, all from the files."""
    fields = [pa.field("file", pa.string()), pa.field("doc_id", pa.int64()), pa.field("at", pa.int64()),
              pa.field("n_tokens", pa.int64()), pa.field("ids_crc32", pa.int64())]
    if keep_ids:
        fields.append(pa.field("ids", pa.list_(pa.int64())))
    schema = pa.schema(fields)

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part in parts:
            for name, content in zip(part.column(0).to_pylist(), part.column(1)):
                before = 0
                for segment in segments(content.as_py()):
                    ids, begin = segment.ids(0, segment.n_ids).astype("<u4"), 0
                    for key, known, end in zip(segment.doc_ids.tolist(), segment.known.tolist(), segment.ends.tolist()):
                        own = ids[begin:end]
                        row = (name, key if known else None, before + begin, end - begin, zlib.crc32(own))
                        yield (*row, own.tolist()) if keep_ids else row
                        begin = end
                    before += segment.n_ids

    wanted = "file string, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")
    found = id_files(spark, path).mapInArrow(released(lambda parts: batches(rows(parts), schema)), wanted)
    files = spark.read.schema("file string, n_docs long, n_ids long, first_id long").parquet(f"{path}/files").select("file", "first_id")
    return found.join(checked_broadcast(files), "file").select(
        "doc_id", (F.col("first_id") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if keep_ids else []))
