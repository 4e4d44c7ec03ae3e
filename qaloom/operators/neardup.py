"""Near-duplicate records: banded min-hash finds candidates, their shingle sets decide.

Records whose texts have the same set of word shingles are one entry from the start. Entries that agree in any
band of their min-hash signature meet; a pair counts if its sets overlap by the threshold. Small
buckets meet in a join. In a large one all entries meet its most typical one first; those that are not connected to
the rest after that are compared with everything else block by block, so a bucket with a third of all
entries is many tasks, and only a spanning forest of its links leaves them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.session import checked_broadcast, materialize, spread

SHINGLE_WORDS = 5
PERCENT = 80
# 40 bands of 4: a pair of similarity 0.8 is missed with a probability of (1 - 0.8**4)**40, under one in a thousand million.
BANDS, BAND_ROWS = 40, 4
# Entries of a bucket that meet pairwise in a join, and those compared in one block of a larger bucket.
SMALL_BUCKET = 32
BLOCK_ENTRIES = 512
BLOCK_SHINGLES = 1 << 19
# Bins that the shingles of a block's entries are dealt to before pairs are compared.
MOST_BINS = 1 << 12
# Text hashed at once; a longer text is hashed alone.
BLOCK_BYTES = 1 << 20
# Ids of candidates that may be broadcast: 8 bytes each.
BROADCAST_IDS = 1_000_000
# Fixed values of a 64-bit mixing function, and an odd multiplier with its inverse.
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FACTORS = (_mix(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64) * np.uint64(_BASE)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the runs values[start: end], equal for equal runs wherever they stand."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, len(values)), out=total[1:])
    return _mix((total[ends] - total[starts]) * _powers(_INVERSE, len(total))[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of the texts data[offsets[i]: offsets[i + 1]], and where each text's begin.

    Words lie between white space. A text of fewer words, but not none, is one run.
    """
    letter = ~_SPACE[data]
    begins, stops = letter.copy(), letter.copy()
    begins[1:] &= ~letter[:-1]
    stops[:-1] &= ~letter[1:]
    # Words do not go on in the next text.
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[edges] |= letter[edges]
    stops[edges - 1] |= letter[edges - 1]
    starts = np.flatnonzero(begins)
    words = _run_hashes(_BYTES[data], starts, np.flatnonzero(stops) + 1)
    first = np.searchsorted(starts, offsets)
    counts = np.diff(first)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(runs)])
    row = np.repeat(np.arange(len(counts)), runs)
    at = first[row] + np.arange(begin[-1]) - begin[row]
    return _run_hashes(words, at, np.minimum(at + size, first[row + 1])), begin


def band_keys(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``BANDS`` keys for each run values[offsets[i]: offsets[i + 1]], none of them empty.

    The values are hashes already, so an odd multiplier each is enough to order their upper halves anew.
    """
    keys = np.zeros((len(offsets) - 1, BANDS), np.uint64)
    upper = (values.view(np.uint64) >> np.uint64(32)).astype(np.uint32)
    for k, factor in enumerate(_FACTORS):
        least = np.minimum.reduceat(upper * factor, offsets[:-1])
        keys[:, k // BAND_ROWS] = _mix(keys[:, k // BAND_ROWS] * np.uint64(31) + least)
    return keys.view(np.int64)


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, row offsets) of consecutive rows of about ``BLOCK_BYTES``."""
    sizes = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(sizes, sizes[row] + BLOCK_BYTES, "right")) - 1)
        some = texts.slice(row, stop - row)
        data = np.frombuffer(b"".join(x.as_buffer() for x in some), np.uint8)
        yield row, stop, data, sizes[row: stop + 1] - sizes[row]
        row = stop


def _signed(records: DataFrame, text: str, size: int) -> DataFrame:
    """``id, n, hashes, same, bands`` of ``id, <text>``: the set of shingles, its size, its digest and its band keys.

    Texts without words have no digest and no keys. Case is folded by Spark before.
    """

    def sign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row, stop, data, offsets in _blocks(part.column(1)):
                found, begin = shingle_hashes(data, offsets, size)
                found = found.view(np.int64)
                sets = [np.unique(found[x:y]) for x, y in zip(begin[:-1].tolist(), begin[1:].tolist())]
                sizes = np.array([len(x) for x in sets])
                some = sizes > 0
                values = np.concatenate([np.zeros(0, np.int64), *sets])
                first = np.concatenate([[0], np.cumsum(sizes)])
                keys = band_keys(values, np.append(first[:-1][some], first[-1])) if some.any() else np.zeros((0, BANDS), np.int64)
                same = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(row, stop - row), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values)),
                     pa.array(same, pa.binary()), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * BANDS)]), pa.int32()), pa.array(keys.ravel()))],
                    names=["id", "n", "hashes", "same", "bands"])

    lower = F.lower(F.coalesce(F.col(text), F.lit(""))).cast("binary")
    return spread(records).select("id", lower.alias("text")).mapInArrow(sign, "id long, n int, hashes array<bigint>, same binary, bands array<bigint>")


def similar(one: Column, other: Column, percent: int) -> Column:
    """Whether two shingle sets overlap by ``percent`` of their union; short-cuts by size first."""
    n, m = F.size(one), F.size(other)
    fits = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    both = F.size(F.array_intersect(one, other))
    return fits & F.when(fits, 100 * both >= percent * (n + m - both)).otherwise(False)


def _far_apart(sets: list[np.ndarray], percent: int) -> Iterator[np.ndarray]:
    """For each set in turn, which of the sets up to it surely overlap by less than ``percent``.

    Sets are dealt to bins by their values. Bins that only one of two sets has count members that only one
    of them has, so no pair that overlaps enough is ever marked. ``sets`` go from small to large.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    bins = min(max(256, 1 << int(2 * sizes[-1]).bit_length()), MOST_BINS)
    taken = np.zeros((len(sets), bins), np.float32)
    for k, x in enumerate(sets):
        taken[k, x & (bins - 1)] = 1
    held = taken.sum(1)
    for low in range(0, len(sets), 256):
        high = min(low + 256, len(sets))
        only_one = held[low:high, None] + held[None, :high] - 2 * (taken[low:high] @ taken[:high].T)
        total = sizes[low:high, None] + sizes[None, :high]
        yield from (100 + percent) * (total - only_one) < 2 * percent * total


def forest_links(
    ids: list[int], sets: list[np.ndarray], bands: np.ndarray, band: int, side: list[bool], percent: int, label: list[int] | None = None
) -> list[tuple[int, int]]:
    """A spanning forest of the links among the entries of one block pair.

    Entries of one block are compared among themselves where the pair is a block and itself, else with those of the
    other (``side``). Entries that met in an earlier band, or are connected already (equal ``label``), are not compared.
    """
    order = np.argsort([len(x) for x in sets], kind="stable")
    sets = [sets[k] for k in order]
    ids, bands, sides = np.asarray(ids)[order], bands[order], np.asarray(side, bool)[order]
    root = np.unique(ids if label is None else np.asarray(label)[order], return_inverse=True)[1]
    mixed = sides.any() and not sides.all()
    links = []
    for k, far in enumerate(_far_apart(sets, percent)):
        maybe = ~far[:k] & (root[:k] != root[k])
        if mixed:
            maybe &= sides[:k] != sides[k]
        others = np.flatnonzero(maybe)
        others = others[~(bands[others, :band] == bands[k, :band]).any(1)]
        for other in others[::-1].tolist():
            if root[other] == root[k]:
                continue
            both = len(np.intersect1d(sets[k], sets[other], assume_unique=True))
            if 100 * both >= percent * (len(sets[k]) + len(sets[other]) - both):
                root[root == root[k]] = root[other]
                links.append((int(ids[k]), int(ids[other])))
    return links


def _only(sets: DataFrame, entries: DataFrame) -> DataFrame:
    """``sets`` of the ``entries``: sets are large, so few ids are sent to them rather than all sets shuffled."""
    return sets.join(checked_broadcast(entries.select("entry").distinct(), BROADCAST_IDS), "entry", "left_semi")


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct pairs (a, b) whose sets are similar. Only sets of entries in pairs are moved."""
    held = materialize(_only(sets, pairs.select(F.explode(F.array("a", "b")).alias("entry"))), "sets")
    return (
        pairs.join(held.select(F.col("entry").alias("a"), F.col("hashes").alias("of_a")), "a")
        .join(held.select(F.col("entry").alias("b"), F.col("hashes").alias("of_b")), "b")
        .filter(similar(F.col("of_a"), F.col("of_b"), percent)).select("a", "b")
    )


def _fit(one: str, other: str, percent: int) -> Column:
    return 100 * F.least(one, other) >= percent * F.greatest(one, other)


def _leader_pairs(crowd: DataFrame, percent: int) -> DataFrame:
    """(a, b): entries of large buckets ``band, key, many, entry, n`` with the bucket's most typical entry.

    That is the one whose buckets hold most entries: it agrees with most others.
    """
    weight = crowd.groupBy("entry").agg(F.sum("many").alias("weight"))
    leaders = crowd.join(weight, "entry").groupBy("band", "key").agg(F.max_by(F.struct("entry", "n"), F.struct("weight", -F.col("entry"))).alias("leader"))
    met = crowd.join(checked_broadcast(leaders), ["band", "key"]).withColumn("m", F.col("leader.n"))
    return met.filter((F.col("entry") != F.col("leader.entry")) & _fit("n", "m", percent)).select(
        F.least("entry", "leader.entry").alias("a"), F.greatest("entry", "leader.entry").alias("b")).distinct()


def _block_links(crowd: DataFrame, signed: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b): links within large buckets ``band, key, entry, n`` between entries that ``labels`` (node, least) keeps apart.

    The entries of a bucket's largest class need no comparison among themselves; all others meet every entry.
    """
    named = crowd.join(labels.withColumnRenamed("node", "entry"), "entry", "left").select(
        "band", "key", "entry", "n", F.coalesce("least", "entry").alias("label"))
    classes = named.groupBy("band", "key", "label").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    bucket = classes.groupBy("band", "key").agg(
        F.max_by(F.struct("label", "rows", "shingles"), F.struct("rows", -F.col("label"))).alias("main"),
        F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles"))

    def cut(rows: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(rows / BLOCK_ENTRIES), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")

    open_ = bucket.filter(F.col("rows") > F.col("main.rows")).select(
        "band", "key", F.col("main.label").alias("main"), cut(F.col("main.rows"), F.col("main.shingles")).alias("mains"),
        cut(F.col("rows") - F.col("main.rows"), F.col("shingles") - F.col("main.shingles")).alias("rest"))
    rows = materialize(named.join(checked_broadcast(materialize(open_, "open")), ["band", "key"]), "rows")
    inside = F.col("label") == F.col("main")
    own = F.when(inside, F.pmod(F.xxhash64("entry"), F.col("mains"))).otherwise(F.col("mains") + F.pmod(F.xxhash64("entry"), F.col("rest"))).cast("int")
    others = F.sequence(F.when(inside, F.col("mains")).otherwise(F.lit(0)), F.col("mains") + F.col("rest") - 1)
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(others)).select(
        "band", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "entry", "label")
    pairs = dealt.join(_only(signed.select("entry", "hashes", "bands"), rows), "entry")

    def link(key: tuple, table: pa.Table) -> pa.Table:
        band, low, high = key[0].as_py(), key[2].as_py(), key[3].as_py()
        sets = [x.values.to_numpy() for x in table.column("hashes")]
        bands = np.array([x.values.to_numpy() for x in table.column("bands")])
        side = [x == high and low != high for x in table.column("own").to_pylist()]
        found = forest_links(table.column("entry").to_pylist(), sets, bands, band, side, percent, table.column("label").to_pylist())
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return pairs.groupBy("band", "key", "low", "high").applyInArrow(link, "a long, b long")


def near_links(signed: DataFrame, heads: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): entries (``heads``) of ``entry, n, hashes, bands`` whose sets are similar, enough to connect all that are."""
    keyed = signed.select("entry", "n", "bands").join(heads.select("entry"), "entry", "left_semi").select("entry", "n", F.posexplode("bands").alias("band", "key"))
    buckets = materialize(keyed.groupBy("band", "key").agg(F.count("*").alias("many")).filter("many > 1"), "buckets")
    met = materialize(keyed.join(buckets, ["band", "key"]), "met")
    small = met.filter(F.col("many") <= SMALL_BUCKET)
    left = small.select("band", "key", F.col("entry").alias("a"), F.col("n").alias("of_a"))
    right = small.select("band", "key", F.col("entry").alias("b"), F.col("n").alias("of_b"))
    meeting = left.join(right, ["band", "key"]).filter((F.col("a") < F.col("b")) & _fit("of_a", "of_b", percent)).select("a", "b")
    crowd = met.filter(F.col("many") > SMALL_BUCKET)
    crowded = bool(crowd.head(1))
    candidates = materialize((meeting.unionByName(_leader_pairs(crowd, percent)) if crowded else meeting).distinct(), "candidates")
    links = materialize(_checked(candidates, signed.select("entry", "hashes"), percent), "near")
    return links.unionByName(_block_links(crowd, signed, least_members(links), percent)) if crowded else links


def least_members(links: DataFrame) -> DataFrame:
    """(node, least): every node of the links with the smallest node it is connected to.

    Rounds of large and small stars: each node hands its neighbours the least of them. Stars are built by
    grouped minima, which reduce before the shuffle, and every round is written, so lineage stays short.
    """

    def star(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both if larger else both.filter("b < a")
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = near.join(least, "a")
        kept = joined.filter("b > a").select("b", "m") if larger else joined.select("b", "m").unionByName(least.select(F.col("a").alias("b"), "m"))
        return kept.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()

    edges = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        after = materialize(star(materialize(star(edges, True), "stars"), False), "stars")
        if edges.count() == after.count() and not after.exceptAll(edges).head(1):
            return after.select(F.col("a").alias("node"), F.col("b").alias("least"))
        edges = after


def near_duplicate_classes(df: DataFrame, text: str, id_col: str, percent: int = PERCENT, size: int = SHINGLE_WORDS) -> DataFrame:
    """``id_col, class_id``: the smallest id that a record is connected to by near-duplicate texts, itself included.

    Two texts are near duplicates if the sets of their runs of ``size`` words, case ignored, overlap by ``percent``
    of their union. Texts without words (null, blank) are alike with nothing. Ids are whole numbers and unique; rows without
    id are left out. Other columns are left out. Records of one shingle set are one entry: copies cost a count.
    """
    records = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    hashed = materialize(_signed(records, "text", size), "shingles")
    heads = materialize(hashed.filter("same IS NOT NULL").groupBy("same").agg(F.min("id").alias("entry")), "entries")
    least = least_members(near_links(hashed.withColumnRenamed("id", "entry"), heads, percent))
    of_entry = heads.join(least, F.col("entry") == F.col("node"), "left").select("same", F.coalesce("least", "entry").alias("class_id"))
    return hashed.select("id", "same").join(of_entry, "same", "left").select(
        F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"))


def drop_near_duplicates(df: DataFrame, text: str, id_col: str, percent: int = PERCENT, size: int = SHINGLE_WORDS) -> DataFrame:
    """Records that are the first of their class of near duplicates, with all columns. See ``near_duplicate_classes``."""
    classes = near_duplicate_classes(df, text, id_col, percent, size)
    gone = classes.filter(F.col("class_id") != F.col(id_col)).select(F.col(id_col).alias("_gone"))
    return df.join(checked_broadcast(gone), F.col(id_col).cast("long") == F.col("_gone"), "left_anti")
