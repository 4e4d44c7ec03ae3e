"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Rows of the matrix are distinct n-gram sets, columns n-grams. The product is taken one column block at a
time. The first block holds each row's rarest-first prefix: a pair that shares too little of it cannot
reach the threshold whatever the other columns hold (a bound from the two sizes), and is discarded. The
few pairs left are multiplied over the remaining columns and judged exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.llm.components import components
from qaloom.llm.hashing import mix, shingle_hashes, text_blocks, words_in
from qaloom.llm.common import free_name, released
from qaloom.session import checked_broadcast, materialize

# A column with more rows than this is frequent: it comes last in the order of columns.
FREQUENT = 64
# Frequent columns travel with the tasks; the limit is raised until they fit this bound.
MOST_FREQUENT_COLUMNS = 500_000
# Rows of a block of the product, columns of a column block, and rows of a family that is multiplied whole.
BLOCK_ROWS, COLUMN_BLOCK, MOST_FAMILY = 512, 1024, 8192
# N-grams of a block of rows, on average: long texts make blocks of fewer rows.
BLOCK_GRAMS = 1 << 19
# Min-hash keys of a row; rows sharing two with a common leader are tried against it first.
KEYS = 6


def _share(percent: int, n: np.ndarray) -> np.ndarray:
    """Prefix length: rows whose overlap reaches percent/100 of n share one of so many first columns."""
    return n + -percent * n // 100 + 1


def sets_of(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes, ascending within each row, and each row's first one (and the end)."""
    _, _, words, first = words_in(data, offsets, lower=True)
    grams, begin = shingle_hashes(words, first, size)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(begin))
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    grams, row = grams[new], row[new]
    return grams, np.searchsorted(row, np.arange(len(offsets)))


def _lists(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values.view(np.int64)))


def frequent_columns(docs: DataFrame, size: int, percent: int, text_col: str) -> np.ndarray:
    """Sorted hashes of n-grams that stand in the prefixes of many rows.

    Prefixes by hash order are an unbiased part of every set, so a frequent n-gram is frequent
    there too. Only counts above the limit come to the driver, within a fixed bound; which
    columns are called frequent changes the work, never the result.
    """

    def prefixes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for _, data, offsets in text_blocks(part.column(0)):
                grams, begin = sets_of(data, offsets, size)
                n = np.diff(begin)
                place = np.arange(len(grams)) - np.repeat(begin[:-1], n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[place < np.repeat(_share(percent, n), n)].view(np.int64))], names=["gram"])

    counts = (docs.select(text_col).mapInArrow(released(prefixes), "gram long").groupBy("gram").agg(F.count("*").alias("n"))
              .where(F.col("n") > FREQUENT))
    counts = materialize(counts, "frequent")
    limit = FREQUENT
    while counts.where(F.col("n") > limit).count() > MOST_FREQUENT_COLUMNS:
        limit *= 2
    found = counts.where(F.col("n") > limit).select("gram").toArrow().column("gram").to_numpy()
    return np.sort(found.view(np.uint64)) if len(found) else np.zeros(0, np.uint64)


def incidence(docs: DataFrame, frequent: np.ndarray, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``key, id, row, check, n, prefix, keys`` of every document.

    ``row`` and ``check`` identify its n-gram set, ``prefix`` its first columns (frequent ones last),
    ``keys`` are min-hashes of the whole set. ``key`` identifies id and text.
    """

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at, data, offsets in text_blocks(part.column(2)):
                grams, begin = sets_of(data, offsets, size)
                n = np.diff(begin)
                row = np.repeat(np.arange(len(n)), n)
                cumulated = [np.concatenate([[np.uint64(0)], np.cumsum(mix(grams, salt))]) for salt in (11, 12)]
                first, second = (c[begin[1:]] - c[begin[:-1]] for c in cumulated)
                keys = np.zeros((len(n), KEYS), np.uint64)
                full = np.flatnonzero(n)
                for k in range(KEYS):
                    if len(full):
                        keys[full, k] = np.minimum.reduceat(mix(grams, 20 + k), begin[:-1][full])
                if len(frequent):
                    common = frequent[np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)] == grams
                    order = np.lexsort((grams, common, row))
                    grams = grams[order]
                keep = np.arange(len(grams)) - begin[row] < _share(percent, n)[row]
                taken = np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=len(n)))])
                rows = slice(at, at + len(n))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)[rows], part.column(1)[rows], pa.array(mix(first, 3).view(np.int64)), pa.array(second.view(np.int64)),
                     pa.array(n), _lists(grams[keep], taken), _lists(keys.ravel(), np.arange(len(n) + 1) * KEYS)],
                    names=["key", "id", "row", "check", "n", "prefix", "keys"])

    key = F.xxhash64(F.col(id_col), F.col(text_col)).alias("key")
    return docs.select(key, F.col(id_col).cast("long"), text_col).mapInArrow(
        released(rows), "key long, id long, row long, check long, n long, prefix array<long>, keys array<long>")


def full_rows(docs: DataFrame, wanted: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``row, grams`` of the rows in ``wanted`` (``row, key``), read again from their texts."""

    def whole(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at, data, offsets in text_blocks(part.column(1)):
                grams, begin = sets_of(data, offsets, size)
                yield pa.RecordBatch.from_arrays([part.column(0)[at: at + len(offsets) - 1], _lists(grams, begin)], names=["row", "grams"])

    texts = docs.withColumn("key", F.xxhash64(F.col(id_col), F.col(text_col))).select("key", F.col(text_col).alias("_text"))
    found = texts.join(checked_broadcast(wanted), "key").select("row", "_text")
    return found.mapInArrow(released(whole), "row long, grams array<long>")


def verified(docs: DataFrame, pairs: DataFrame, rows: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Pairs ``a, b`` whose exact Jaccard similarity reaches the threshold, over all columns."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    grams = materialize(full_rows(docs, ends.join(rows.select("row", "key"), "row"), size, id_col, text_col).dropDuplicates(["row"]), "grams")
    joined = (pairs.select("a", "b").join(grams.toDF("a", "_x"), "a").join(grams.toDF("b", "_y"), "b")
              .select("a", "b", F.size("_x").alias("x"), F.size("_y").alias("y"), F.size(F.array_intersect("_x", "_y")).alias("o")))
    return joined.where(F.col("o") * 100 >= (F.col("x") + F.col("y") - F.col("o")) * percent).select("a", "b")


def similar_sizes(x: str, y: str, percent: int):
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def leader_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Each row with the smallest row that shares at least two of its min-hash keys."""
    keyed = rows.select("row", "n", F.posexplode("keys").alias("k", "value"))
    leaders = keyed.groupBy("k", "value").agg(F.min(F.struct("row", "n")).alias("leader"), F.count("*").alias("m")).where("m > 1")
    met = keyed.join(leaders, ["k", "value"]).where("row <> leader.row").where(similar_sizes("n", "leader.n", percent))
    return met.groupBy(F.col("leader.row").alias("a"), F.col("row").alias("b")).agg(F.count("*").alias("m")).where("m > 1").select("a", "b")


def open_columns(rows: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``gram, m, row, n, part, rest``: prefix columns whose rows are not all one component yet.

    ``m`` is the column's number of rows, ``part`` the row's component, ``rest`` how many of its
    n-grams lie behind its prefix.
    """
    p = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    marked = rows.join(labels, F.col("row") == F.col("node"), "left").select(
        "row", "n", "prefix", F.coalesce("component", "row").alias("part"), (F.col("n") - p).alias("rest"))
    postings = materialize(marked.select("row", "n", "part", "rest", F.explode("prefix").alias("gram")), "columns")
    mixed = postings.groupBy("gram").agg(F.count("*").alias("m"), F.min("part").alias("_p"), F.max("part").alias("_q"))
    return materialize(postings.join(mixed.where("_p <> _q").select("gram", "m"), "gram"), "open")


def families(columns: DataFrame) -> DataFrame:
    """``row, family, whole``: rows tied by long columns (more than FREQUENT rows), as components of a star each.

    ``whole`` says whether the family has at most MOST_FAMILY rows, and so is multiplied whole.
    """
    long = columns.where(F.col("m") > FREQUENT).select("gram", "row")
    stars = long.join(long.groupBy("gram").agg(F.min("row").alias("head")), "gram").select(F.col("row").alias("a"), F.col("head").alias("b"))
    found = materialize(components(stars.distinct()).toDF("row", "family"), "tied")
    # One row for more than MOST_FAMILY rows each.
    large = found.groupBy("family").agg(F.count("*").alias("_m")).where(F.col("_m") > MOST_FAMILY).select("family", F.lit(False).alias("whole"))
    return found.join(checked_broadcast(large), "family", "left").select("row", "family", F.coalesce("whole", F.lit(True)).alias("whole"))


def prefix_pairs(columns: DataFrame, family: DataFrame, percent: int) -> DataFrame:
    """First column block of the product, short columns: pairs of rows that may link.

    Overlaps within the block are summed per pair; a pair goes on only if they reach the overlap
    it needs less what its other columns could hold. Pairs of one component are settled, those of one
    family that is multiplied whole are left out. Others, rows of a larger family among them, either
    share no long column and are counted in full here, or are met by the long column.
    """
    whole = family.where("whole").select("row", "family")
    short = columns.where(F.col("m") <= FREQUENT).join(whole, "row", "left").withColumn("family", F.coalesce("family", "row"))
    x, y = short.alias("x"), short.alias("y")
    met = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.row") < F.col("y.row")) & (F.col("x.part") != F.col("y.part"))
                 & (F.col("x.family") != F.col("y.family")) & similar_sizes("x.n", "y.n", percent))
    need = needed("x.n", "y.n", percent) - F.greatest("x.rest", "y.rest")
    counted = met.groupBy(F.col("x.row").alias("a"), F.col("y.row").alias("b")).agg(
        F.count("*").alias("o"), F.first(need).alias("need"))
    return counted.where("o >= need").select("a", "b")


def needed(x: str, y: str, percent: int):
    """Least overlap of linked rows of these sizes: ceil(percent (x + y) / (100 + percent))."""
    return F.expr(f"CAST(({percent} * ({x} + {y}) + {99 + percent}) DIV {100 + percent} AS LONG)")


def family_links(docs: DataFrame, rows: DataFrame, columns: DataFrame, family: DataFrame, percent: int, size: int,
                 id_col: str, text_col: str) -> DataFrame:
    """Links ``a, b`` inside families: whole rows, multiplied block of rows by block of rows.

    A family is cut into blocks of BLOCK_ROWS rows or BLOCK_GRAMS n-grams, whichever is less, and every pair of
    blocks is one group of bounded size. A family too large for that falls back to its long columns, one by one; its pairs without
    a shared long column are left to ``prefix_pairs``. Of each product only
    links that join what is not joined yet are given: a spanning forest.
    """
    whole = family.where("whole").select(F.col("family").alias("unit"), "row")
    apart = (columns.where(F.col("m") > FREQUENT).join(family.where("NOT whole").select("row"), "row")
             .select(F.xxhash64("gram").alias("unit"), "row"))
    units = materialize(whole.unionByName(apart), "units")
    sizes = units.join(rows.select("row", "n"), "row")
    cuts = sizes.groupBy("unit").agg(F.greatest(F.ceil(F.count("*") / F.lit(BLOCK_ROWS)), F.ceil(F.sum("n") / F.lit(BLOCK_GRAMS))).cast("int").alias("cuts"))
    cut = units.join(cuts, "unit").withColumn("own", F.pmod(F.xxhash64("row"), F.col("cuts").cast("long")).cast("int"))
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).select(
        "row", "unit", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own")
    ends = units.select("row").distinct().join(rows.select("row", "key"), "row")
    grams = full_rows(docs, ends, size, id_col, text_col).dropDuplicates(["row"])
    parts = columns.select("row", "part").distinct()
    filled = dealt.join(grams.join(parts, "row"), "row")

    def multiply(table: pa.Table) -> pa.Table:
        own = table.column("own").to_numpy()
        lists = table.column("grams").combine_chunks()
        a, b = block_links(table.column("row").to_numpy(), table.column("part").to_numpy(), lists.flatten().to_numpy(),
                           lists.value_lengths().to_numpy(), own == table.column("i")[0].as_py(), own == table.column("j")[0].as_py(), percent)
        return pa.table({"a": a, "b": b})

    return filled.groupBy("unit", "i", "j").applyInArrow(multiply, "a long, b long")


def block_links(row: np.ndarray, part: np.ndarray, grams: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray,
                percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the left and the right rows of a block that join different components.

    Column blocks are multiplied in turn; a row without a pair that can still reach the overlap it
    needs leaves the product.
    """
    _, column, seen = np.unique(grams, return_inverse=True, return_counts=True)
    own = np.repeat(np.arange(len(row)), sizes)
    shared = seen[column] > 1
    own, column = own[shared], column[shared]
    # Most frequent columns first: they decide soonest. Only shared columns can add to an overlap.
    place = np.empty(len(seen), np.int64)
    place[np.argsort(-seen, kind="stable")] = np.arange(len(seen))
    column = place[column]
    order = np.argsort(column, kind="stable")
    own, column = own[order], column[order]
    i, j = np.flatnonzero(left), np.flatnonzero(right)
    need = -(-percent * (sizes[i][:, None] + sizes[j][None, :]) // (100 + percent))
    overlap = np.zeros((len(i), len(j)), np.float32)
    remaining = np.bincount(own, minlength=len(row))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMN_BLOCK):
        a, b = np.searchsorted(column, [low, low + COLUMN_BLOCK])
        block = np.zeros((len(row), COLUMN_BLOCK), np.float32)
        block[own[a:b], column[a:b] - low] = 1
        overlap += block[i] @ block[j].T
        remaining = remaining - np.bincount(own[a:b], minlength=len(row))
        alive = overlap + np.minimum(remaining[i][:, None], remaining[j][None, :]) >= need
        rows_left, columns_left = alive.any(1), alive.any(0)
        if not rows_left.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not (rows_left.all() and columns_left.all()):
            i, j = i[rows_left], j[columns_left]
            overlap, need = overlap[rows_left][:, columns_left], need[rows_left][:, columns_left]
    x, y = np.nonzero(overlap >= need)
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while root.setdefault(v, v) != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    links = []
    for u, v in zip(i[x].tolist(), j[y].tolist()):
        p, q = find(int(part[u])), find(int(part[v]))
        if u != v and p != q:
            root[max(p, q)] = min(p, q)
            links.append((row[u], row[v]))
    found = np.array(links, np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, n_shingles, component_id, key, kept_key``: components of documents linked by n-gram Jaccard similarity.

    Two documents link when 100 * overlap >= percent * union. A text with fewer words than ``size`` is one
    n-gram; without words it is linked with nothing. Equal sets are one row of the matrix, so copies
    cost one row each and no pair; near copies are first tied to a leader they share min-hash
    keys with. Both only save work: every other pair that may reach the threshold shares a prefix
    column, and is met in ``family_links`` (long columns) or ``prefix_pairs`` (short ones). ``component_id`` is the smallest id
    of the component, nulls aside (null where all are null). Repeated rows get equal results.
    """
    docs = docs.select(id_col, text_col)
    frequent = frequent_columns(docs, size, percent, text_col)
    found = materialize(incidence(docs, frequent, size, percent, id_col, text_col), "incidence")
    # The document that stands for a set: smallest id, nulls last.
    named = F.min(F.struct(F.col("id").isNull().alias("_null"), "id", "key")).alias("_at")
    rows = found.where("n > 0").groupBy("row", "check", "n").agg(named, F.first("prefix").alias("prefix"), F.first("keys").alias("keys"))
    rows = rows.select("row", "check", "n", "_at", F.col("_at.key").alias("key"), "prefix", "keys")
    rows = materialize(rows, "rows")

    near = materialize(verified(docs, materialize(leader_pairs(rows, percent), "pairs"), rows, size, percent, id_col, text_col), "links")
    labels = components(near)
    columns = open_columns(rows, labels, percent)
    family = materialize(families(columns), "families")
    inside = materialize(family_links(docs, rows, columns, family, percent, size, id_col, text_col), "links")
    pairs = materialize(prefix_pairs(columns, family, percent), "pairs")
    far = verified(docs, pairs, rows, size, percent, id_col, text_col)
    labels = components(materialize(near.unionByName(inside).unionByName(far), "links"))

    parts = rows.join(labels, F.col("row") == F.col("node"), "left").select("row", "check", "n", "_at", F.coalesce("component", "row").alias("part"))
    parts = materialize(parts, "parts")
    smallest = parts.groupBy("part").agg(F.min("_at").alias("_first"))
    placed = parts.join(smallest, "part").select("row", "check", "n", F.col("_first.id").alias("component_id"), F.col("_first.key").alias("kept_key"))
    linked = found.where("n > 0").select("id", "key", "row", "check", "n").join(placed, ["row", "check", "n"])
    return linked.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "key", "kept_key").unionByName(
        found.where("n = 0").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), "key", F.col("key").alias("kept_key")))


def one_of_each(docs: DataFrame, size: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id. Other columns pass through.

    Rows without words are linked with nothing and stay. Of rows with the same id and text one stays.
    Only the keys of rows that go are matched with the documents.
    """
    found = materialize(jaccard_components(docs, size, percent, id_col, text_col), "components")
    gone = found.where("key <> kept_key").select("key").distinct()
    again = found.where("key = kept_key AND n_shingles > 0").groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1").select("key")
    name = free_name(docs, "row_key")
    keyed = docs.withColumn(name, F.xxhash64(id_col, text_col))
    stay = keyed.join(checked_broadcast(materialize(gone.toDF(name), "gone")), name, "left_anti")
    again = checked_broadcast(materialize(again.toDF(name), "again"))
    single = stay.join(again, name, "left_anti")
    repeated = stay.join(again, name, "left_semi").dropDuplicates([name])
    return single.unionByName(repeated).select(docs.columns)
