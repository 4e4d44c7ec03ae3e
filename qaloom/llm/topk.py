"""Exact top-k inner products by columnar branch and bound.

Candidates lie in vertical layout: one contiguous array per dimension. Scores grow one block of
dimensions at a time. After each block the mass a candidate has left bounds what it can still
gain (Cauchy-Schwarz on the remaining dimensions); candidates that cannot reach the query's k-th best
score are dropped and the survivors are compacted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qaloom.session import materialize, new_scratch_path

EXACT = 2.0**53
SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def usable_vectors(rows: DataFrame, scale: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v``: components as floor(scale * x), x as double. Null vectors and vectors that hold
    null or non-finite components take no part, nor do rows without an id; other columns are dropped."""
    whole = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))
    finite = F.forall(F.col(vector).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def columns_of(vectors: pa.Array, dims: int | None = None) -> np.ndarray:
    """Vertical layout: an array per dimension, as doubles. Shorter vectors end in zeros."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
    wide = max(int(sizes.max(initial=0)), dims or 0)
    out = np.zeros((wide, len(sizes)))
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[at, row] = flat
    return out


class Search:
    """Top k of a block of queries over blocks of candidates. Larger scores first, ties to smaller ids."""

    def __init__(self, ids: np.ndarray, columns: np.ndarray, k: int, block: int = 16):
        self.k, self.block = k, block
        # Dimensions with most query mass first: bounds tighten sooner.
        self.order = np.argsort(-np.square(columns).sum(1), kind="stable")
        self.ids, self.q = ids, columns[self.order]
        # left[b, j]: norm of query j over the dimensions after block b.
        self.cuts = list(range(0, len(columns), block)) + [len(columns)]
        mass = np.square(self.q)
        self.left = [np.sqrt(mass[end:].sum(0)) for end in self.cuts[1:]]
        self.best_ids = [np.zeros(0, np.int64)] * len(ids)
        self.best = [np.zeros(0)] * len(ids)

    def add(self, ids: np.ndarray, columns: np.ndarray) -> None:
        columns = columns[self.order] if len(columns) == len(self.order) else np.vstack(
            [columns, np.zeros((len(self.order) - len(columns), columns.shape[1]))])[self.order]
        if max(np.abs(self.q).max(initial=0), 1) * max(np.abs(columns).max(initial=0), 1) * max(len(columns), 1) >= EXACT:
            raise ValueError("components too large for exact scores")
        mass = np.square(columns)
        left = [np.sqrt(mass[end:].sum(0)) for end in self.cuts[1:]]
        firsts = range(len(self.cuts) - 1)
        # The first block is scored for all queries at once, later ones for survivors only.
        start = self.q[: self.cuts[1]].T @ columns[: self.cuts[1]] if len(columns) else np.zeros((len(self.ids), len(ids)))
        for j in range(len(self.ids)):
            alive, score = None, start[j]
            floor = self.best[j][-1] if len(self.best[j]) >= self.k else -np.inf
            for b in firsts:
                if b:
                    part = columns[self.cuts[b]: self.cuts[b + 1]]
                    score = score + self.q[self.cuts[b]: self.cuts[b + 1], j] @ (part if alive is None else part[:, alive])
                rest = left[b] if alive is None else left[b][alive]
                # One spare unit covers rounding of the norms; scores themselves are whole numbers.
                reach = self.left[b][j] * rest * (1 + 1e-9) + 1
                if len(score) > self.k:
                    floor = max(floor, np.partition(score - reach, len(score) - self.k - 1)[len(score) - self.k - 1])
                keep = np.flatnonzero(score + reach >= floor)
                if len(keep) < 0.7 * len(score):
                    alive = keep if alive is None else alive[keep]
                    score = score[keep]
            found = ids if alive is None else ids[alive]
            other = found != self.ids[j]
            all_ids = np.concatenate([self.best_ids[j], found[other]])
            scores = np.concatenate([self.best[j], score[other]])
            top = np.lexsort((all_ids, -scores))[: self.k]
            self.best_ids[j], self.best[j] = all_ids[top], scores[top]

    def rows(self) -> pa.RecordBatch:
        sizes = [len(b) for b in self.best]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.ids, sizes)), pa.array(np.concatenate(self.best_ids or [np.zeros(0, np.int64)])),
             pa.array(np.concatenate(self.best or [np.zeros(0)]).astype(np.int64))], schema=SCHEMA)


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, query_block: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest inner products, itself excluded.

    Both frames hold ``vec_id, v`` (see ``usable_vectors``). Queries come in blocks of at most
    ``query_block``, each small enough to travel with the task; every block is one narrow scan
    of the candidates, whose partitions send on k rows a query. Nothing but those is shuffled. Ids
    should be unique: a row with the query's id is the query's own. Vectors of unlike lengths
    count as ending in zeros. Fewer than k other rows: all of them.
    """
    spark = candidates.sparkSession
    path, shape = new_scratch_path(spark, "topk"), "query_id long, vec_id long, score long"
    asked = materialize(queries.select("vec_id", "v"), "queries")
    stored = materialize(candidates.select("vec_id", "v"), "vectors")
    total = asked.count()
    # Hash blocks differ in size, so several blocks aim at half the bound.
    blocks = 1 if total <= query_block else -(-2 * total // query_block)
    block_of = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")

    def scan(number: int) -> None:
        taken = asked.where(block_of == number).toArrow()
        if not taken.num_rows:
            return
        q_ids = taken.column("vec_id").to_numpy()
        q_columns = columns_of(taken.column("v").combine_chunks())

        def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = None
            for part in parts:
                columns = columns_of(part.column(1))
                dims = max(len(columns), len(q_columns))
                if found is None or len(found.order) < dims:
                    wide = np.vstack([q_columns, np.zeros((dims - len(q_columns), q_columns.shape[1]))])
                    earlier, found = found, Search(q_ids, wide, k)
                    if earlier is not None:
                        found.best, found.best_ids = earlier.best, earlier.best_ids
                found.add(part.column(0).to_numpy(), columns)
            if found is not None:
                yield found.rows()

        stored.mapInArrow(search, shape).write.mode("append").parquet(path)

    for number in range(blocks):
        scan(number)
    partial = spark.read.schema(shape).parquet(path) if total else spark.createDataFrame([], shape)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
