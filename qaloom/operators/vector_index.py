"""Exact nearest vectors from a partition index: cells around pivots, skipped by the triangle inequality.

Vectors are compared as points of the unit sphere, where the distance of two is sqrt(2 - 2 cosine). A node
lies in the cell of its nearest pivot and a cell knows its radius, so no node of it is nearer to a query than
the pivot's distance less the radius. A query reads the cells nearest to it, and then only those that may still
hold something better than its k-th best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.operators.retrieval import _NONE, _RESULT, QUERY_BLOCK, SCORE_DIGITS, TOP_K, _matrix, _scan, top_per_query
from qaloom.session import materialize, new_scratch_path

PIVOTS = 256
# The cell of vectors without direction: their cosine with anything is 0.
NO_DIRECTION = -1
# Slack for rounded scores and distances.
SLACK = 10.0 ** -SCORE_DIGITS


@dataclass
class VectorIndex:
    """A written index: nodes under ``path`` in folders by cell; per cell its pivot, radius and number of nodes.

    ``read`` lists the nodes read by each search so far.
    """

    path: str
    pivots: np.ndarray
    radius: np.ndarray
    counts: np.ndarray
    undirected: int
    read: list[int] = field(default_factory=list)

    @property
    def size(self) -> int:
        return int(self.counts.sum()) + self.undirected


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * points @ pivots.T, 0))


def build_index(nodes: DataFrame, pivots: int = PIVOTS, path: str | None = None) -> VectorIndex:
    """The index of ``node_id, vector``; null vectors are left out. Every node is in it.

    The ``pivots`` nodes with the smallest hashes of their ids are the pivots, a bounded sample; they fix how
    much is skipped, never what is found. Nodes are range-partitioned by (cell, id), so a cell with a third
    of them is many files.
    """
    spark = nodes.sparkSession
    path = path or new_scratch_path(spark, "vector-index")
    n = nodes.select(F.col("node_id").cast("bigint").alias("node_id"), F.col("vector").cast("array<double>").alias("vector")).filter("vector IS NOT NULL")
    directed = n.filter(F.exists("vector", lambda x: x != 0))
    chosen = directed.orderBy(F.xxhash64("node_id"), "node_id").limit(pivots).toArrow()
    points = np.unique(_matrix(chosen["vector"]), axis=0) if len(chosen) else np.zeros((0, 1))
    shared = spark.sparkContext.broadcast(points)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column(1))
            cell, far = np.full(len(rows), NO_DIRECTION, np.int32), np.zeros(len(rows))
            some = np.flatnonzero(rows.any(1))
            if len(some):
                distance = _distances(rows[some], shared.value)
                cell[some] = distance.argmin(1)
                far[some] = distance.min(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=["node_id", "vector", "cell", "far"])

    placed = materialize(n.mapInArrow(assign, "node_id bigint, vector array<double>, cell int, far double"), "cells")
    placed.drop("far").repartitionByRange("cell", "node_id").write.partitionBy("cell").parquet(path)
    radius, counts, undirected = np.zeros(len(points)), np.zeros(len(points), np.int64), 0
    # One row a cell.
    for row in placed.groupBy("cell").agg(F.max("far").alias("r"), F.count("*").alias("n")).collect():
        if row["cell"] == NO_DIRECTION:
            undirected = row["n"]
        else:
            radius[row["cell"]], counts[row["cell"]] = row["r"], row["n"]
    return VectorIndex(path, points, radius, counts, undirected)


def _scan_cells(spark, index: VectorIndex, queries: np.ndarray, wanted: np.ndarray, k: int) -> DataFrame:
    """(query_id, node_id, score) with query_id a row of ``queries``: each query over the cells ``wanted`` names for it.

    The last column of ``wanted`` stands for the vectors without direction. Only folders of wanted cells are read.
    """
    cells = np.flatnonzero(wanted.any(0))
    index.read[-1] += int(np.append(index.counts, index.undirected)[cells].sum())
    names = [NO_DIRECTION if c == len(index.counts) else int(c) for c in cells]
    stored = spark.read.schema("node_id bigint, vector array<double>, cell int").parquet(index.path) if index.size else spark.createDataFrame([], "node_id bigint, vector array<double>, cell int")
    shared = spark.sparkContext.broadcast((queries, wanted))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, asked = shared.value
        best = {}
        for batch in batches:
            ids, cell = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
            rows = _matrix(batch.column(1)) if batch.num_rows else None
            for c in np.unique(cell):
                mine, users = np.flatnonzero(cell == c), np.flatnonzero(asked[:, c])
                found = _scan(points[users], ids[mine], rows[mine], k, _NONE)
                for q, node, score in zip(users[found[0]].tolist(), found[1].tolist(), found[2].tolist()):
                    best.setdefault(q, []).append((-score, node))
        top = [(q, node, -score) for q, found in best.items() for score, node in sorted(found)[:k]]
        columns = list(zip(*top)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))],
                                         names=["query_id", "node_id", "score"])

    return stored.filter(F.col("cell").isin(names)).mapInArrow(scan, _RESULT)


def search_index(index: VectorIndex, queries: DataFrame, k: int = TOP_K) -> DataFrame:
    """Exact ``k`` nearest nodes by cosine of every (query_id, vector), as ``retrieval.vector_topk`` gives them.

    Queries go in blocks; a block is two scans. The first reads each query's nearest cells until they hold ``k``
    nodes, and gives a floor for its k-th best score; the second reads the cells that may hold a score of that floor
    or more. Ids are unique; queries without a vector have no rows.
    """
    spark = queries.sparkSession
    asked = materialize(queries.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("vector").cast("array<double>").alias("vector")).filter("vector IS NOT NULL"), "queries")
    blocks = max(1, -(-2 * asked.count() // QUERY_BLOCK))
    path = new_scratch_path(spark, "index-topk")
    index.read.append(0)
    for number in range(blocks):
        table = asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == number).toArrow()
        if not len(table) or not index.size:
            continue
        ids, points = table["query_id"].to_numpy(), _matrix(table["vector"])
        bound = np.zeros((len(ids), len(index.counts)))
        if len(index.counts):
            bound = np.maximum(_distances(points, index.pivots) - index.radius, 0)
        order = np.argsort(bound, axis=1, kind="stable")
        held = np.cumsum(index.counts[order], axis=1)
        first = np.zeros((len(ids), len(index.counts) + 1), bool)
        # Cells in order of their bounds, up to the one that completes k nodes.
        needed = np.concatenate([np.zeros((len(ids), 1), np.int64), held[:, :-1]], 1) < k if len(index.counts) else np.zeros((len(ids), 0), bool)
        np.put_along_axis(first, order, needed, axis=1)
        first[:, -1] = index.undirected > 0
        found = materialize(_scan_cells(spark, index, points, first, k), "nearest")
        floor = np.full(len(ids), -np.inf)
        # At most k rows a query of the block.
        for row in top_per_query(found, k).groupBy("query_id").agg(F.min("score").alias("s"), F.count("*").alias("n")).filter(F.col("n") >= k).collect():
            floor[row["query_id"]] = row["s"]
        most = 1 - bound ** 2 / 2
        # A query without direction has score 0 everywhere: its ties are decided by id, so it reads all.
        most[~points.any(1)] = np.inf
        then = (most + SLACK >= floor[:, None]) & ~first[:, :-1] & (index.counts > 0)
        then = np.concatenate([then, np.zeros((len(ids), 1), bool)], 1)
        named = spark.createDataFrame(pa.table({"query_id": np.arange(len(ids)), "id": ids}))
        for part in (found, _scan_cells(spark, index, points, then, k)):
            part.join(F.broadcast(named), "query_id").select(F.col("id").alias("query_id"), "node_id", "score").write.mode("append").parquet(path)
    if not index.size or not asked.head(1):
        return top_per_query(spark.createDataFrame([], _RESULT), k)
    return top_per_query(spark.read.schema(_RESULT).parquet(path), k)
