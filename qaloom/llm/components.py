"""Connected components of a link table, as rounds of distributed star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from qaloom.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 100) -> DataFrame:
    """``node, component``: every node of ``links`` with the smallest node it can reach.

    Alternates large-star and small-star rounds. Each is an aggregate (a node's smallest neighbour)
    and a join back, so the neighbours of one node never meet in one row. Every round is
    written to the shared folder. Null ends and self links are ignored.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    edges, before = written(edges.distinct())
    for _ in range(most_rounds):
        if not before[0]:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        # Larger neighbours move to the smallest neighbour, then smaller ones do.
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges, now = written(small.union(least).distinct())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct().toDF("node", "component"))


def written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, with their number and a sum of their hashes, both taken while writing."""
    seen = Observation()
    marked = edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
    stored = materialize(marked, "edges")
    found = seen.get
    return stored, (found["n"], found["h"])
