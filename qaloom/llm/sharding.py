"""Proportional stratified interleaving of rows into shards that all match the source mixture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.session import global_index, materialize


def interleave(rows: DataFrame, shards: int = 16, seed: int = 7, stratum: str = "source",
               partitions: int | None = None) -> DataFrame:
    """``rows`` plus ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    Rows of a stratum are ranked in a seeded shuffle; all rows are then sorted by
    (rank + 1/2) / size of the stratum and cut into runs whose lengths differ by one at most. A run
    therefore holds each stratum in its overall share, to within a row or so.

    Both orders are distributed sorts: a stratum with a third of all rows is split by the shuffle
    key, and numbers come from per-partition counts, never from a one-task window. Only the given
    columns move, so project first. A null stratum is a stratum; repeated rows each get a slot;
    columns named like the added ones are replaced. No rows in, no rows out.
    """
    columns = [c for c in rows.columns if c not in ("shard", "slot")]
    # Written once, since range partitioning samples its input and then reads it again.
    kept = materialize(
        rows.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col(f"`{stratum}`").alias("_stratum"))
        .withColumn("_key", F.xxhash64(F.lit(seed), F.col("_row"))),
        "strata",
    )
    order = ["_stratum", "_key", "_row"]
    ranked = materialize(global_index(kept, *order, name="_at", partitions=partitions), "ranked")
    sizes = ranked.groupBy("_stratum").agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
    share = (2 * (F.col("_at") - F.col("_first")) + 1) / (2 * F.col("_size"))
    mixed = ranked.alias("r").join(sizes.alias("s"), F.col("r._stratum").eqNullSafe(F.col("s._stratum")))
    mixed = mixed.select("_row", F.col("r._stratum").alias("_stratum"), "_key", share.alias("_share"))
    placed = global_index(materialize(mixed, "shares"), "_share", *[c for c in order if c != "_row"], "_row",
                          name="_at", total="_total", partitions=partitions)
    shard = F.expr(f"CAST((_at * {shards}) DIV _total AS INT)")
    # The first position with at * shards >= shard * total.
    start = F.expr(f"(shard * _total + {shards - 1}) DIV {shards}")
    return placed.withColumn("shard", shard).select("_row.*", "shard", (F.col("_at") - start).alias("slot"))


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within their part files."""
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
