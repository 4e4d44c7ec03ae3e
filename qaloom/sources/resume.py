"""Skip what is done, add what is new, hand work out in batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.functions.text import as_col, path_tail
from qaloom.session import BROADCAST_MAX_ROWS, first_rows, global_index, is_small, materialize


# Bits of one bitmap of the aggregate, hashes of a key, and the most bits of a filter (32 MB).
BITMAP_BITS, HASHES, MOST_BITS = 1 << 15, 3, 1 << 28


def _bit(key: Column, number: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(number), key), F.lit(bits))


def bloom_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """``bucket, bitmap``: a Bloom filter of ``key`` as bitmaps of ``BITMAP_BITS`` bits, at most bits / BITMAP_BITS rows."""
    places = keys.select(F.explode(F.array(*[_bit(F.col(key), i, bits) for i in range(HASHES)])).alias("_bit"))
    return places.groupBy(F.expr(f"_bit div {BITMAP_BITS}").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("_bit") % BITMAP_BITS).alias("bitmap"))


def maybe_seen(df: DataFrame, key: str, filters: DataFrame, bits: int, name: str) -> DataFrame:
    """``df`` with the column ``name``: false where ``key`` is certainly not in the filter, which is broadcast."""
    for i in range(HASHES):
        bit = _bit(F.col(key), i, bits)
        of = filters.select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias(f"_bitmap{i}"))
        df = df.join(F.broadcast(of), F.expr("_bucket") == F.floor(bit / BITMAP_BITS), "left").drop("_bucket")

    def set_in(i: int) -> Column:
        place = _bit(F.col(key), i, bits) % BITMAP_BITS
        byte = F.conv(F.hex(F.substring(F.col(f"_bitmap{i}"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.coalesce(F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(1) == 1, F.lit(False))

    seen = set_in(0)
    for i in range(1, HASHES):
        seen = seen & set_in(i)
    return df.withColumn(name, seen).drop(*[f"_bitmap{i}" for i in range(HASHES)])


def resume(df: DataFrame, history: DataFrame, key: str | Column = "source_file", bloom: bool | None = None) -> DataFrame:
    """Rows whose ``key`` is absent from ``history``.

    History is reduced to distinct keys first, so a key that fills it weighs one row. A small one, by measure, is
    broadcast. A larger one (or ``bloom``) becomes a Bloom filter of ten bits a key, at most 32 MB, that every task
    probes: rows it rules out are new and stay where they are, and only the others, mostly those that
    are done, meet the history in an exact anti join. ``df`` is read once for each of the two parts.
    """
    key = as_col(key)
    done = history.select(key.alias("_done")).filter("_done IS NOT NULL").distinct()
    keyed = df.withColumn("_key", key)
    if bloom is None:
        bloom = not is_small(done, BROADCAST_MAX_ROWS)
    if not bloom:
        return keyed.join(done, F.col("_key") == F.col("_done"), "left_anti").drop("_key")
    done = materialize(done, "history")
    bits = BITMAP_BITS
    while bits < min(10 * done.count(), MOST_BITS):
        bits *= 2
    filters = materialize(bloom_filter(done, "_done", bits), "bloom")
    probed = maybe_seen(keyed, "_key", filters, bits, "_may")
    new = probed.filter(~F.col("_may"))
    again = probed.filter("_may").join(done, F.col("_key") == F.col("_done"), "left_anti")
    return new.unionByName(again).drop("_key", "_may")


def resume_images(df: DataFrame, history: DataFrame, path_col: str = "image_path") -> DataFrame:
    """The same, matching images on the last two path segments only."""
    return resume(df, history, path_tail(path_col, 2))


def merge_history(new: DataFrame, history: DataFrame) -> DataFrame:
    """New rows and history rows together, duplicates kept; ``is_history`` marks the latter."""
    return new.withColumn("is_history", F.lit(False)).unionByName(
        history.withColumn("is_history", F.lit(True)), allowMissingColumns=True
    )


def task_limit(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in ``order``, which should end in a unique column. Place it before a
    model call so only they are sent."""
    return first_rows(df, n, *order)


def batch_assign(df: DataFrame, size: int, *order: str) -> DataFrame:
    """Consecutive batches of ``size`` rows in ``order``, numbered from 0."""
    if size < 1:
        raise ValueError("batch size must be positive")
    indexed = global_index(df, *order, name="_row")
    return indexed.withColumn("batch_id", F.expr(f"_row div {int(size)}")).drop("_row")


def write_batches(df: DataFrame, path: str) -> None:
    """Each batch in a folder of its own, so finished batches survive a failed run."""
    df.write.partitionBy("batch_id").mode("append").parquet(path)
