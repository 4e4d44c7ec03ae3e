"""Session set-up and the few cluster-level helpers every operator shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Position bits of monotonically_increasing_id(): the partition number sits above them.
_SLOT_BITS = 33

BROADCAST_MAX_ROWS = 200_000
ROWS_IN_ONE_TASK = 100_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
PYTHON_ROWS = 1000


PARTITION_BYTES = 256 * 1024 * 1024


def build_session(
    app_name: str = "qaloom", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with AQE on and UTC time. Arrow batches are bounded by bytes already.

    ``input_bytes`` sizes shuffles for the data at hand, about 256 MB a partition; AQE merges
    what turns out smaller. Further settings come as keywords, ``__`` standing for a dot.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Model calls must not be repeated by speculative copies of a task.
        "spark.speculation": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if input_bytes:
        wanted = -(-input_bytes // PARTITION_BYTES)
        settings["spark.sql.shuffle.partitions"] = str(max(wanted, 200))
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for materialised tables: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder of its own; on a
    cluster a missing setting is an error, because executors do not share local disks.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/qaloom"


def new_scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared scratch folder as Parquet and read it back.

    Cuts the lineage without depending on any executor staying alive, and keeps column
    pruning for whatever reads the result. Use it after model calls, which must not run twice.
    """
    spark = df.sparkSession
    path = new_scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checked_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is within bounds, else unchanged.

    The measurement reads at most ``max_rows + 1`` rows. Beyond the bounds the caller's join
    stays an ordinary shuffle join with the same result.
    """
    if is_small(df, max_rows, max_bytes):
        return F.broadcast(df)
    return df


def is_small(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    row_bytes = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    seen = df.limit(max_rows + 1).agg(
        F.count("*").alias("n"), F.coalesce(F.sum(row_bytes), F.lit(0)).alias("b")
    ).first()
    return seen["n"] <= max_rows and seen["b"] <= max_bytes


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan dealt out to all cores when it has fewer splits than there are cores.

    For CPU-heavy steps right after a scan: a file with one row group is read by one task
    however many cores are idle. Larger inputs pass through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def small_batches(spark: SparkSession, rows: int = PYTHON_ROWS) -> None:
    """Send at most ``rows`` rows to Python at once, for the rest of the session.

    A worker holds a batch several times over; with the default of 10,000 rows of text that grows with the
    rows of a partition, up to hundreds of megabytes in each worker.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = int(spark.conf.get(name))
    if held <= 0 or held > rows:
        spark.conf.set(name, str(rows))


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run inside the block go as each of them ends, not when the driver collects garbage.

    For loops that write one table after another, whose shuffles would add up on disk.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A configuration table; its size is known here, and a small one gets a broadcast hint."""
    df = spark.createDataFrame(rows, schema)
    n_bytes = sum(len(str(value)) for row in rows for value in row)
    small = len(rows) <= BROADCAST_MAX_ROWS and n_bytes <= BROADCAST_MAX_BYTES
    return F.broadcast(df) if small else df


def global_index(
    df: DataFrame,
    *order: str | Column,
    name: str = "row_index",
    total: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Dense 0-based row numbers over the whole frame in ``order``, without a one-task window.

    Rows are range-partitioned and sorted, written once with their slot inside the partition,
    and shifted by the number of rows in lower partitions. The offsets table has one row per
    partition, so its broadcast is bounded by the partition count. ``order`` should end in a
    unique column: ties make the numbering arbitrary and cannot be split over partitions.
    Project to the needed columns first, since the whole row is written.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    placed = materialize(
        ranged.sortWithinPartitions(*keys).withColumn("_slot", F.monotonically_increasing_id()),
        "index",
    )
    part = F.shiftright("_slot", _SLOT_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    below = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_offset"),
        F.sum("_n").over(everything).alias("_rows_in_all"),
    )
    slot = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    numbered = (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, slot + F.col("_offset"))
    )
    if total:
        numbered = numbered.withColumn(total, F.col("_rows_in_all"))
    return numbered.drop("_slot", "_part", "_offset", "_rows_in_all")


def positions(df: DataFrame, segment: str, *order: str | Column, **weights: Column) -> DataFrame:
    """``df`` with, for each keyword, the sum of its weight over the rows before this one in its segment, by ``order``.

    A segment of any size: rows are range-partitioned by (segment, order) and written; sums run
    within a range, and a range that begins inside a segment adds what earlier ranges hold of it. At
    most one segment reaches into a range from before, so that table has at most one row per
    partition and is broadcast. ``order`` should be unique within the segment.
    """
    keys = [F.col(segment), *[F.col(c) if isinstance(c, str) else c for c in order]]
    sums = {name: f"_sum_{name}" for name in weights}
    weighed = df.withColumns({sums[name]: w.cast("bigint") for name, w in weights.items()})
    placed = materialize(
        weighed.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_slot", F.monotonically_increasing_id()), "positions"
    ).withColumn("_part", F.shiftright("_slot", _SLOT_BITS))
    held = placed.groupBy("_part", segment).agg(*[F.sum(s).alias(s) for s in sums.values()])
    # Few rows a segment: the ranges it lies in.
    earlier = Window.partitionBy(segment).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = held.select(
        F.col("_part").alias("_in"), F.col(segment).alias("_of"), F.count("*").over(earlier).alias("_earlier"),
        *[F.sum(s).over(earlier).alias(f"{s}_before") for s in sums.values()],
    ).filter("_earlier > 0")
    within = Window.partitionBy("_part", segment).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({s: F.coalesce(F.sum(s).over(within), F.lit(0)) for s in sums.values()})
    met = (F.col("_part") == F.col("_in")) & F.col(segment).eqNullSafe(F.col("_of"))
    return local.join(F.broadcast(carried), met, "left").select(
        *df.columns, *[(F.col(s) + F.coalesce(f"{s}_before", F.lit(0))).alias(name) for name, s in sums.items()]
    )


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in ``order``.

    Few rows are a top-n per partition and one merge; more than one task should hold are cut off
    a distributed sort. Both give the same rows where ``order`` has no ties.
    """
    if n <= ROWS_IN_ONE_TASK:
        return df.orderBy(*order).limit(n)
    return global_index(df, *order, name="_row").filter(F.col("_row") < n).drop("_row")
