"""Incremental ingestion of newly arrived files."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.sources.resume import resume


def incremental_ingest(
    spark: SparkSession,
    source_dir: str,
    sink: str,
    checkpoint: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    max_files_per_trigger: int = 1000,
    **options: str,
) -> None:
    """Process the files that arrived since the last call, then stop.

    The checkpoint's file log marks each file done together with its output, so a rerun after
    a failure neither skips nor repeats one. Drop ``max_files_per_trigger`` files at a time
    into a batch to keep memory level while a backlog is worked off.
    """
    stream = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .options(**options)
        .load(source_dir)
    )
    query = (
        transform(stream)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def keyed_ingest(
    spark: SparkSession,
    source_dir: str,
    sink: str,
    checkpoint: str,
    schema: T.StructType | str,
    key: str | list[str],
    fmt: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    max_files_per_trigger: int = 1000,
    **options: str,
) -> None:
    """As ``incremental_ingest``, with each ``key`` stored once, however often and in whatever file it arrives.

    A batch is written to a folder that its stream and number name, and a repeated one replaces what its
    failed attempt left: neither a batch that stops halfway nor one that was written but not logged
    loses or doubles rows. The keys of all other folders are the state: rows with one of them are
    left out, so files that arrive again, changed ones, and a lost checkpoint add nothing old. Of
    rows of one key in one batch the smallest stays, compared column by column. Rows with a null in the key are
    stored as they come. Read the sink with ``read_keyed``. One writer at a time.
    """
    keys = [key] if isinstance(key, str) else list(key)

    def store(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = transform(batch)
        whole = reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in keys])
        columns = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
        once = rows.filter(whole).groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min(columns).alias("_row")).select("_row.*")
        stored = read_keyed(session, sink, rows.schema)
        if stored is not None:
            mine = (F.col("_stream") == stream) & (F.col("_batch") == number)
            held = stored.filter(~mine).select(digest(keys).alias("_digest"))
            once = resume(once.withColumn("_digest", digest(keys)), held, "_digest").drop("_digest")
        new = once.unionByName(rows.filter(~whole))
        new.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/_stream={stream}/_batch={number}")

    query = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .options(**options)
        .load(source_dir)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def digest(keys: list[str]) -> Column:
    """SHA-256 of the key columns as one JSON text; null if one of them is."""
    whole = reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in keys])
    return F.when(whole, F.sha2(F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys])), 256))


def read_keyed(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame | None:
    """What ``keyed_ingest`` stored, with ``_stream`` and ``_batch``; None before the first batch."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{sink.rstrip('/')}")
    found = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(
        spark._jvm.org.apache.hadoop.fs.Path(folder, "_stream=*/_batch=*/*.parquet"))
    if not found:
        return None
    both = T.StructType([*schema, T.StructField("_stream", T.StringType()), T.StructField("_batch", T.LongType())])
    # Names that begin with "_" are hidden from a scan unless they name a partition.
    return spark.read.schema(both).parquet(sink)
