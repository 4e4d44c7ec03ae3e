"""Record sources and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.sources.json_array import json_array_source


def records_source(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = True, split: bool = False
) -> DataFrame:
    """QA records by suffix: a JSON array, JSON lines, CSV with a header, or Parquet.

    A JSON array file is read by one task, unless ``split`` is set (which needs a ``schema``): then it is read in
    ranges, see ``json_array``. CSV with line ends in quotes is not split. JSON lines go with
    ``multi_line=False``. Pass ``schema`` to save the inference pass.
    """
    ext = path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = spark.read if schema is None else spark.read.schema(schema)
    if ext == "json" and split:
        if schema is None:
            raise ValueError("splitting needs a schema")
        return json_array_source(spark, path, schema)
    if ext in ("json", "jsonl", "ndjson"):
        return reader.json(path, multiLine=multi_line and ext == "json")
    if ext == "csv":
        return reader.csv(path, header=True, multiLine=True, quote='"', escape='"')
    if ext == "parquet":
        return reader.parquet(path)
    raise ValueError(f"unsupported record format: .{ext}")


def qa_flatten(df: DataFrame) -> DataFrame:
    """One row per QA pair with its source file; rows without ``qa_pairs`` pass through.

    An empty ``qa_pairs`` array gives no rows, a NULL one marks a plain record.
    """
    pair = df.schema["qa_pairs"].dataType.elementType
    plain = {f.name: f.dataType for f in df.schema.fields if f.name not in ("qa_pairs", "source_file")}
    types = {**plain, **{f.name: f.dataType for f in pair.fields if f.name != "source_file"}}

    def record(values: dict[str, Column], source: Column) -> Column:
        own = [
            (values[n] if n in values else F.lit(None)).cast(t).alias(n) for n, t in types.items()
        ]
        return F.struct(*own, source.alias("source_file"))

    source = F.coalesce(F.col("source_file"), F.lit("unknown"))
    nested = F.transform("qa_pairs", lambda p: record({n: p[n] for n in pair.fieldNames()}, source))
    itself = F.array(record({n: F.col(n) for n in plain}, F.col("source_file")))
    return df.select(F.explode(F.coalesce(nested, itself)).alias("_r")).select("_r.*")


def json_sink(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, UTF-8, non-ASCII text kept as it is."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def flat_cells(df: DataFrame) -> DataFrame:
    """Structs, arrays and maps as JSON text, so that every column fits a CSV cell."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        *[
            (F.to_json(f"`{f.name}`") if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")).alias(f.name)
            for f in df.schema.fields
        ]
    )


def csv_sink(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    flat_cells(df).write.mode(mode).csv(path, header=True, quote='"', escape='"')


def domain_sink(df: DataFrame, path: str, run: str, domain: str = "domain") -> None:
    """One output folder per domain and run. Appends, so runs never overwrite each other.

    Writers keep one open file per task and domain; tasks are not shuffled by domain, which
    would send a dominant domain to one task.
    """
    df.withColumn("run", F.lit(run)).write.mode("append").partitionBy(domain, "run").json(path)


def quality_fanout(checked: DataFrame, report: Callable[[DataFrame], DataFrame], path: str) -> dict[str, str]:
    """Write a checked set as detailed, high-quality, CSV and report outputs.

    The detailed rows are written first; the other outputs, ``report`` of the rows among them, read
    them back, so the judge model behind ``checked`` runs once and all outputs agree.
    """
    spark = checked.sparkSession
    out = {name: f"{path.rstrip('/')}/{name}" for name in ("detailed", "high_quality", "results", "report")}
    json_sink(checked, out["detailed"])
    stored = spark.read.schema(checked.schema).json(out["detailed"])
    json_sink(stored.filter("quality_label = 1"), out["high_quality"])
    csv_sink(stored, out["results"])
    json_sink(report(stored), out["report"])
    return out
