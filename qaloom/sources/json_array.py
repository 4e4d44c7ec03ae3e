"""JSON arrays of records as a splittable source.

A file that is one JSON array is read in byte ranges, cut at every closing brace. Whether such a brace ends a record
depends on all that stands before it: an odd number of quotes means it is inside a string, and the depth of
brackets outside strings tells which object it closes. Both are running sums over the pieces of a file,
so they are computed over ranges that many tasks read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.session import materialize, positions

_PLACE = ("block", "seq")


def _depth(text: Column) -> Column:
    """Opening less closing brackets."""
    return F.length(F.regexp_replace(text, r"[^\[{]", "")) - F.length(F.regexp_replace(text, r"[^\]}]", ""))


def _pieces(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """``file, block, seq, value, quotes, outside, inside``: what stands between closing braces, in file order by (block, seq).

    ``quotes`` counts quotes that are not escaped; ``outside`` and ``inside`` are the depths a piece adds if it begins
    outside or inside a string.
    """
    raw = (
        spark.read.option("lineSep", "}").option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("seq"), "value")
    )
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')

    def every_other(first: int) -> Column:
        return F.array_join(F.filter(F.col("_parts"), lambda x, i: i % 2 == first), "")

    return raw.withColumn("_parts", parts).select(
        "file", *_PLACE, "value", (F.size("_parts") - 1).alias("quotes"),
        _depth(every_other(0)).alias("outside"), _depth(every_other(1)).alias("inside"))


def json_array_texts(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """``file, record, json``: the text of each object of the arrays in the files under ``path``, numbered per file from 0.

    Elements that are no objects are skipped; an object that the end of a file cuts off is left out. Objects
    and strings in them may hold braces, quotes and line ends. A record is put together from its
    own pieces; no task holds a file.
    """
    pieces = materialize(_pieces(spark, path, glob), "json-pieces")
    slim = pieces.drop("value")
    quoted = positions(slim, "file", *_PLACE, before=F.col("quotes"))
    ends_inside = F.col("before").bitwiseAND(1) != F.col("quotes") % 2
    own = F.when(F.col("before") % 2 == 1, F.col("inside")).otherwise(F.col("outside")) - F.when(ends_inside, 0).otherwise(1)
    deep = positions(quoted.select("file", *_PLACE, own.alias("own"), ends_inside.alias("open")), "file", *_PLACE, depth=F.col("own"))
    ends = (~F.col("open") & (F.col("depth") + F.col("own") == 1)).cast("int")
    numbered = positions(deep.select("file", *_PLACE, ends.alias("ends")), "file", *_PLACE, record=F.col("ends"))
    in_order = F.sort_array(F.collect_list(F.struct(*_PLACE, "value")))
    whole = (
        pieces.select("file", *_PLACE, "value").join(numbered, ["file", *_PLACE])
        .groupBy("file", "record")
        .agg(F.array_join(F.transform(in_order, lambda p: p["value"]), "}").alias("text"), F.max("ends").alias("ends"))
    )
    # What precedes the record's own brace is a bracket, a comma or white space.
    return whole.filter("ends = 1").select("file", "record", F.concat(F.regexp_replace("text", r"^[^{]*", ""), F.lit("}")).alias("json"))


def json_array_source(spark: SparkSession, path: str, schema: T.StructType | str, glob: str = "*.json") -> DataFrame:
    """Records of ``schema`` from the JSON arrays in the files under ``path``. See ``json_array_texts``."""
    return json_array_texts(spark, path, glob).select(F.from_json("json", schema).alias("r")).select("r.*")
