"""From raw replies to typed, traceable records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.functions.reply import REFUSAL, fenced_json, reply_json, typed_json
from qaloom.functions.text import has_text, image_rel_path

# Fields a cleaned record must have, and the longest a field may be.
REQUIRED_FIELDS = ["imageDescription", "analysisResults", "relatedKnowledge"]
MAX_FIELD_LENGTH = 5000


def parse_reply(
    df: DataFrame,
    schema: T.StructType | str,
    fallback: str = "raw",
    which: str = "last",
    col: str = "content",
    out: str = "parsed",
) -> DataFrame:
    """Parse each reply to ``schema``; rows that do not parse are dropped.

    Use :func:`mark_parsed` to keep and count them. The record comes out of a generator, so
    no later filter or field access makes Spark parse a reply a second time.
    """
    record = typed_json(reply_json(col, fallback, which), schema)
    return df.select("*", F.explode(F.array_compact(F.array(record))).alias(out))


def mark_parsed(
    df: DataFrame,
    schema: T.StructType | str,
    fallback: str = "raw",
    which: str = "last",
    col: str = "content",
    out: str = "parsed",
) -> DataFrame:
    record = typed_json(reply_json(col, fallback, which), schema)
    return df.select("*", F.explode(F.array(record)).alias(out)).withColumn("parse_ok", F.col(out).isNotNull())


def parse_report(marked: DataFrame, *by: str) -> DataFrame:
    """Parsed and dropped replies, optionally per group."""
    return marked.groupBy(*by).agg(
        F.count("*").alias("replies"),
        F.count_if("parse_ok").alias("parsed"),
        F.count_if(~F.col("parse_ok")).alias("dropped"),
    )


def attach_lineage(df: DataFrame, parsed: str = "parsed") -> DataFrame:
    """Flatten parsed replies and carry their source, chunk position and text along."""
    fields = [f for f in df.schema[parsed].dataType.fieldNames()]
    lineage = {
        "source_file": F.coalesce(F.col("source_file"), F.lit("unknown")),
        "chunk_index": F.col("chunk_index"),
        "total_chunks": F.when(F.col("chunk_index").isNotNull(), F.coalesce("total_chunks", F.lit(1))),
    }
    if "text_content" in df.columns:
        lineage["text_content"] = F.col("text_content")
    own = [F.col(parsed)[f].alias(f) for f in fields if f not in lineage]
    return df.select(*own, *[c.alias(n) for n, c in lineage.items()])


def sentinel_reject(df: DataFrame, columns: list[str] | None = None, sentinel: str = REFUSAL) -> DataFrame:
    """Drop records with the refusal text in any of their (text or array) fields."""
    names = columns or df.columns
    texts = []
    for name in names:
        kind = df.schema[name].dataType
        if isinstance(kind, T.StringType):
            texts.append(F.col(name))
        elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            texts.append(F.to_json(name))
    refused = F.exists(F.array(*texts), lambda t: F.coalesce(F.contains(t, F.lit(sentinel)), F.lit(False)))
    return df.filter(~refused)


def clean_mixed(df: DataFrame, image_schema: str, text_schema: str) -> DataFrame:
    """Clean image and text replies together.

    Image rows must hold a fenced object and get a relative image path. Text rows are all
    kept with their content, source, text and pairs ('' or [] when missing); fields of a fenced
    object override these where the row has no ``qa_pairs`` yet.
    """
    images = df.filter(F.col("image_path").isNotNull())
    images = parse_reply(images, image_schema, "none", out="_p")
    image_fields = [n for n in T.StructType.fromDDL(image_schema).fieldNames() if n != "image_path"]
    image_rows = images.select(
        *[F.col("_p")[n].alias(n) for n in image_fields], image_rel_path("image_path").alias("image_path")
    )

    own = {"content": F.lit(""), "source_file": F.lit(""), "text_content": F.lit("")}
    own["qa_pairs"] = F.array().cast(df.schema["qa_pairs"].dataType)
    texts = df.filter(F.col("image_path").isNull()).withColumn(
        "_p", F.when(F.col("qa_pairs").isNull(), typed_json(fenced_json("content"), text_schema))
    )
    fields = T.StructType.fromDDL(text_schema)
    selected = []
    for name, default in own.items():
        parts = [F.col(name), default]
        if name in fields.fieldNames():
            parts.insert(0, F.col("_p")[name])
        selected.append(F.coalesce(*parts).alias(name))
    for name in fields.fieldNames():
        if name in own:
            continue
        parts = [F.col("_p")[name]] + ([F.col(name)] if name in df.columns else [])
        selected.append(F.coalesce(*parts).alias(name))
    return image_rows.unionByName(texts.select(*selected), allowMissingColumns=True)


def default_question_type(df: DataFrame, planned: str = "planned_type", pairs: str = "qa_pairs") -> DataFrame:
    """Give QA pairs without a type the one their task was planned for."""
    return df.withColumn(
        pairs,
        F.transform(
            pairs,
            lambda p: p.withField("question_type", F.coalesce(p["question_type"], F.col(planned))),
        ),
    )


def failing_fields(required: list[str], max_length: int = MAX_FIELD_LENGTH) -> Column:
    """Names of required fields that are missing, blank or too long."""
    return F.array_compact(
        F.array(
            *[
                F.when(
                    ~F.coalesce(has_text(n) & (F.char_length(n) <= max_length), F.lit(False)), F.lit(n)
                )
                for n in required
            ]
        )
    )


def validate_fields(
    df: DataFrame, required: list[str] = REQUIRED_FIELDS, max_length: int = MAX_FIELD_LENGTH
) -> DataFrame:
    return df.filter(F.size(failing_fields(required, max_length)) == 0)
