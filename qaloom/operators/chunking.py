"""Overlapping text windows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Window size, overlap, and break points in order of preference.
CHUNK_SIZE = 2000
CHUNK_OVERLAP = 200
SEPARATORS = ("\n\n", "。\n", "。", ".\n", ".", "\n")


def split_window(text: str, size: int, overlap: int, separators: tuple[str, ...]) -> list[str]:
    """Cut one text. The only step that is sequential inside a row: each cut depends on the last.

    A break is taken only if the following window starts later than this one, so the loop
    always advances; otherwise the next separator is tried, then the full window.
    """
    pieces, start, last = [], 0, len(text)
    while last - start > size:
        limit = start + size
        breaks = ((text.rfind(sep, start, limit), len(sep)) for sep in separators)
        cut = next((at + n for at, n in breaks if at >= 0 and at + n > start + overlap), limit)
        pieces.append(text[start:cut])
        start = cut - overlap
    pieces.append(text[start:])
    return pieces


def chunk_text(
    df: DataFrame,
    col: str = "content",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: tuple[str, ...] = SEPARATORS,
) -> DataFrame:
    """One row per window: the other columns, ``chunk_index`` (from 0), ``total_chunks``, ``chunk``.

    Only the text column crosses to Python (in Arrow batches); everything else stays in the
    JVM, and no shuffle is needed. Filter before this call: predicates are not pushed
    below a Python step. NULL texts give no rows.
    """
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")

    @F.arrow_udf("array<string>")
    def windows(texts: pa.Array) -> pa.Array:
        cut = (None if t is None else split_window(t, size, overlap, separators) for t in texts.to_pylist())
        return pa.array(cut, pa.list_(pa.string()))

    kept = [c for c in df.columns if c != col]
    return (
        df.select(*kept, windows(col).alias("_windows"))
        .select(
            *kept,
            F.size("_windows").alias("total_chunks"),
            F.posexplode("_windows").alias("chunk_index", "chunk"),
        )
        .select(*kept, "chunk_index", "total_chunks", "chunk")
    )


def chunk_meta(df: DataFrame, chunks: str = "chunks") -> DataFrame:
    """Unnest an array of chunks with index, total and the label of multi-chunk texts."""
    kept = [c for c in df.columns if c != chunks]
    # Exploding an expression, not a column, keeps Spark from filtering on it before the scan's
    # end, which would compute a derived array twice.
    present = F.coalesce(F.col(chunks), F.array().cast("array<string>"))
    exploded = df.select(
        *kept,
        F.size(chunks).alias("total_chunks"),
        F.posexplode(present).alias("chunk_index", "chunk"),
    )
    return exploded.withColumn("chunk_label", chunk_label())


def chunk_label():
    return F.when(
        F.col("total_chunks") > 1,
        F.format_string("(Chunk %d/%d)", F.col("chunk_index") + 1, F.col("total_chunks")),
    ).otherwise(F.lit(""))
