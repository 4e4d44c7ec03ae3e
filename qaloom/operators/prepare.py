"""Document filters, samples and summaries ahead of generation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.functions.text import has_text, hash_bucket
from qaloom.session import first_rows

# Text lengths worth sending to a model.
MIN_TEXT_LENGTH = 50
MAX_TEXT_LENGTH = 10000


def length_filter(
    df: DataFrame, col: str = "content", low: int = MIN_TEXT_LENGTH, high: int = MAX_TEXT_LENGTH
) -> DataFrame:
    """Texts of ``low`` to ``high`` characters that are not blank."""
    return df.filter(F.char_length(col).between(low, high) & has_text(col))


def sample_documents(df: DataFrame, n: int, *key: str, seed: str = "0") -> DataFrame:
    """``n`` rows drawn without replacement, the same ones for the same seed and keys.

    ``key`` should be unique.
    """
    return first_rows(df, n, hash_bucket(*key, seed=seed), *key)


def corpus_summary(df: DataFrame) -> DataFrame:
    """Documents found, processed and failed, with page and image totals of the processed ones."""
    return df.agg(
        F.count("*").alias("documents_found"),
        F.count_if("success").alias("documents_processed"),
        F.count_if(~F.col("success")).alias("documents_failed"),
        F.coalesce(F.sum(F.when(F.col("success"), F.col("total_pages"))), F.lit(0)).alias("total_pages"),
        F.coalesce(F.sum(F.when(F.col("success"), F.col("total_images"))), F.lit(0)).alias("total_images"),
    )
