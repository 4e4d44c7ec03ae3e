"""Counts, rates and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The question types statistics are kept for.
QUESTION_TYPES = ["factual", "comparison", "reasoning", "open_ended"]


def percent(part: Column, whole: Column) -> Column:
    """'12.3%', ties to the even digit; '0.0%' of nothing."""
    share = F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))
    return F.format_string("%.1f%%", F.bround(share, 1))


def _text(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def _mean(total: Column, n: Column) -> Column:
    return F.coalesce(F.try_divide(total, n), F.lit(0.0))


def _total(counts: DataFrame, n: Column) -> Column:
    """Sum over all groups as a subquery, so that the groups never meet in one task."""
    return counts.select(F.sum(n).alias("total")).scalar()


def qa_stats(df: DataFrame) -> DataFrame:
    """One row: total pairs, count and share of each known type, average lengths over all pairs."""
    counted = df.agg(
        F.count("*").alias("total_qa_pairs"),
        *[F.count_if(F.col("question_type") == t).alias(f"{t}_count") for t in QUESTION_TYPES],
        F.coalesce(F.avg(F.char_length(_text("question"))), F.lit(0.0)).alias("average_question_length"),
        F.coalesce(F.avg(F.char_length(_text("answer"))), F.lit(0.0)).alias("average_answer_length"),
    )
    return counted.select(
        "*", *[percent(F.col(f"{t}_count"), F.col("total_qa_pairs")).alias(f"{t}_percent") for t in QUESTION_TYPES]
    )


def source_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("source_file", F.lit("unknown")).alias("source_file")).agg(
        F.count("*").alias("qa_pairs")
    )


def type_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("question_type", F.lit("unknown")).alias("question_type")).agg(
        F.count("*").alias("qa_pairs")
    )


def type_share(df: DataFrame, col: str = "type") -> DataFrame:
    """Count and percentage per type prefix (the part before the first underscore)."""
    prefix = F.split_part(F.coalesce(F.col(col), F.lit("unknown")), F.lit("_"), F.lit(1))
    counts = df.groupBy(prefix.alias("type_prefix")).agg(F.count("*").alias("qa_pairs"))
    return counts.withColumn("share", percent(F.col("qa_pairs"), _total(counts, F.col("qa_pairs"))))


def quality_report(df: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row: totals, pass rate against ``threshold``, average lengths, pairs per type.

    Aggregates per type first, so that the map is built from one row per type.
    """
    per_type = df.groupBy(F.coalesce("question_type", F.lit("unknown")).alias("t")).agg(
        F.count("*").alias("n"),
        F.count_if(F.coalesce("quality_label", F.lit(0)) == 1).alias("ok"),
        F.sum(F.char_length(_text("question"))).alias("q"),
        F.sum(F.char_length(_text("answer"))).alias("a"),
    )
    total = F.coalesce(F.sum("n"), F.lit(0))
    report = per_type.agg(
        total.alias("total_qa_pairs"),
        F.coalesce(F.sum("ok"), F.lit(0)).alias("passed_qa_pairs"),
        _mean(F.sum("ok"), total).alias("pass_rate"),
        _mean(F.sum("q"), total).alias("avg_question_length"),
        _mean(F.sum("a"), total).alias("avg_answer_length"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("t", "n")))).alias("question_types_distribution"),
    )
    return report.withColumn("quality_threshold", F.lit(float(threshold))).withColumn(
        "meets_threshold", F.col("pass_rate") >= F.col("quality_threshold")
    )


def file_stats(df: DataFrame, file: str = "source_file") -> DataFrame:
    """Files, results and results per file; counts per file first, so no distinct shuffle of rows."""
    return (
        df.groupBy(file)
        .agg(F.count("*").alias("n"))
        .agg(
            F.count(file).alias("total_files"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_results"),
            _mean(F.sum("n"), F.count(file)).alias("average_results_per_file"),
        )
    )


def batch_report(df: DataFrame, label: str = "input_dir") -> DataFrame:
    """Pairs per directory and one grand-total row with the integer average per directory."""
    per_dir = df.groupBy(label).agg(F.count("*").alias("n"))
    return (
        per_dir.rollup(label)
        .agg(F.sum("n").alias("qa_pairs"), F.count("*").alias("dirs"), F.grouping(label).alias("is_total"))
        .select(
            F.when(F.col("is_total") == 1, F.lit("TOTAL")).otherwise(F.col(label)).alias(label),
            "qa_pairs",
            F.when(F.col("is_total") == 1, F.expr("qa_pairs div dirs")).alias("average_per_dir"),
        )
    )


def final_dataset(df: DataFrame, meta: dict[str, str]) -> DataFrame:
    """Every pair with the run's metadata beside it."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in meta.items()])


def final_summary(df: DataFrame, meta: dict[str, str], threshold: float = 0.7) -> DataFrame:
    """The one-row header of the final set: metadata, total, threshold and pass rate."""
    totals = df.agg(
        F.count("*").alias("total_qa_pairs"),
        _mean(F.sum(F.when(F.col("quality_label") == 1, 1).otherwise(0)), F.count("*")).alias("quality_pass_rate"),
    )
    return totals.select(
        *[F.lit(v).alias(k) for k, v in meta.items()],
        "total_qa_pairs",
        F.lit(float(threshold)).alias("quality_threshold"),
        "quality_pass_rate",
    )


def observe_stage(df: DataFrame, name: str, error: str = "error") -> tuple[DataFrame, Observation]:
    """Count a stage's rows and errors while it is computed for its own sake.

    Use the returned frame in place of ``df``; the observation is filled by its first action.
    """
    seen = Observation(name)
    failed = F.count(error) if error in df.columns else F.count_if(F.lit(False))
    return df.observe(seen, F.count(F.lit(1)).alias("rows_out"), failed.alias("errors")), seen


def observed_report(spark: SparkSession, stages: dict[str, Observation]) -> DataFrame:
    """The stage report from observations already filled; reads no data again."""
    rows = [(i, n, o.get["rows_out"], o.get["errors"]) for i, (n, o) in enumerate(stages.items())]
    df = spark.createDataFrame(rows, "stage_order int, stage string, rows_out bigint, errors bigint")
    return df.withColumn("success", F.col("errors") == 0)


def stage_report(stages: dict[str, DataFrame], error: str = "error") -> DataFrame:
    """Rows and errors per stage. A stage without an error column has no errors."""

    def one(order: int, name: str, df: DataFrame) -> DataFrame:
        failed = F.count(error) if error in df.columns else F.lit(0).cast("bigint")
        return df.agg(F.count("*").alias("rows_out"), failed.alias("errors")).select(
            F.lit(order).alias("stage_order"),
            F.lit(name).alias("stage"),
            "rows_out",
            "errors",
            (F.col("errors") == 0).alias("success"),
        )

    return reduce(DataFrame.unionByName, [one(i, n, d) for i, (n, d) in enumerate(stages.items())])


def generation_report(df: DataFrame, targets: DataFrame) -> DataFrame:
    """Per question type: target, actual, share, achievement and the spread of quality scores.

    ``targets`` holds ``question_type, target``. Types on one side only appear as well.
    """
    actual = df.groupBy(F.coalesce("question_type", F.lit("unknown")).alias("question_type")).agg(
        F.count("*").alias("n"),
        F.min("quality_score").alias("min_quality"),
        F.avg("quality_score").alias("avg_quality"),
        F.max("quality_score").alias("max_quality"),
    )
    both = actual.join(targets, "question_type", "full_outer")
    n = F.coalesce("n", F.lit(0))
    total = _total(both, n)
    return both.select(
        "question_type",
        F.coalesce("target", F.lit(0)).cast("bigint").alias("target"),
        n.cast("bigint").alias("actual"),
        percent(n, total).alias("share"),
        F.when(F.col("target") > 0, percent(n, F.col("target"))).alias("achievement"),
        "min_quality",
        "avg_quality",
        "max_quality",
    )


def method_report(df: DataFrame, method: str = "generation_method") -> DataFrame:
    counts = df.groupBy(F.col(method).alias("generation_method")).agg(F.count("*").alias("qa_pairs"))
    return counts.withColumn("share", percent(F.col("qa_pairs"), _total(counts, F.col("qa_pairs"))))
