"""Judging question-answer pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.functions.reply import reply_score, resolve_choice, typed_json
from qaloom.functions.text import as_col, first_int
from qaloom.operators.model import Client, model_map
from qaloom.operators.prompts import render

INCOMPLETE = "incomplete"

# The four checks of the multi-dimension score.
CHECKS = ["reasoning_validity", "question_clarity", "answer_correctness", "question_difficulty"]


def _blank(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit("")) == ""


def completeness_guard(df: DataFrame) -> DataFrame:
    """Label pairs without question or answer 0, with the reason; the others stay NULL."""
    missing = _blank("question") | _blank("answer")
    return df.withColumn("quality_label", F.when(missing, 0)).withColumn("error", F.when(missing, INCOMPLETE))


def verification_details(model_answer: str | Column, response: str | Column) -> Column:
    return F.struct(
        as_col(model_answer).alias("model_answer"),
        as_col(response).alias("verification_response"),
        F.char_length(F.coalesce("question", F.lit(""))).alias("question_length"),
        F.char_length(F.coalesce("answer", F.lit(""))).alias("answer_length"),
        F.char_length(F.coalesce(as_col(model_answer), F.lit(""))).alias("model_answer_length"),
    )


def dual_stage_verify(
    df: DataFrame,
    client_factory: Callable[[], Client],
    answer_prompt: str,
    verify_prompt: str,
    **call,
) -> DataFrame:
    """Have the model answer each question, then judge that answer against the reference one.

    Both templates may use {question}; the second also {standard_answer} and {model_answer}.
    Incomplete pairs are never sent. The label is the first signed integer of the judgement; a
    failed call gives label 0 and its error.
    """
    guarded = completeness_guard(df)
    ready = F.col("quality_label").isNull()
    first = model_map(
        guarded.withColumn("_p1", F.when(ready, render(answer_prompt, question="question"))),
        client_factory, "_p1", "_answer", "_error1", **call,
    )
    second_prompt = render(
        verify_prompt, question="question", standard_answer="answer", model_answer="_answer"
    )
    second = model_map(
        first.withColumn("_p2", F.when(F.col("_answer").isNotNull(), second_prompt)),
        client_factory, "_p2", "_verdict", "_error2", **call,
    )
    return (
        second.withColumn("error", F.coalesce("error", "_error1", "_error2"))
        .withColumn("quality_label", F.when(F.col("error").isNotNull(), 0).otherwise(first_int("_verdict")))
        .withColumn(
            "verification_details",
            F.when(F.col("error").isNull(), verification_details("_answer", "_verdict")),
        )
        .drop("_p1", "_p2", "_answer", "_verdict", "_error1", "_error2")
    )


def quality_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs labelled 1 and pairs labelled 0. Any other label is in neither."""
    return df.filter("quality_label = 1"), df.filter("quality_label = 0")


def label_column(df: DataFrame, label: str = "quality_label", out: str = "is_good") -> DataFrame:
    return df.withColumn(out, F.when(F.col(label) == 1, 1).otherwise(0))


def vote_expand(df: DataFrame, times: int, prompt_ids: list[int | str]) -> DataFrame:
    """Each row ``times`` times, its votes taking the prompt ids in turn."""
    ids = F.array(*[F.lit(str(i)) for i in prompt_ids])
    return df.withColumn("vote", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))).withColumn(
        "prompt_id", F.element_at(ids, (F.col("vote") % len(prompt_ids) + 1).cast("int"))
    )


def vote_filter(df: DataFrame, votes: DataFrame, key: list[str], pass_score: float = 1.0) -> DataFrame:
    """Rows whose mean vote reaches ``pass_score``. With votes of 1 and -1 and a pass score of 1
    that takes unanimity. ``votes`` holds the key and ``score``."""
    passed = votes.groupBy(*key).agg(F.avg("score").alias("_mean")).filter(F.col("_mean") >= pass_score)
    return df.drop("reasoning_content").join(passed.select(*key), key, "left_semi")


def check(name: str, reply: str | Column, reason: str | Column) -> Column:
    """One check's result: score 1 or -1 from the judge's reply, 0 when the call failed."""
    return F.struct(
        F.lit(name).alias("name"), reply_score(reply).alias("score"), as_col(reason).alias("reason")
    )


def dimension_score(df: DataFrame, checks: str = "checks") -> DataFrame:
    """Mean of the checks (0 without any) and whether it is positive. Row-wise."""
    total = F.aggregate(checks, F.lit(0), lambda a, c: a + c["score"])
    overall = F.coalesce(F.try_divide(total.cast("double"), F.size(checks)), F.lit(0.0))
    return df.withColumn("overall_score", overall).withColumn("passed", F.col("overall_score") > 0)


def suggestions(checks: str = "checks") -> Column:
    """'check: reason' for every check that did not pass."""
    failed = F.filter(checks, lambda c: c["score"] <= 0)
    return F.transform(failed, lambda c: F.concat(c["name"], F.lit(": "), F.coalesce(c["reason"], F.lit("needs improvement"))))


def check_errors(df: DataFrame, error: str = "error") -> DataFrame:
    """Rows whose check failed stay: score 0, not passed, error text and record untouched."""
    failed = F.col(error).isNotNull()
    return df.withColumn("overall_score", F.when(failed, F.lit(0.0)).otherwise(F.col("overall_score"))).withColumn(
        "passed", F.col("passed") & ~failed
    )


def check_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total"),
        F.count_if("passed").alias("passed"),
        F.coalesce(F.try_divide(F.count_if("passed"), F.count("*")), F.lit(0.0)).alias("pass_rate"),
    )


# Texts a JSON "useful" value can have and still mean no.
_FALSY = ["false", "0", "0.0", "", "null", "none", "[]", "{}"]


def useful_filter(df: DataFrame, judge: str = "judge_json") -> tuple[DataFrame, DataFrame]:
    """Rows the judge's JSON calls useful, and the rows it rejects. Unparsable replies are in
    neither."""
    verdict = typed_json(judge, "useful string")
    judged = df.select("*", F.explode(F.array_compact(F.array(verdict))).alias("_v"))
    useful = F.coalesce(~F.lower(F.trim("_v.useful")).isin(_FALSY), F.lit(False))
    return judged.filter(useful).drop("_v"), judged.filter(~useful).drop("_v")


def choice_correct(answer: str = "answer", gt: str = "gt", choices: str = "choices", resolve: bool = False) -> Column:
    """Whether the answer is the choice at ``gt`` (from 0), as texts; a missing choice is not.

    With ``resolve`` an integer answer first stands for the choice at that place.
    """
    given = resolve_choice(answer, choices) if resolve else F.col(answer)
    right = F.try_element_at(F.col(choices), F.col(gt).cast("int") + 1)
    return F.coalesce(given == right, F.lit(False))


def choice_accuracy(df: DataFrame, *by: str, resolve: bool = False) -> DataFrame:
    right = choice_correct(resolve=resolve)
    return df.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(right).alias("correct"),
        F.avg(right.cast("int")).alias("accuracy"),
    )


def threshold_band(col: str | Column) -> Column:
    """strict from 0.8, standard from 0.6, loose from 0.4, below that none."""
    t = as_col(col)
    return F.when(t >= 0.8, "strict").when(t >= 0.6, "standard").when(t >= 0.4, "loose").otherwise("none")
