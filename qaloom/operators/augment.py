"""Rewriting, evolving and preference data."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.functions.reply import typed_json
from qaloom.functions.text import as_col, hash_bucket, hash_fraction, strip
from qaloom.operators.model import Client, drop_failed, model_map
from qaloom.operators.prompts import render, template_fields
from qaloom.session import materialize

# Rewriting styles, evolution strategies, shares and counts.
STYLES = ["basic", "advanced", "professional"]
STRATEGIES = ["constraints", "deepen", "concretizing", "reasoning", "breadth"]
REWRITE_RATIO = 0.3
PREFERENCE_SAMPLES = 5


def _template_choice(df: DataFrame, templates: Mapping[str, str], key: Column) -> Column:
    """The template ``key`` names, rendered; unknown keys give NULL."""
    out = F.lit(None).cast("string")
    for name, template in templates.items():
        fields = {n: n for n in template_fields(template) if n in df.columns}
        out = F.when(key == name, render(template, **fields)).otherwise(out)
    return out


def rewrite_prompts(df: DataFrame, templates: Mapping[str, str], style: str | Column = "basic") -> DataFrame:
    """Rewrite prompt of each row, in one style for all or by a style column."""
    if isinstance(style, str) and style not in df.columns:
        if style not in templates:
            raise KeyError(f"no template for style {style!r}")
        style = F.lit(style)
    return df.withColumn("rewrite_prompt", _template_choice(df, templates, as_col(style)))


def rewrite_parse(df: DataFrame, schema: str, reply: str = "reply") -> DataFrame:
    """JSON replies as fields, other replies as ``rewritten_content``; originals beside both."""
    parsed = typed_json(reply, schema)
    staged = drop_failed(df, reply).withColumn("_p", parsed)
    fields = [f for f in staged.schema["_p"].dataType.fieldNames()]
    return staged.select(
        *[F.col("_p")[f].alias(f) for f in fields],
        F.when(F.col("_p").isNull(), F.col(reply)).alias("rewritten_content"),
        F.coalesce("question", F.lit("")).alias("original_question"),
        F.coalesce("answer", F.lit("")).alias("original_answer"),
        F.coalesce("source_file", F.lit("")).alias("source_file"),
        *([F.coalesce("image", F.lit("")).alias("image")] if "image" in df.columns else []),
    )


def rewrite_sample(df: DataFrame, *key: str, ratio: float = REWRITE_RATIO, seed: str = "") -> DataFrame:
    """Mark about ``ratio`` of the rows for rewriting, the same ones every time; all rows stay."""
    return df.withColumn("rewrite", hash_fraction(*key, seed=seed) < ratio)


def instruction_compose(instruction: str = "instruction", extra: str = "input") -> Column:
    first, second = (strip(F.coalesce(F.col(c), F.lit(""))) for c in (instruction, extra))
    return F.concat(first, F.lit("\r\n"), second)


def evolve_prompts(df: DataFrame, templates: Mapping[str, str]) -> DataFrame:
    """Every row with each evolution strategy and its prompt."""
    named = df.withColumn("strategy", F.explode(F.array(*[F.lit(s) for s in templates])))
    return named.withColumn("evolve_prompt", _template_choice(df, templates, F.col("strategy")))


def pick_strategy(strategies: list[str], *key: str, seed: str = "") -> Column:
    """One of the strategies, drawn by the row's key."""
    return F.array_min(
        F.array(
            *[
                F.struct(hash_bucket(*key, seed=f"{seed}{s}").alias("draw"), F.lit(s).alias("strategy"))
                for s in strategies
            ]
        )
    )["strategy"]


def evolve_select(df: DataFrame, templates: Mapping[str, str], *key: str, seed: str = "") -> DataFrame:
    """Every row with one drawn strategy and only that prompt rendered. No shuffle."""
    drawn = df.withColumn("strategy", pick_strategy(list(templates), *key, seed=seed))
    return drawn.withColumn("evolve_prompt", _template_choice(df, templates, F.col("strategy")))


def evolve_dataset(
    df: DataFrame,
    client_factory: Callable[[], Client],
    templates: Mapping[str, str],
    answer_template: str,
    *key: str,
    seed: str = "",
    with_reasoning: bool = False,
    **call,
) -> DataFrame:
    """Evolve each instruction (``prompt, answer, reasoning``) and answer the evolved one.

    The answer prompt may use {prompt}, {answer}, {reasoning}, {strategy}, {method} and
    {instruction}; the method is the reasoning of the evolving call, else the strategy's name. With
    ``with_reasoning`` the answering call's reasoning is added as ``reasoning_content``. Rows with
    a failed call are dropped.
    """
    trimmed = df.withColumns({c: strip(c) for c in ("prompt", "answer", "reasoning")})
    seeds = evolve_select(trimmed, templates, *key, seed=seed)
    evolved = drop_failed(model_map(seeds, client_factory, "evolve_prompt", "_evolved", "_e1", reasoning="_why", **call), "_evolved")
    evolved = evolved.withColumns({"instruction": strip("_evolved"), "method": F.coalesce("_why", "strategy")})
    names = {n: n for n in template_fields(answer_template)}
    answered = model_map(
        evolved.withColumn("_ap", render(answer_template, **names)), client_factory, "_ap", "new_output", "_e2", reasoning="reasoning_content", **call
    )
    carried = [c for c in ("image_path",) if c in df.columns] + (["reasoning_content"] if with_reasoning else [])
    return drop_failed(answered, "new_output").select(
        *key,
        "strategy",
        "instruction",
        "new_output",
        F.col("prompt").alias("original_question"),
        F.col("answer").alias("original_answer"),
        F.col("reasoning").alias("original_reasoning_content"),
        *carried,
    )


def preference_sample(
    df: DataFrame,
    sampler_factory: Callable[[], Client],
    judge_factory: Callable[[], Client],
    candidate_prompt: str,
    judge_prompt: str,
    *key: str,
    n: int = PREFERENCE_SAMPLES,
    **call,
) -> DataFrame:
    """``n`` candidate answers per question, each judged positive or negative.

    Templates use the columns of ``df``; the first also {sample} (the candidate's number), the
    second {response}. A judgement that is no JSON or names no label counts as negative. Group
    size is ``n`` per ``key``, which must be unique.
    """
    drawn = df.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    drawn = drawn.withColumn("_cp", render(candidate_prompt, **{f: f for f in template_fields(candidate_prompt)}))
    drawn = drop_failed(model_map(drawn, sampler_factory, "_cp", "response", "_e1", **call), "response")
    drawn = drawn.drop("_cp", "_e1").withColumn("response", strip("response"))
    # Written: the judge's step then runs in the workers of the sampler's, not beside them.
    drawn = materialize(drawn, "candidates")
    drawn = drawn.withColumn("_jp", render(judge_prompt, **{f: f for f in template_fields(judge_prompt)}))
    judged = model_map(drawn, judge_factory, "_jp", "_verdict", "_e2", **call)
    label = F.coalesce(typed_json("_verdict", "label string")["label"], F.lit("negative"))
    carried = [c for c in df.columns if c not in key]
    return (
        judged.withColumn("label", label)
        .groupBy(*key)
        .agg(
            *[F.any_value(c).alias(c) for c in carried],
            F.array_sort(F.collect_list(F.struct("sample", "response", "label"))).alias("_s"),
        )
        .withColumn(
            "samples",
            F.transform("_s", lambda s: F.struct(s["response"].alias("response"), s["label"].alias("label"))),
        )
        .drop("_s")
    )


def preference_pairs(df: DataFrame, samples: str = "samples") -> DataFrame:
    """The positive and the negative candidates of each question, as two lists."""

    def having(label: str) -> Column:
        mine = F.filter(samples, lambda s: s["label"] == label)
        return F.transform(mine, lambda s: s["response"])

    return df.withColumn("positives", having("positive")).withColumn("negatives", having("negative")).drop(samples)


MCQ_CARRIED = ["question", "answer", "choices", "lecture", "context", "image_path"]


def rephrase_sft(
    df: DataFrame, client_factory: Callable[[], Client], template: str, schema: str, **call
) -> DataFrame:
    """Re-author multiple-choice rows: parsed reply fields beside the original ones.

    Originals come out as ``original_<name>``. Failed calls and unparsable replies are skipped.
    """
    fields = {n: n for n in template_fields(template)}
    asked = model_map(df.withColumn("_p", render(template, **fields)), client_factory, "_p", "_r", "_e", **call)
    parsed = drop_failed(asked, "_r").select("*", F.explode(F.array_compact(F.array(typed_json("_r", schema)))).alias("_j"))
    names = parsed.schema["_j"].dataType.fieldNames()
    rest = [c for c in df.columns if c not in MCQ_CARRIED]
    return parsed.select(
        *rest,
        *[F.col("_j")[n].alias(n) for n in names],
        *[F.col(c).alias(f"original_{c}") for c in MCQ_CARRIED if c in df.columns],
    )
