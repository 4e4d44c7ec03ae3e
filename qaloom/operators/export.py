"""Training-ready shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.functions.reply import resolve_choice


def _turn(role: str, text: Column) -> Column:
    """A message with a text part and an image slot."""
    part = F.struct(F.lit("text").alias("type"), text.alias("text"))
    image = F.struct(F.lit("image").alias("type"), F.lit(None).cast("string").alias("text"))
    return F.struct(F.array(part, image).alias("content"), F.lit(role).alias("role"))


def export_vlm_chat(
    df: DataFrame,
    question: str = "question",
    answer: str = "answer",
    reasoning: str = "reasoning",
    image: str = "image_path",
    choices: str | None = "choices",
    root: str = "data/pdfs",
) -> DataFrame:
    """Chat samples: a user turn, an assistant turn with thinking and answer tags, image path."""
    final = F.col(answer)
    if choices and choices in df.columns:
        final = resolve_choice(answer, choices)
    reply = F.concat(
        F.lit("<thinking>\n"), F.coalesce(F.col(reasoning), F.lit("")), F.lit("\n</thinking>\n<answer>\n"),
        F.coalesce(final, F.lit("")), F.lit("\n</answer>\n"),
    )
    kept = [c for c in df.columns if c not in (question, answer, reasoning, image, choices)]
    return df.select(
        *kept,
        F.array(_turn("user", F.col(question))).alias("prompt"),
        F.concat(F.lit(root.rstrip("/") + "/"), F.regexp_replace(image, r"^(\./|/)", "")).alias("images"),
        F.array(_turn("assistant", reply)).alias("completions"),
    )


def export_instruction(df: DataFrame, domain: str) -> DataFrame:
    return df.select(
        F.col("question").alias("instruction"),
        F.col("answer").alias("output"),
        F.coalesce("reasoning", F.lit("")).alias("reasoning"),
        F.lit(domain).alias("domain"),
    )


def export_sft(df: DataFrame) -> DataFrame:
    """input, instruction, output, reasoning and image path; columns a set lacks are ''."""

    def field(name: str) -> Column:
        return (F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("")).alias(name)

    return df.select(*[field(n) for n in ("input", "instruction", "output", "reasoning", "image_path")])
