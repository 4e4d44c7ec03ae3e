"""The whole way from documents to judged question-answer pairs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.functions.reply import reply_json, typed_json
from qaloom.functions.text import has_text
from qaloom.operators import chunking, merge, parse, planning, quality, stats
from qaloom.operators.model import Client, drop_failed, model_map
from qaloom.operators.prompts import PromptRegistry, context_fallback, render
from qaloom.session import materialize
from qaloom.sources.records import qa_flatten

PAIRS = f"array<struct<{', '.join(f.replace(' ', ':') for f in merge.PAIR.split(', '))}>>"
KNOWLEDGE_SCHEMA = (
    f"qa_pairs {PAIRS}, key_concepts array<string>, "
    "technical_details struct<materials:array<string>, parameters:array<string>, methods:array<string>>, "
    "main_findings array<string>"
)


def text_to_qa(
    documents: DataFrame,
    client_factory: Callable[[], Client],
    registry: PromptRegistry,
    knowledge_prompt: int | str,
    answer_template: str,
    verify_template: str,
    type_prompts: Mapping[str, str] = planning.TYPE_PROMPTS,
    ratios: Mapping[str, float] = planning.TYPE_RATIOS,
    threshold: float = 0.7,
    rewrite_template: str | None = None,
    meta: Mapping[str, str] | None = None,
    **call,
) -> dict[str, DataFrame]:
    """Knowledge per source, generated pairs, their verdicts, the final set, and reports.

    ``final`` holds the pairs that passed, rewritten where ``rewrite_template`` (over {question} and
    {answer}) is given and its reply parses, beside the run's ``meta``; ``summary`` is its header.
    ``stages`` tells for each stage how many rows went in, failed, could not be parsed, and came out.

    ``documents`` holds ``source_file`` (unique) and ``content``. The knowledge template may use
    {chunk}, {source_file} and {chunk_label}; the templates of the question types {qa_context} and
    {source_file}. Each of the three model stages is written out before it is read, so no
    prompt is sent again by a later stage, and a rerun can start from the written tables.
    """
    chunks = chunking.chunk_text(documents.filter(has_text("content")).select("source_file", "content"))
    asked = registry.render_by_id(
        chunks.withColumns({"chunk_label": chunking.chunk_label(), "prompt_id": F.lit(str(knowledge_prompt))}),
        [knowledge_prompt],
    )
    asked = materialize(model_map(asked, client_factory, **call), "replies")
    replies = drop_failed(asked).select(
        "source_file", "chunk_index", "total_chunks", F.col("chunk").alias("text_content"), F.col("reply").alias("content")
    )
    parsed = materialize(parse.parse_reply(replies, KNOWLEDGE_SCHEMA), "parsed")
    records = parse.attach_lineage(parsed)
    knowledge = materialize(merge.merge_chunk_knowledge(records), "knowledge")

    keys = ["source_file"]
    planned = planning.plan_question_types(knowledge.select(keys), *keys, ratios=ratios)
    tasks = planning.explode_tasks(
        context_fallback(knowledge).select(*keys, "qa_context").join(planned, keys), registry, type_prompts
    )
    answers = materialize(model_map(tasks, client_factory, **call), "answers")
    generated = parse.parse_reply(drop_failed(answers), f"qa_pairs {PAIRS}", which="first", col="reply").select(
        "source_file", F.col("question_type").alias("planned_type"), F.col("parsed.qa_pairs").alias("qa_pairs")
    )
    generated = materialize(generated, "generated")
    pairs = qa_flatten(parse.default_question_type(generated.filter("qa_pairs IS NOT NULL")).drop("planned_type"))

    verified = materialize(
        quality.dual_stage_verify(pairs, client_factory, answer_template, verify_template, **call), "verified"
    )
    passed = verified.filter("quality_label = 1").select(pairs.columns)
    stages = [
        _stage("knowledge", asked, parsed.agg(F.count("*").alias("parsed"))),
        _stage("generation", answers, generated.agg(F.count("qa_pairs").alias("parsed"))),
        _stage("judgement", verified, passed.agg(F.count("*").alias("parsed"))),
    ]
    if rewrite_template:
        rewritten = materialize(
            model_map(passed.withColumn("_ask", render(rewrite_template, question="question", answer="answer")),
                      client_factory, "_ask", "_reply", "error", **call).drop("_ask"),
            "rewritten",
        )
        new = typed_json(reply_json("_reply"), "question string, answer string")
        marked = rewritten.withColumn("_new", new)
        stages.append(_stage("rewriting", rewritten, marked.agg(F.count("_new").alias("parsed"))))
        passed = marked.withColumns({c: F.coalesce(F.col("_new")[c], F.col(c)) for c in ("question", "answer")}).select(pairs.columns)
    return {
        "knowledge": knowledge,
        "pairs": verified.select(pairs.columns),
        "verified": verified,
        "report": stats.quality_report(verified, threshold),
        "final": stats.final_dataset(passed, dict(meta or {})),
        "summary": stats.final_summary(verified, dict(meta or {}), threshold),
        "stages": reduce(DataFrame.unionByName, stages),
    }


def _stage(name: str, called: DataFrame, came_out: DataFrame) -> DataFrame:
    """Rows in, failed calls, replies not usable, rows out of a written stage: sums to what went in."""
    counts = called.agg(F.count("*").alias("rows_in"), F.count("error").alias("failed")).select("*", F.lit(name).alias("stage"))
    both = counts.join(came_out.withColumn("stage", F.lit(name)), "stage")
    return both.select(
        "stage", "rows_in", "failed", (F.col("rows_in") - F.col("failed") - F.col("parsed")).alias("rejected"),
        F.col("parsed").alias("rows_out"),
    )
