"""Prompts, model calls, and what is made of the replies."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from qaloom.functions import reply as rp
from qaloom.functions.text import first_int as first_int_of
from qaloom.operators import model, parse, prompts
from qaloom.plans.fixtures import (
    KNOWLEDGE_SQL, LINES_SQL, QA_SQL, REPLIES_SQL, REPLY_SCHEMA, documents, echo_client, echo_sql,
    first_int_sql, knowledge, lines, mcq, qa, replies, sql_escape,
)
from qaloom.plans.registry import query

TEMPLATES = {
    43: "Read the text from {source_file} and ask one factual question.\n{question}",
    44.0: "Compare two things in: {question} Reply as {{\"question\": ...}}",
    "45": "Reason about {question} given {answer}.",
    46: "Ask an open question on {question}",
}
REGISTRY = prompts.PromptRegistry(TEMPLATES)


@query(
    "prompt_registry",
    f"""WITH {QA_SQL} SELECT qa_id, coalesce(CASE conv_id % 5 WHEN 0 THEN 'Read the text from {{source_file}} and ask one factual question.' || chr(10) || '{{question}}'
      WHEN 1 THEN 'Compare two things in: {{question}} Reply as {{{{"question": ...}}}}' WHEN 2 THEN 'Reason about {{question}} given {{answer}}.'
      WHEN 3 THEN 'Ask an open question on {{question}}' END, '') AS template FROM qa""",
)
def prompt_registry(spark, sf_dir):
    ids = F.element_at(F.array(*[F.lit(i) for i in ("43", "44.0", "45", "46", "99")]), (F.col("conv_id") % 5 + 1).cast("int"))
    return REGISTRY.attach(qa(spark, sf_dir).select("qa_id", ids.alias("prompt_id"))).select("qa_id", "template")


PROMPT = 'Text {source_file}: {question}\nReply as {{"answer": "..."}} for type {question_type}.'


@query(
    "render_prompt",
    f"""WITH {QA_SQL} SELECT qa_id, 'Text ' || source_file || ': ' || question || chr(10) || 'Reply as {{"answer": "..."}} for type ' || coalesce(question_type, '') || '.' AS prompt FROM qa""",
)
def render_prompt(spark, sf_dir):
    return prompts.render_prompt(qa(spark, sf_dir), PROMPT).select("qa_id", "prompt")


def _json_list(expr: str) -> str:
    return f"""CASE WHEN len({expr}) = 0 THEN '[]' ELSE '["' || array_to_string({expr}, '","') || '"]' END"""


@query(
    "context_fallback",
    f"""WITH {KNOWLEDGE_SQL} SELECT source_file, chunk_index, CASE WHEN chunk_index % 2 = 0 AND line <> '' THEN line ELSE
      '{{"source_file":"' || source_file || '","key_concepts":' || {_json_list("key_concepts")} || ',"technical_details":{{"materials":' || {_json_list("materials")}
      || ',"parameters":[],"methods":' || {_json_list("methods")} || '}},"main_findings":["' || {sql_escape("line")} || '"],"context":"","text_content":""}}' END AS qa_context FROM knowledge""",
)
def context_fallback(spark, sf_dir):
    rows = knowledge(spark, sf_dir).withColumn("context", F.lit("")).withColumn(
        "text_content", F.when(F.col("chunk_index") % 2 == 0, F.element_at("main_findings", 1)).otherwise(F.lit(""))
    )
    return prompts.context_fallback(rows).select("source_file", "chunk_index", "qa_context")


@query(
    "domain_route",
    """SELECT doc_id, CASE lang WHEN 'de' THEN '44' WHEN 'fr' THEN '45' ELSE '43' END AS retrieval_prompt_id,
       CASE lang WHEN 'de' THEN '3431' WHEN 'en' THEN '3432' ELSE '343' END AS qa_prompt_id FROM documents""",
)
def domain_route(spark, sf_dir):
    return prompts.domain_route(
        documents(spark, sf_dir), {"de": 44, "fr": 45}, {"de": [3431, 343], "en": [3432], "fr": []}, "lang"
    ).select("doc_id", "retrieval_prompt_id", "qa_prompt_id")


@query(
    "domain_tag",
    """WITH hits AS (
      SELECT doc_id, contains(text, 'tion')::INT + contains(text, 'the')::INT + contains(text, 'ing')::INT AS a,
             contains(text, 'keit')::INT + contains(text, 'der')::INT + contains(text, 'sch')::INT AS b,
             contains(text, 'eau')::INT + contains(text, 'les')::INT + contains(text, 'tion')::INT AS c FROM documents)
    SELECT doc_id, greatest(a, b, c) AS domain_hits,
      CASE WHEN greatest(a, b, c) = 0 THEN 'other' WHEN a >= b AND a >= c THEN 'english' WHEN b >= c THEN 'german' ELSE 'french' END AS domain FROM hits""",
)
def domain_tag(spark, sf_dir):
    words = {"english": ["tion", "the", "ing"], "german": ["keit", "der", "sch"], "french": ["eau", "les", "tion"]}
    return prompts.domain_tag(documents(spark, sf_dir), "text", words, "other").select("doc_id", "domain_hits", "domain")


@query(
    "chat_messages",
    f"""WITH {QA_SQL} SELECT qa_id, CASE WHEN question_type IS NULL THEN 'user=' || question ELSE 'system=' || question_type || '|user=' || question END AS messages FROM qa""",
)
def chat_messages(spark, sf_dir):
    messages = prompts.chat_messages("question", "question_type")
    shown = F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|")
    return qa(spark, sf_dir).select("qa_id", shown.alias("messages"))


CALL = {"tries": 2, "pause": 0.0}


@query(
    "model_map",
    f"""WITH {QA_SQL} SELECT qa_id, {echo_sql("question")} AS reply, CASE WHEN md5(question)[1] = '0' THEN 'ConnectionError: model unavailable' END AS error FROM qa""",
)
def model_map(spark, sf_dir):
    return model.model_map(qa(spark, sf_dir), echo_client, "question", concurrency=4, **CALL).select("qa_id", "reply", "error")


@query("drop_failed", f"""WITH {QA_SQL} SELECT qa_id, {echo_sql("answer")} AS reply FROM qa WHERE {echo_sql("answer")} IS NOT NULL""")
def drop_failed(spark, sf_dir):
    return model.drop_failed(model.model_map(qa(spark, sf_dir), echo_client, "answer", **CALL)).select("qa_id", "reply")


def digest_embedder():
    """Eight numbers from the first hex digits of each text's MD5."""

    def embed(texts: list[str]) -> list[list[float]]:
        return [[int(c, 16) / 16.0 for c in hashlib.md5(t.encode()).hexdigest()[:8]] for t in texts]

    return embed


@query(
    "embed_map",
    "SELECT doc_id, array_to_string(list_transform(range(1, 9), lambda i: CAST('0x' || md5(text)[i] AS INT)), ',') AS digits FROM documents",
)
def embed_map(spark, sf_dir):
    vectors = model.embed_map(documents(spark, sf_dir), digest_embedder, "text")
    digits = F.transform("embedding", lambda x: (x * 16).cast("int").cast("string"))
    return vectors.select("doc_id", F.array_join(digits, ",").alias("digits"))


# --- replies --------------------------------------------------------------------------------------

FENCE_SQL = r"'```json\s*(\{[\s\S]*?\})\s*```'"


@query(
    "fenced_json_last",
    f"WITH {REPLIES_SQL} SELECT source_file, chunk_index, regexp_extract_all(content, {FENCE_SQL}, 1)[-1] AS block FROM replies",
)
def fenced_json_last(spark, sf_dir):
    return replies(spark, sf_dir).select("source_file", "chunk_index", rp.fenced_json("content", "last").alias("block"))


@query(
    "fenced_json_first",
    f"""WITH {REPLIES_SQL} SELECT source_file, chunk_index, coalesce(regexp_extract_all(content, {FENCE_SQL}, 1)[1], content) AS block FROM replies""",
)
def fenced_json_first(spark, sf_dir):
    return replies(spark, sf_dir).select(
        "source_file", "chunk_index", rp.reply_json("content", "raw", "first").alias("block")
    )


def parsed_sql(shapes: str, single: str = "7") -> str:
    """Rows of the given reply shapes with their parsed fields; other shapes do not parse."""
    return f"""{REPLIES_SQL},
parsed AS (
  SELECT source_file, chunk_index, total_chunks, text_content, shape,
         CASE WHEN shape = 6 THEN '无法设计出问题' WHEN shape = {single} THEN 'single ' || chunk_index ELSE 'What about line ' || chunk_index || '?' END AS question,
         text_content AS answer,
         CASE WHEN shape IN (6, {single}) OR chunk_index % 3 = 0 THEN NULL ELSE 'reasoning' END AS question_type
  FROM replies WHERE shape IN ({shapes})
)"""


@query(
    "raw_json_fallback",
    f"WITH {parsed_sql('0, 1, 2, 6, 7')} SELECT source_file, chunk_index, question, answer, question_type FROM parsed",
)
def raw_json_fallback(spark, sf_dir):
    kept = parse.parse_reply(replies(spark, sf_dir), REPLY_SCHEMA, "raw")
    return kept.select("source_file", "chunk_index", "parsed.question", "parsed.answer", "parsed.question_type")


@query(
    "brace_slice",
    f"WITH {parsed_sql('0, 1, 2, 3, 6, 7')} SELECT source_file, chunk_index, question, answer, question_type FROM parsed",
)
def brace_slice(spark, sf_dir):
    kept = parse.parse_reply(replies(spark, sf_dir), REPLY_SCHEMA, "brace")
    return kept.select("source_file", "chunk_index", "parsed.question", "parsed.answer", "parsed.question_type")


@query(
    "parse_typed",
    f"""WITH {REPLIES_SQL} SELECT shape, count(*) AS replies, count(*) FILTER (WHERE shape IN (0, 1, 2, 6, 7)) AS parsed,
    count(*) FILTER (WHERE shape NOT IN (0, 1, 2, 6, 7)) AS dropped FROM replies GROUP BY shape""",
)
def parse_typed(spark, sf_dir):
    return parse.parse_report(parse.mark_parsed(replies(spark, sf_dir), REPLY_SCHEMA), "shape")


@query(
    "attach_lineage",
    f"""WITH {parsed_sql('0, 1, 2, 6, 7')} SELECT question, coalesce(CASE WHEN shape <> 2 THEN source_file END, 'unknown') AS source_file,
    CASE WHEN shape <> 1 THEN chunk_index END AS chunk_index, CASE WHEN shape <> 1 THEN CASE WHEN shape = 0 THEN 1 ELSE total_chunks END END AS total_chunks, text_content FROM parsed""",
)
def attach_lineage(spark, sf_dir):
    rows = replies(spark, sf_dir)
    gaps = rows.withColumns(
        {
            "source_file": F.when(F.col("shape") != 2, F.col("source_file")),
            "chunk_index": F.when(F.col("shape") != 1, F.col("chunk_index")),
            "total_chunks": F.when(F.col("shape") != 0, F.col("total_chunks")),
        }
    )
    return parse.attach_lineage(parse.parse_reply(gaps, REPLY_SCHEMA)).select(
        "question", "source_file", "chunk_index", "total_chunks", "text_content"
    )


@query(
    "sentinel_reject",
    f"WITH {parsed_sql('0, 1, 2, 6, 7')} SELECT source_file, chunk_index, question FROM parsed WHERE NOT (question LIKE '%无法设计出问题%' OR answer LIKE '%无法设计出问题%')",
)
def sentinel_reject(spark, sf_dir):
    rows = parse.attach_lineage(parse.parse_reply(replies(spark, sf_dir), REPLY_SCHEMA))
    return parse.sentinel_reject(rows).select("source_file", "chunk_index", "question")


@query(
    "clean_mixed",
    f"""WITH {REPLIES_SQL}, q AS (
      SELECT *, CASE shape WHEN 6 THEN '无法设计出问题' WHEN 7 THEN 'single ' || chunk_index ELSE 'What about line ' || chunk_index || '?' END AS question,
             shape IN (0, 1, 6, 7) AS parses, chunk_index % 2 = 0 AS is_image, chunk_index % 4 = 1 AS has_pairs FROM replies)
    SELECT question, './' || source_file || '/auto/' || chunk_index || '.png' AS image_path, NULL AS source_file, NULL AS content_md5 FROM q WHERE is_image AND parses
    UNION ALL
    SELECT CASE WHEN parses AND NOT has_pairs THEN question END, NULL, source_file, md5(content) FROM q WHERE NOT is_image""",
)
def clean_mixed(spark, sf_dir):
    rows = replies(spark, sf_dir)
    i = F.col("chunk_index")
    image = F.concat(F.lit("/data/pdfs/"), "source_file", F.lit("/auto/"), i.cast("string"), F.lit(".png"))
    pair = F.array(F.struct(F.lit("q").alias("question")))
    mixed = rows.withColumn("image_path", F.when(i % 2 == 0, image)).withColumn("qa_pairs", F.when(i % 4 == 1, pair))
    cleaned = parse.clean_mixed(mixed, "question string", "question string")
    return cleaned.select("question", "image_path", "source_file", F.md5("content").alias("content_md5"))


@query(
    "default_question_type",
    f"""WITH {QA_SQL} SELECT qa_id, coalesce(question_type, 'factual') || '|factual' AS types FROM qa""",
)
def default_question_type(spark, sf_dir):
    def pair(kind):
        return F.struct(F.col("question"), kind.alias("question_type"))

    rows = qa(spark, sf_dir).select(
        "qa_id",
        F.lit("factual").alias("planned_type"),
        F.array(pair(F.col("question_type")), pair(F.lit(None).cast("string"))).alias("qa_pairs"),
    )
    filled = parse.default_question_type(rows)
    return filled.select("qa_id", F.array_join("qa_pairs.question_type", "|").alias("types"))


@query(
    "validate_fields",
    rf"""WITH {QA_SQL}, checked AS (SELECT qa_id,
      list_filter([CASE WHEN NOT (regexp_matches(question, '\S') AND length(question) <= 300) THEN 'question' END,
                   CASE WHEN NOT (regexp_matches(answer, '\S') AND length(answer) <= 300) THEN 'answer' END,
                   CASE WHEN question_type IS NULL THEN 'question_type' END], lambda f: f IS NOT NULL) AS failing FROM qa)
    SELECT qa_id, array_to_string(failing, ',') AS failing, len(failing) = 0 AS valid FROM checked""",
)
def validate_fields(spark, sf_dir):
    fields = ["question", "answer", "question_type"]
    rows = qa(spark, sf_dir).select("qa_id", *fields, F.array_join(parse.failing_fields(fields, 300), ",").alias("failing"))
    valid = parse.validate_fields(rows, fields, 300).select("qa_id", "failing", F.lit(True).alias("valid"))
    return valid.unionByName(rows.filter("failing <> ''").select("qa_id", "failing", F.lit(False).alias("valid")))


@query(
    "resolve_choice",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority WHEN o_orderkey % 6 < 5
      THEN (['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'])[CAST(o_orderkey % 6 AS INT) + 1] ELSE '5' END AS answer FROM orders""",
)
def resolve_choice(spark, sf_dir):
    return mcq(spark, sf_dir).select("id", rp.resolve_choice("answer", "choices").alias("answer"))


@query(
    "first_int",
    f"""WITH {LINES_SQL}, said AS (SELECT doc_id, ord, line || CASE ord % 5 WHEN 0 THEN ' Score: -1 of 10' WHEN 1 THEN ' 1' WHEN 2 THEN '' ELSE ' about ' || ord || ' points' END AS t FROM lines)
    SELECT doc_id, ord, {first_int_sql("t")} AS score FROM said""",
)
def first_int(spark, sf_dir):
    k = F.col("ord") % 5
    verdict = (
        F.when(k == 0, F.lit(" Score: -1 of 10")).when(k == 1, F.lit(" 1")).when(k == 2, F.lit(""))
        .otherwise(F.concat(F.lit(" about "), F.col("ord").cast("string"), F.lit(" points")))
    )
    said = F.concat("line", verdict)
    return lines(spark, sf_dir).select("doc_id", "ord", first_int_of(said).alias("score"))
