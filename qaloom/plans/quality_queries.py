"""Judging, rewriting, evolving and preference data."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaloom.functions.reply import reply_score as score_of
from qaloom.functions.text import escape_json, first_int
from qaloom.operators import augment, quality
from qaloom.operators.model import model_fanout, model_map
from qaloom.plans.fixtures import (
    MCQ_SQL, QA_SQL, bucket_sql, documents, echo_client, echo_sql, first_int_sql, judge_client, judge_sql, mcq, qa, single_quoted, table,
)
from qaloom.plans.registry import query
from qaloom.plans.report_queries import LABELLED_SQL, labelled

CALL = {"tries": 2, "pause": 0.0}

GAPPY_SQL = f"{QA_SQL}, gappy AS (SELECT qa_id, source_file, question_type, CASE WHEN turn % 5 = 1 THEN '' ELSE question END AS question, CASE WHEN conv_id % 7 <> 3 THEN answer END AS answer FROM qa)"


def gappy(spark, sf_dir):
    return qa(spark, sf_dir).select(
        "qa_id", "source_file", "question_type",
        F.when(F.col("turn") % 5 == 1, "").otherwise(F.col("question")).alias("question"),
        F.when(F.col("conv_id") % 7 != 3, F.col("answer")).alias("answer"),
    )


@query(
    "completeness_guard",
    f"""WITH {GAPPY_SQL} SELECT qa_id, CASE WHEN coalesce(question, '') = '' OR coalesce(answer, '') = '' THEN 0 END AS quality_label,
    CASE WHEN coalesce(question, '') = '' OR coalesce(answer, '') = '' THEN 'incomplete' END AS error FROM gappy""",
)
def completeness_guard(spark, sf_dir):
    return quality.completeness_guard(gappy(spark, sf_dir)).select("qa_id", "quality_label", "error")


VERIFIED_SQL = f"""{GAPPY_SQL},
s1 AS (SELECT *, coalesce(question, '') = '' OR coalesce(answer, '') = '' AS incomplete, {judge_sql("('Answer: ' || question)")} AS model_answer FROM gappy),
s2 AS (SELECT *, {judge_sql("('Q ' || question || ' A ' || answer || ' M ' || model_answer)")} AS verdict FROM s1),
verified AS (
  SELECT *, CASE WHEN incomplete THEN 'incomplete' WHEN verdict IS NULL THEN 'ConnectionError: model unavailable' END AS error,
         CASE WHEN incomplete OR verdict IS NULL THEN 0 ELSE {first_int_sql("verdict")} END AS quality_label FROM s2
)"""


def verified(spark, sf_dir):
    return quality.dual_stage_verify(
        gappy(spark, sf_dir), judge_client, "Answer: {question}", "Q {question} A {standard_answer} M {model_answer}", **CALL
    )


@query("dual_stage_verify", f"WITH {VERIFIED_SQL} SELECT qa_id, quality_label, error FROM verified")
def dual_stage_verify(spark, sf_dir):
    return verified(spark, sf_dir).select("qa_id", "quality_label", "error")


@query(
    "verification_details",
    f"""WITH {VERIFIED_SQL} SELECT qa_id, model_answer, verdict AS verification_response, length(question) AS question_length, length(answer) AS answer_length,
    length(model_answer) AS model_answer_length FROM verified WHERE error IS NULL""",
)
def verification_details(spark, sf_dir):
    return verified(spark, sf_dir).filter("error IS NULL").select("qa_id", "verification_details.*")


@query(
    "quality_split",
    f"WITH {LABELLED_SQL} SELECT qa_id, CASE quality_label WHEN 1 THEN 'high' ELSE 'low' END AS side FROM labelled WHERE quality_label IN (0, 1)",
)
def quality_split(spark, sf_dir):
    high, low = quality.quality_split(labelled(spark, sf_dir).select("qa_id", "quality_label"))
    return high.select("qa_id", F.lit("high").alias("side")).unionByName(low.select("qa_id", F.lit("low").alias("side")))


VOTES_SQL = f"""{QA_SQL},
votes AS (
  SELECT qa_id, vote, (['40', '37', '38'])[CAST(vote % 3 AS INT) + 1] AS prompt_id, question, answer, conv_id, turn FROM qa, (SELECT unnest(range(5)) AS vote)
)"""


def votes(spark, sf_dir):
    return quality.vote_expand(qa(spark, sf_dir), 5, [40, 37, 38])


@query("vote_expand", f"WITH {VOTES_SQL} SELECT qa_id, vote, prompt_id FROM votes")
def vote_expand(spark, sf_dir):
    return votes(spark, sf_dir).select("qa_id", "vote", "prompt_id")


@query(
    "vote_filter",
    f"""WITH {VOTES_SQL}, scored AS (SELECT qa_id, {first_int_sql("coalesce(" + judge_sql("(prompt_id || vote || question)") + ", '')")} AS score FROM votes)
    SELECT qa_id, question FROM qa WHERE qa_id IN (SELECT qa_id FROM scored GROUP BY qa_id HAVING avg(score) >= 0.6)""",
)
def vote_filter(spark, sf_dir):

    asked = votes(spark, sf_dir).select("qa_id", F.concat("prompt_id", F.col("vote").cast("string"), "question").alias("p"))
    judged = model_map(asked, judge_client, "p", **CALL).select("qa_id", first_int("reply").alias("score"))
    return quality.vote_filter(qa(spark, sf_dir), judged, ["qa_id"], 0.6).select("qa_id", "question")


NAMES = quality.CHECKS
DIMENSION_SQL = f"""{QA_SQL},
judged AS (SELECT qa_id, question, {', '.join(f"{judge_sql(f'({chr(39)}{n}{chr(39)} || question)')} AS r{i}" for i, n in enumerate(NAMES))} FROM qa),
checks AS (SELECT qa_id, {', '.join(f"CASE WHEN r{i} IS NULL THEN 0 WHEN {first_int_sql(f'r{i}')} = 1 THEN 1 ELSE -1 END AS s{i}, r{i}" for i in range(4))} FROM judged),
scored AS (SELECT *, (s0 + s1 + s2 + s3) / 4.0::DOUBLE AS overall_score FROM checks)"""


def checked(spark, sf_dir):
    rows = qa(spark, sf_dir).select("qa_id", "question", *[F.concat(F.lit(name), "question").alias(f"p{i}") for i, name in enumerate(NAMES)])
    rows = model_fanout(rows, judge_client, [(f"p{i}", f"r{i}", f"e{i}") for i in range(len(NAMES))], **CALL)
    checks = F.array(*[quality.check(n, f"r{i}", f"r{i}") for i, n in enumerate(NAMES)])
    return quality.dimension_score(rows.withColumn("checks", checks)).withColumn("error", F.col("e0"))


@query("dimension_score", f"WITH {DIMENSION_SQL} SELECT qa_id, round(overall_score, 6) AS overall_score, overall_score > 0 AS passed FROM scored")
def dimension_score(spark, sf_dir):
    return checked(spark, sf_dir).select("qa_id", F.round("overall_score", 6).alias("overall_score"), "passed")


@query(
    "suggestions",
    f"""WITH {DIMENSION_SQL} SELECT qa_id, array_to_string(list_filter([{', '.join(f"CASE WHEN s{i} <= 0 THEN '{n}: ' || coalesce(r{i}, 'needs improvement') END" for i, n in enumerate(NAMES))}], lambda x: x IS NOT NULL), '; ') AS suggestions FROM scored""",
)
def suggestions(spark, sf_dir):
    return checked(spark, sf_dir).select("qa_id", F.array_join(quality.suggestions(), "; ").alias("suggestions"))


@query(
    "reply_to_score",
    f"""WITH {QA_SQL}, j AS (SELECT qa_id, {judge_sql("answer")} AS r FROM qa) SELECT qa_id, CASE WHEN r IS NULL THEN 0 WHEN {first_int_sql("r")} = 1 THEN 1 ELSE -1 END AS score FROM j""",
)
def reply_to_score(spark, sf_dir):
    return model_map(qa(spark, sf_dir), judge_client, "answer", **CALL).select("qa_id", score_of("reply").alias("score"))


@query(
    "check_summary",
    f"WITH {DIMENSION_SQL} SELECT count(*) AS total, count(*) FILTER (WHERE overall_score > 0) AS passed, round(avg((overall_score > 0)::INT), 6) AS pass_rate FROM scored",
)
def check_summary(spark, sf_dir):
    return quality.check_summary(checked(spark, sf_dir)).withColumn("pass_rate", F.round("pass_rate", 6))


@query(
    "check_errors",
    f"""WITH {DIMENSION_SQL} SELECT qa_id, CASE WHEN r0 IS NULL THEN 0 ELSE overall_score END AS overall_score, overall_score > 0 AND r0 IS NOT NULL AS passed,
    CASE WHEN r0 IS NULL THEN 'ConnectionError: model unavailable' END AS error FROM scored""",
)
def check_errors(spark, sf_dir):
    return quality.check_errors(checked(spark, sf_dir)).select("qa_id", "overall_score", "passed", "error")


@query(
    "useful_filter",
    f"""WITH {QA_SQL} SELECT qa_id, CASE (conv_id + turn) % 6 WHEN 0 THEN 'useful' WHEN 1 THEN 'rejected' WHEN 2 THEN 'useful' WHEN 3 THEN 'rejected' ELSE 'rejected' END AS verdict
    FROM qa WHERE (conv_id + turn) % 6 <> 5""",
)
def useful_filter(spark, sf_dir):
    def quoting(before, said, after):
        return F.concat(F.lit(before), said, F.lit(after))

    why = escape_json("question")
    shapes = [quoting('{"useful": true, "why": "', why, '"}'), quoting('{"why": "', why, '", "useful": 0}'),
              quoting("{'why': '", single_quoted("question"), "', 'useful': 'yes'}"), quoting('{"useful": null, "why": "', why, '"}'),
              quoting('{"other": "', why, '"}'), quoting("no json: ", F.col("question"), "")]
    judge = F.element_at(F.array(*shapes), ((F.col("conv_id") + F.col("turn")) % 6 + 1).cast("int"))
    useful, rejected = quality.useful_filter(qa(spark, sf_dir).select("qa_id", judge.alias("judge_json")))
    return useful.select("qa_id", F.lit("useful").alias("verdict")).unionByName(
        rejected.select("qa_id", F.lit("rejected").alias("verdict"))
    )


@query(
    "choice_accuracy",
    f"""WITH {MCQ_SQL}, r AS (SELECT status, coalesce(CASE WHEN id % 3 = 0 THEN answer WHEN id % 6 < 5 THEN choices[CAST(id % 6 AS INT) + 1] ELSE answer END = choices[gt + 1], false) AS ok FROM mcq)
    SELECT status, count(*) AS total, count(*) FILTER (WHERE ok) AS correct, round(avg(ok::INT), 6) AS accuracy FROM r GROUP BY status""",
)
def choice_accuracy(spark, sf_dir):
    return quality.choice_accuracy(mcq(spark, sf_dir), "status", resolve=True).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "choice_accuracy_literal",
    f"""WITH {MCQ_SQL}, r AS (SELECT status, coalesce(answer = choices[gt + 1], false) AS ok FROM mcq)
    SELECT status, count(*) AS total, count(*) FILTER (WHERE ok) AS correct, round(avg(ok::INT), 6) AS accuracy FROM r GROUP BY status""",
)
def choice_accuracy_literal(spark, sf_dir):
    return quality.choice_accuracy(mcq(spark, sf_dir), "status").withColumn("accuracy", F.round("accuracy", 6))


@query("label_column", f"WITH {LABELLED_SQL} SELECT qa_id, quality_label, (quality_label = 1)::INT AS is_good FROM labelled")
def label_column(spark, sf_dir):
    return quality.label_column(labelled(spark, sf_dir)).select("qa_id", "quality_label", "is_good")


@query(
    "threshold_band",
    """WITH r AS (SELECT source, avg(quality) AS rate FROM documents JOIN labels USING (doc_id) GROUP BY source)
    SELECT source, round(rate, 6) AS rate, CASE WHEN rate >= 0.8 THEN 'strict' WHEN rate >= 0.6 THEN 'standard' WHEN rate >= 0.4 THEN 'loose' ELSE 'none' END AS band FROM r""",
)
def threshold_band(spark, sf_dir):
    rates = (
        documents(spark, sf_dir).select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id")
        .groupBy("source").agg(F.avg("quality").alias("rate"))
    )
    return rates.select("source", F.round("rate", 6).alias("rate"), quality.threshold_band("rate").alias("band"))


# --- rewriting and augmentation --------------------------------------------------------------------

STYLES = {"basic": "Rewrite: {question}", "advanced": "Rewrite well: {question} / {answer}", "professional": "As an expert: {question}"}


@query(
    "rewrite_prompts",
    f"""WITH {QA_SQL} SELECT qa_id, CASE conv_id % 3 WHEN 0 THEN 'Rewrite: ' || question WHEN 1 THEN 'Rewrite well: ' || question || ' / ' || answer ELSE 'As an expert: ' || question END AS rewrite_prompt FROM qa""",
)
def rewrite_prompts(spark, sf_dir):
    styled = qa(spark, sf_dir).withColumn(
        "style", F.element_at(F.array(*[F.lit(s) for s in augment.STYLES]), (F.col("conv_id") % 3 + 1).cast("int"))
    )
    return augment.rewrite_prompts(styled, STYLES, "style").select("qa_id", "rewrite_prompt")


@query(
    "rewrite_parse",
    f"""WITH {QA_SQL} SELECT CASE WHEN conv_id % 2 = 0 THEN 'New ' || qa_id END AS question, CASE WHEN conv_id % 2 = 0 THEN NULL ELSE 'plain ' || answer END AS rewritten_content,
    question AS original_question, answer AS original_answer, source_file FROM qa WHERE turn <> 4""",
)
def rewrite_parse(spark, sf_dir):
    rows = qa(spark, sf_dir)
    reply = F.when(F.col("turn") == 4, None).when(
        F.col("conv_id") % 2 == 0, F.concat(F.lit('{"question": "New '), "qa_id", F.lit('"}'))
    ).otherwise(F.concat(F.lit("plain "), "answer"))
    return augment.rewrite_parse(rows.withColumn("reply", reply), "question string")


@query(
    "rewrite_sample",
    f"SELECT doc_id, {bucket_sql(chr(39) + 'r' + chr(39), 'doc_id')} / 4294967296.0::DOUBLE < 0.3 AS rewrite FROM documents",
)
def rewrite_sample(spark, sf_dir):
    return augment.rewrite_sample(documents(spark, sf_dir).select("doc_id"), "doc_id", seed="r")


EVOLVE = {s: f"{s}: {{prompt}} | {{answer}}" for s in augment.STRATEGIES}


def seeds(spark, sf_dir):
    return qa(spark, sf_dir).select(
        "qa_id", F.col("question").alias("prompt"), "answer", F.col("source_file").alias("reasoning"),
        F.concat(F.lit("img/"), "qa_id", F.lit(".png")).alias("image_path"),
    )


STRATEGY_LIST = ", ".join(f"'{s}'" for s in augment.STRATEGIES)


@query(
    "evolve_prompts",
    f"WITH {QA_SQL} SELECT qa_id, s AS strategy, s || ': ' || question || ' | ' || answer AS evolve_prompt FROM qa, (SELECT unnest([{STRATEGY_LIST}]) AS s)",
)
def evolve_prompts(spark, sf_dir):
    return augment.evolve_prompts(seeds(spark, sf_dir), EVOLVE).select("qa_id", "strategy", "evolve_prompt")


PICK_SQL = f"""{QA_SQL},
draws AS (SELECT qa.*, s AS strategy, row_number() OVER (PARTITION BY qa_id ORDER BY {bucket_sql("s", "qa_id")}, s) AS rn FROM qa, (SELECT unnest([{STRATEGY_LIST}]) AS s)),
picked AS (SELECT *, strategy || ': ' || question || ' | ' || answer AS evolve_prompt FROM draws WHERE rn = 1)"""


@query("evolve_select", f"WITH {PICK_SQL} SELECT qa_id, strategy, evolve_prompt FROM picked")
def evolve_select(spark, sf_dir):
    return augment.evolve_select(seeds(spark, sf_dir), EVOLVE, "qa_id").select("qa_id", "strategy", "evolve_prompt")


@query(
    "evolve_dataset",
    f"""WITH {PICK_SQL}, e AS (SELECT *, {echo_sql("evolve_prompt")} AS instruction FROM picked),
    a AS (SELECT *, {echo_sql("(question || ' > ' || strategy || ' > ' || instruction)")} AS new_output FROM e WHERE instruction IS NOT NULL)
    SELECT qa_id, strategy, instruction, new_output, question AS original_question, answer AS original_answer, source_file AS original_reasoning_content, 'img/' || qa_id || '.png' AS image_path
    FROM a WHERE new_output IS NOT NULL""",
)
def evolve_dataset(spark, sf_dir):
    return augment.evolve_dataset(
        seeds(spark, sf_dir), echo_client, EVOLVE, "{prompt} > {strategy} > {instruction}", "qa_id", **CALL
    )


def label_client():
    """Calls a candidate positive, negative, or answers without JSON, by the prompt's digest."""
    ask = echo_client()

    def judge(prompt: str) -> str:
        head = ask(prompt)[6]
        if head in "123":
            return "not json"
        return '{"response": "r", "label": "%s"}' % ("positive" if head in "456789" else "negative")

    return judge


PREFERENCE_SQL = f"""{QA_SQL},
c AS (SELECT qa_id, question, answer, k, {echo_sql("(question || '#' || k)")} AS response FROM qa, (SELECT unnest(range(5)) AS k)),
l AS (SELECT *, CASE WHEN md5(answer || '~' || response)[1] IN ('4', '5', '6', '7', '8', '9') THEN 'positive' ELSE 'negative' END AS label FROM c WHERE response IS NOT NULL)"""


def preferences(spark, sf_dir):
    rows = qa(spark, sf_dir).select("qa_id", "question", "answer")
    return augment.preference_sample(
        rows, echo_client, label_client, "{question}#{sample}", "{answer}~{response}", "qa_id", **CALL
    )


@query(
    "preference_sample",
    f"WITH {PREFERENCE_SQL} SELECT qa_id, question, string_agg(response || '=' || label, ',' ORDER BY k) AS samples FROM l GROUP BY qa_id, question",
)
def preference_sample(spark, sf_dir):
    shown = F.transform("samples", lambda s: F.concat_ws("=", s["response"], s["label"]))
    return preferences(spark, sf_dir).select("qa_id", "question", F.array_join(shown, ",").alias("samples"))


@query(
    "preference_pairs",
    f"""WITH {PREFERENCE_SQL} SELECT qa_id, coalesce(string_agg(response, ',' ORDER BY k) FILTER (WHERE label = 'positive'), '') AS positives,
    coalesce(string_agg(response, ',' ORDER BY k) FILTER (WHERE label = 'negative'), '') AS negatives FROM l GROUP BY qa_id""",
)
def preference_pairs(spark, sf_dir):
    pairs = augment.preference_pairs(preferences(spark, sf_dir))
    return pairs.select("qa_id", *[F.array_join(c, ",").alias(c) for c in ("positives", "negatives")])


def rephrase_client():
    """Answers with JSON naming the prompt's digest; nothing usable for one prompt in sixteen."""
    ask = echo_client()
    return lambda prompt: '{"input": "%s", "output": "ok"}' % ask(prompt)


@query(
    "rephrase_sft",
    f"""WITH {QA_SQL}, r AS (SELECT *, {echo_sql("('Rephrase ' || question || ' as ' || coalesce(question_type, ''))")} AS input FROM qa)
    SELECT qa_id, input, 'ok' AS output, question AS original_question, answer AS original_answer FROM r WHERE input IS NOT NULL""",
)
def rephrase_sft(spark, sf_dir):
    rows = qa(spark, sf_dir).select("qa_id", "question", "answer", "question_type")
    out = augment.rephrase_sft(rows, rephrase_client, "Rephrase {question} as {question_type}", "input string, output string", **CALL)
    return out.drop("question_type")


@query(
    "instruction_compose",
    rf"WITH {QA_SQL} SELECT qa_id, regexp_replace(question, '^\s+|\s+$', '', 'g') || chr(13) || chr(10) || regexp_replace(answer, '^\s+|\s+$', '', 'g') AS prompt FROM qa",
)
def instruction_compose(spark, sf_dir):
    padded = qa(spark, sf_dir).select(
        "qa_id", F.concat(F.lit("  \n"), "question", F.lit("\t ")).alias("instruction"), F.concat("answer", F.lit("\n\n")).alias("input")
    )
    return padded.select("qa_id", augment.instruction_compose().alias("prompt"))
