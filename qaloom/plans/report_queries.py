"""Merging, statistics and planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaloom.operators import merge, neardup, planning, stats
from qaloom.operators.prompts import PromptRegistry
from qaloom.plans.fixtures import (
    KNOWLEDGE_SQL, LINES_SQL, QA_SQL, REPLIES_SQL, SUBGRAPHS_SQL, bucket_sql, documents, graph_tables, knowledge, lines, qa, replies, table,
)
from qaloom.plans.registry import query
from qaloom.session import materialize


@query(
    "merge_chunk_text",
    f"""WITH {REPLIES_SQL} SELECT source_file, 0 AS part_index, md5(string_agg(content, chr(10) || chr(10) ORDER BY chunk_index)) AS content_md5,
    md5(string_agg(text_content, chr(10) ORDER BY chunk_index)) AS text_md5 FROM replies GROUP BY source_file""",
)
def merge_chunk_text(spark, sf_dir):
    return merge.merge_chunk_text(replies(spark, sf_dir)).select(
        "source_file", F.lit(0).alias("part_index"), F.md5("content").alias("content_md5"), F.md5("full_text").alias("text_md5")
    )


@query(
    "chunk_texts",
    f"""WITH {REPLIES_SQL} SELECT source_file, chunk_index, md5(content) AS content_md5, md5(text_content) AS text_md5,
      CAST(coalesce(sum(length(content) + 2) OVER w, 0) AS BIGINT) AS content_at, CAST(coalesce(sum(length(text_content) + 1) OVER w, 0) AS BIGINT) AS text_at
    FROM replies WINDOW w AS (PARTITION BY source_file ORDER BY chunk_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def chunk_texts(spark, sf_dir):
    return merge.chunk_texts(replies(spark, sf_dir)).select(
        "source_file", "chunk_index", F.md5("content").alias("content_md5"), F.md5("text_content").alias("text_md5"), "content_at", "text_at")


@query(
    "chunk_values",
    f"""WITH {KNOWLEDGE_SQL}, items AS (
      SELECT source_file, 'key_concepts' AS list, chunk_index, unnest(key_concepts) AS value, unnest(range(len(key_concepts))) AS pos FROM knowledge WHERE total_chunks > 1
      UNION ALL SELECT source_file, 'materials', chunk_index, unnest(materials), unnest(range(len(materials))) FROM knowledge WHERE total_chunks > 1
      UNION ALL SELECT source_file, 'methods', chunk_index, unnest(methods), unnest(range(len(methods))) FROM knowledge WHERE total_chunks > 1)
    SELECT source_file, list, value, min(chunk_index * 4294967296 + pos) AS position FROM items GROUP BY ALL""",
)
def chunk_values(spark, sf_dir):
    return merge.chunk_values(knowledge(spark, sf_dir))


@query(
    "chunk_items",
    f"""WITH {KNOWLEDGE_SQL} SELECT source_file, CAST(chunk_index AS BIGINT) * 4294967296 AS position, 'Q' || chunk_index AS question, md5(line) AS answer_md5
    FROM knowledge WHERE total_chunks > 1""",
)
def chunk_items(spark, sf_dir):
    return merge.chunk_items(knowledge(spark, sf_dir), "qa_pairs").select(
        "source_file", "position", "value.question", F.md5("value.answer").alias("answer_md5"))


def _first_seen(name: str) -> str:
    return f"""{name}_items AS (
  SELECT source_file, v, min(chunk_index * 100000 + pos) AS place FROM (
    SELECT source_file, chunk_index, unnest({name}) AS v, unnest(range(len({name}))) AS pos FROM knowledge) GROUP BY source_file, v
), {name}_merged AS (SELECT source_file, string_agg(v, ',' ORDER BY place) AS {name} FROM {name}_items GROUP BY source_file)"""


@query(
    "merge_chunk_knowledge",
    f"""WITH {KNOWLEDGE_SQL}, {_first_seen('key_concepts')}, {_first_seen('materials')}, {_first_seen('methods')},
    base AS (SELECT source_file, max(total_chunks) AS n, string_agg('Q' || chunk_index, ',' ORDER BY chunk_index) AS questions,
             md5(string_agg(line, '|' ORDER BY chunk_index)) AS findings_md5 FROM knowledge GROUP BY source_file),
    singles AS (SELECT source_file, array_to_string(key_concepts, ',') AS kc, array_to_string(materials, ',') AS ma, array_to_string(methods, ',') AS me
                FROM knowledge WHERE total_chunks = 1)
    SELECT base.source_file, questions, findings_md5, coalesce(CASE WHEN n > 1 THEN key_concepts ELSE kc END, '') AS key_concepts,
      coalesce(CASE WHEN n > 1 THEN materials ELSE ma END, '') AS materials, coalesce(CASE WHEN n > 1 THEN methods ELSE me END, '') AS methods
    FROM base LEFT JOIN singles USING (source_file) LEFT JOIN key_concepts_merged USING (source_file)
    LEFT JOIN materials_merged USING (source_file) LEFT JOIN methods_merged USING (source_file)""",
)
def merge_chunk_knowledge(spark, sf_dir):
    merged = merge.merge_chunk_knowledge(knowledge(spark, sf_dir))
    return merged.select(
        "source_file",
        F.array_join("qa_pairs.question", ",").alias("questions"),
        F.md5(F.array_join("main_findings", "|")).alias("findings_md5"),
        F.array_join("key_concepts", ",").alias("key_concepts"),
        F.array_join("technical_details.materials", ",").alias("materials"),
        F.array_join("technical_details.methods", ",").alias("methods"),
    )


def percent_sql(part: str, whole: str) -> str:
    return f"printf('%.1f%%', coalesce(round_even({part} * 100.0::DOUBLE / {whole}, 1), 0))"


@query(
    "qa_stats",
    f"""WITH {QA_SQL}, s AS (SELECT count(*) AS total_qa_pairs, count(*) FILTER (WHERE question_type = 'factual') AS factual_count,
      count(*) FILTER (WHERE question_type = 'comparison') AS comparison_count, count(*) FILTER (WHERE question_type = 'reasoning') AS reasoning_count,
      count(*) FILTER (WHERE question_type = 'open_ended') AS open_ended_count, avg(length(question)) AS q, avg(length(answer)) AS a FROM qa)
    SELECT total_qa_pairs, factual_count, comparison_count, reasoning_count, open_ended_count, round(q, 6) AS average_question_length, round(a, 6) AS average_answer_length,
      {percent_sql('factual_count', 'total_qa_pairs')} AS factual_percent, {percent_sql('comparison_count', 'total_qa_pairs')} AS comparison_percent,
      {percent_sql('reasoning_count', 'total_qa_pairs')} AS reasoning_percent, {percent_sql('open_ended_count', 'total_qa_pairs')} AS open_ended_percent FROM s""",
)
def qa_stats(spark, sf_dir):
    rounded = {f"average_{p}_length": F.round(f"average_{p}_length", 6) for p in ("question", "answer")}
    return stats.qa_stats(qa(spark, sf_dir)).withColumns(rounded)


@query("source_counts", f"WITH {QA_SQL} SELECT source_file, count(*) AS qa_pairs FROM qa GROUP BY source_file")
def source_counts(spark, sf_dir):
    return stats.source_counts(qa(spark, sf_dir))


@query(
    "type_distribution",
    f"WITH {QA_SQL} SELECT coalesce(question_type, 'unknown') AS question_type, count(*) AS qa_pairs FROM qa GROUP BY 1",
)
def type_distribution(spark, sf_dir):
    return stats.type_distribution(qa(spark, sf_dir))


LABELLED_SQL = f"{QA_SQL}, labelled AS (SELECT *, CASE WHEN (conv_id + turn) % 4 = 3 THEN 0 WHEN (conv_id + turn) % 9 = 8 THEN 2 ELSE 1 END AS quality_label FROM qa)"


def label_pairs(pairs):
    n = F.col("conv_id") + F.col("turn")
    return pairs.withColumn("quality_label", F.when(n % 4 == 3, 0).when(n % 9 == 8, 2).otherwise(1))


def labelled(spark, sf_dir):
    return label_pairs(qa(spark, sf_dir))


@query(
    "quality_report",
    f"""WITH {LABELLED_SQL}, t AS (SELECT coalesce(question_type, 'unknown') AS k, count(*) AS n FROM labelled GROUP BY 1),
    r AS (SELECT count(*) AS total_qa_pairs, count(*) FILTER (WHERE quality_label = 1) AS passed_qa_pairs, avg(length(question)) AS q, avg(length(answer)) AS a FROM labelled)
    SELECT total_qa_pairs, passed_qa_pairs, round(passed_qa_pairs / total_qa_pairs, 6) AS pass_rate, 0.7::DOUBLE AS quality_threshold, passed_qa_pairs / total_qa_pairs >= 0.7 AS meets_threshold,
      round(q, 6) AS avg_question_length, round(a, 6) AS avg_answer_length, (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM t) AS types FROM r""",
)
def quality_report(spark, sf_dir):
    report = stats.quality_report(labelled(spark, sf_dir))
    entries = F.array_sort(F.map_entries("question_types_distribution"))
    shown = F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    rounded = {c: F.round(c, 6) for c in ("pass_rate", "avg_question_length", "avg_answer_length")}
    return report.withColumns(rounded).withColumn("types", shown).drop("question_types_distribution")


@query(
    "file_stats",
    f"""WITH {LINES_SQL} SELECT count(DISTINCT doc_id) AS total_files, count(*) AS total_results, round(count(*) / count(DISTINCT doc_id), 6) AS average_results_per_file FROM lines""",
)
def file_stats(spark, sf_dir):
    return stats.file_stats(lines(spark, sf_dir), "doc_id").withColumn(
        "average_results_per_file", F.round("average_results_per_file", 6)
    )


META = {"system_name": "qa-data", "version": "1.0", "domain": "general", "generation_time": "20240101_000000"}


@query(
    "final_dataset",
    f"""WITH {LABELLED_SQL} SELECT qa_id, question, quality_label, 'qa-data' AS system_name, '1.0' AS version, 'general' AS domain, '20240101_000000' AS generation_time FROM labelled""",
)
def final_dataset(spark, sf_dir):
    return stats.final_dataset(labelled(spark, sf_dir).select("qa_id", "question", "quality_label"), META)


@query(
    "final_summary",
    f"""WITH {LABELLED_SQL} SELECT 'qa-data' AS system_name, '1.0' AS version, 'general' AS domain, '20240101_000000' AS generation_time, count(*) AS total_qa_pairs,
    0.7::DOUBLE AS quality_threshold, round(avg((quality_label = 1)::INT), 6) AS quality_pass_rate FROM labelled""",
)
def final_summary(spark, sf_dir):
    return stats.final_summary(labelled(spark, sf_dir), META).withColumn("quality_pass_rate", F.round("quality_pass_rate", 6))


@query(
    "stage_report",
    f"""WITH {LABELLED_SQL} SELECT 0 AS stage_order, 'documents' AS stage, (SELECT count(*) FROM documents) AS rows_out, 0 AS errors, true AS success
    UNION ALL SELECT 1, 'qa', (SELECT count(*) FROM qa), 0, true
    UNION ALL SELECT 2, 'checked', (SELECT count(*) FROM labelled), (SELECT count(*) FROM labelled WHERE quality_label = 0), false""",
)
def stage_report(spark, sf_dir):
    checked = labelled(spark, sf_dir).withColumn("error", F.when(F.col("quality_label") == 0, "rejected"))
    return stats.stage_report({"documents": documents(spark, sf_dir), "qa": qa(spark, sf_dir), "checked": checked})


@query(
    "observed_stage_report",
    f"""WITH {LABELLED_SQL} SELECT 0 AS stage_order, 'qa' AS stage, (SELECT count(*) FROM qa) AS rows_out, 0 AS errors, true AS success
    UNION ALL SELECT 1, 'checked', (SELECT count(*) FROM labelled), (SELECT count(*) FROM labelled WHERE quality_label = 0),
      (SELECT count(*) FROM labelled WHERE quality_label = 0) = 0
    UNION ALL SELECT 2, 'kept', (SELECT count(*) FROM labelled WHERE quality_label <> 0), 0, true""",
)
def observed_stage_report(spark, sf_dir):
    """The flow runs once, to its output; every stage's rows and errors are counted as they pass."""
    pairs, qa_seen = stats.observe_stage(qa(spark, sf_dir), "qa")
    checked = label_pairs(pairs).withColumn("error", F.when(F.col("quality_label") == 0, "rejected"))
    checked, checked_seen = stats.observe_stage(checked, "checked")
    kept, kept_seen = stats.observe_stage(checked.filter("quality_label <> 0").drop("error"), "kept")
    materialize(kept, "kept")
    return stats.observed_report(spark, {"qa": qa_seen, "checked": checked_seen, "kept": kept_seen})


TARGETS = {"factual": 60, "comparison": 40, "summary": 10, "reasoning": 30}


@query(
    "generation_report",
    f"""WITH {QA_SQL}, a AS (SELECT coalesce(question_type, 'unknown') AS question_type, count(*) AS n, min((conv_id + turn) % 10) AS lo, avg((conv_id + turn) % 10) AS av, max((conv_id + turn) % 10) AS hi FROM qa GROUP BY 1),
    t(question_type, target) AS (VALUES ('factual', 60), ('comparison', 40), ('summary', 10), ('reasoning', 30)),
    j AS (SELECT coalesce(a.question_type, t.question_type) AS question_type, coalesce(target, 0) AS target, coalesce(n, 0) AS actual, lo, av, hi FROM a FULL JOIN t ON a.question_type = t.question_type)
    SELECT question_type, target, actual, {percent_sql('actual', '(sum(actual) OVER ())')} AS share,
      CASE WHEN target > 0 THEN {percent_sql('actual', 'target')} END AS achievement, lo::DOUBLE AS min_quality, round(av, 6) AS avg_quality, hi::DOUBLE AS max_quality FROM j""",
)
def generation_report(spark, sf_dir):
    scored = qa(spark, sf_dir).withColumn("quality_score", ((F.col("conv_id") + F.col("turn")) % 10).cast("double"))
    targets = spark.createDataFrame(list(TARGETS.items()), "question_type string, target int")
    return stats.generation_report(scored, targets).withColumn("avg_quality", F.round("avg_quality", 6))


@query(
    "method_report",
    f"""WITH {QA_SQL}, m AS (SELECT CASE WHEN turn = 0 THEN 'template' ELSE 'model' END AS generation_method, count(*) AS qa_pairs FROM qa GROUP BY 1)
    SELECT generation_method, qa_pairs, {percent_sql('qa_pairs', '(sum(qa_pairs) OVER ())')} AS share FROM m""",
)
def method_report(spark, sf_dir):
    named = qa(spark, sf_dir).withColumn("generation_method", F.when(F.col("turn") == 0, "template").otherwise("model"))
    return stats.method_report(named)


@query(
    "dedup_records",
    r"""SELECT min(doc_id) AS doc_id, lang FROM documents GROUP BY lang, regexp_replace(lower(text), '[^\p{L}\p{N}]+', '', 'g')""",
)
def dedup_records(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    return merge.dedup_records(docs, ["lang", "text"], "doc_id", fold=True).select("doc_id", "lang")


# Sets of five-word runs, all pairs that share one, and the smallest id within reach: near duplicates by hand.
_NEAR_SQL = r"""d AS (
  SELECT id, list_filter(regexp_split_to_array(lower(coalesce(t, '')), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM records
), s AS (
  SELECT DISTINCT id, array_to_string(w[i + 1 : i + 5], ' ') AS g FROM (SELECT *, unnest(range(greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)
), c AS (SELECT id, count(*) AS n FROM s GROUP BY id),
o AS (SELECT x.id AS a, y.id AS b, count(*) AS o FROM s x JOIN s y USING (g) WHERE x.id < y.id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN c x ON x.id = a JOIN c y ON y.id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (
  SELECT id AS node, id AS least FROM d
  UNION
  SELECT e.b, reach.least FROM reach JOIN e ON e.a = reach.node WHERE reach.least < e.b
), classes AS (SELECT node AS id, min(least) AS class_id FROM reach GROUP BY node)"""


@query(
    "near_duplicate_records",
    f"WITH RECURSIVE records AS (SELECT doc_id AS id, text AS t FROM documents), {_NEAR_SQL} SELECT id AS doc_id, class_id FROM classes",
)
def near_duplicate_records(spark, sf_dir):
    return neardup.near_duplicate_classes(documents(spark, sf_dir), "text", "doc_id")


@query(
    "near_duplicate_questions",
    rf"""WITH RECURSIVE asked AS (SELECT (conv_id * 1000 + turn) * 3 AS id, text AS t FROM conversations WHERE role = 'user'),
    records AS (SELECT id, t FROM asked UNION ALL SELECT id + 1, regexp_replace(t, '\S+\s*$', 'indeed') FROM asked
                UNION ALL SELECT id + 2, 'Please tell: ' || t || ' Thanks' FROM asked), {_NEAR_SQL} SELECT id AS question_id, class_id FROM classes""",
)
def near_duplicate_questions(spark, sf_dir):
    """Every question beside two rewordings of it: another last word, and words before and after."""
    turns = table(spark, sf_dir, "conversations").filter("role = 'user'")
    asked = turns.select(((F.col("conv_id") * 1000 + F.col("turn")) * 3).alias("id"), F.col("text").alias("question"))
    last = asked.select(F.col("id") + 1, F.regexp_replace("question", r"\S+\s*$", "indeed"))
    around = asked.select(F.col("id") + 2, F.concat(F.lit("Please tell: "), F.col("question"), F.lit(" Thanks")))
    return neardup.near_duplicate_classes(asked.union(last).union(around), "question", "id").withColumnRenamed("id", "question_id")


@query(
    "type_share",
    f"""WITH {QA_SQL}, c AS (SELECT split_part(coalesce(question_type, 'unknown'), '_', 1) AS type_prefix, count(*) AS qa_pairs FROM qa GROUP BY 1)
    SELECT type_prefix, qa_pairs, {percent_sql('qa_pairs', '(sum(qa_pairs) OVER ())')} AS share FROM c""",
)
def type_share(spark, sf_dir):
    return stats.type_share(qa(spark, sf_dir), "question_type")


# --- planning -------------------------------------------------------------------------------------

PLAN_SQL = f"""{QA_SQL},
numbered AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_index, count(*) OVER () AS n,
  {bucket_sql("''", "conv_id", "turn")} / 4294967296.0::DOUBLE AS x FROM qa),
ratios(question_type, modulus) AS (VALUES ('factual', 6), ('comparison', 6), ('reasoning', 2), ('open_ended', 5)),
due AS (SELECT conv_id, turn, row_index, r.question_type, question, answer, source_file FROM numbered, ratios r WHERE row_index % modulus = 0 OR row_index + 1 = n),
plan AS (
  SELECT * FROM due UNION ALL
  SELECT conv_id, turn, row_index, CASE WHEN x < 0.15 THEN 'factual' WHEN x < 0.3 THEN 'comparison' WHEN x < 0.8 THEN 'reasoning' ELSE 'open_ended' END, question, answer, source_file
  FROM numbered WHERE row_index NOT IN (SELECT row_index FROM due)
)"""


@query("plan_question_types", f"WITH {PLAN_SQL} SELECT conv_id, turn, row_index, question_type FROM plan")
def plan_question_types(spark, sf_dir):
    return planning.plan_question_types(qa(spark, sf_dir).select("conv_id", "turn"), "conv_id", "turn")


@query(
    "explode_tasks",
    f"""WITH {PLAN_SQL} SELECT conv_id, turn, question_type, CASE question_type WHEN 'factual' THEN '43' WHEN 'comparison' THEN '44' WHEN 'reasoning' THEN '45' ELSE '46' END AS prompt_id,
    CASE question_type WHEN 'factual' THEN 'Facts of ' || source_file || ': ' || question WHEN 'comparison' THEN 'Compare: ' || question || ' / ' || answer
      WHEN 'reasoning' THEN 'Why? ' || answer ELSE 'Discuss ' || question END AS prompt FROM plan""",
)
def explode_tasks(spark, sf_dir):
    registry = PromptRegistry(
        {43: "Facts of {source_file}: {question}", 44: "Compare: {question} / {answer}", 45: "Why? {answer}", 46: "Discuss {question}"}
    )
    # Only keys are numbered and written; the texts join the plan afterwards.
    rows = qa(spark, sf_dir).select("conv_id", "turn", "source_file", "question", "answer")
    planned = planning.plan_question_types(rows.select("conv_id", "turn"), "conv_id", "turn")
    return planning.explode_tasks(rows.join(planned, ["conv_id", "turn"]), registry).select("conv_id", "turn", "question_type", "prompt_id", "prompt")


@query(
    "type_quota",
    """WITH totals AS (SELECT source, lang, count(*) AS total FROM documents GROUP BY source, lang),
    ratios(rank, question_type, r) AS (VALUES (0, 'factual', 0.15::DECIMAL(10,4)), (1, 'comparison', 0.15::DECIMAL(10,4)), (2, 'reasoning', 0.5::DECIMAL(10,4)), (3, 'open_ended', 0.2::DECIMAL(10,4))),
    shares AS (SELECT *, r * total::DECIMAL(18,0) AS exact, floor(r * total::DECIMAL(18,0)) AS whole FROM totals, ratios),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY exact - whole DESC, rank) AS pos, sum(whole) OVER (PARTITION BY source, lang) AS given FROM shares)
    SELECT source, lang, total, question_type, (whole + CASE WHEN pos <= total - given THEN 1 ELSE 0 END)::BIGINT AS target FROM ranked""",
)
def type_quota(spark, sf_dir):
    totals = documents(spark, sf_dir).groupBy("source", "lang").agg(F.count("*").alias("total"))
    return planning.type_quota(totals, planning.TYPE_RATIOS)


TYPES_SQL = f"""{QA_SQL},
goals(question_type, ratio, priority) AS (VALUES ('factual', 0.25::DOUBLE, 3), ('comparison', 0.18::DOUBLE, 4), ('reasoning', 0.25::DOUBLE, 2), ('multi_hop', 0.15::DOUBLE, 5), ('open_ended', 0.17::DOUBLE, 1)),
now AS (SELECT g.*, count(q.question_type) AS n FROM goals g LEFT JOIN qa q ON q.question_type = g.question_type GROUP BY ALL),
shares AS (SELECT *, n / sum(n) OVER () AS share, sum(n) OVER () AS total FROM now)"""


@query(
    "type_priority_score",
    f"""WITH {TYPES_SQL}, scored AS (SELECT question_type, n, round(0.5 * greatest(ratio * 300 - n, 0) / (ratio * 300) + 0.3 * (6 - priority) / 5.0 + 0.2 * greatest(ratio - share, 0), 6) AS score FROM shares)
    SELECT *, row_number() OVER (ORDER BY score DESC, question_type) AS rank FROM scored""",
)
def type_priority_score(spark, sf_dir):
    return planning.type_priority_score(qa(spark, sf_dir), target_total=300)


@query(
    "clamp_ratio",
    f"""WITH {TYPES_SQL}, c AS (SELECT question_type, ratio, least(greatest(ratio + CASE WHEN share < ratio THEN 0.1 WHEN share > ratio THEN -0.1 ELSE 0 END, 0.05), 0.4)::DOUBLE AS clamped FROM shares)
    SELECT question_type, ratio, round(clamped, 6) AS clamped, round(clamped / sum(clamped) OVER (), 6) AS adjusted FROM c""",
)
def clamp_ratio(spark, sf_dir):
    rounded = {c: F.round(c, 6) for c in ("clamped", "adjusted")}
    return planning.clamp_ratio(qa(spark, sf_dir)).withColumns(rounded)


@query("subgraph_profile", f"WITH {SUBGRAPHS_SQL} SELECT graph_id, num_nodes, num_edges FROM subgraphs")
def subgraph_profile(spark, sf_dir):
    return planning.graph_profile(*graph_tables(spark, sf_dir))


@query(
    "subgraph_max_types",
    f"""WITH {SUBGRAPHS_SQL} SELECT graph_id, CASE WHEN num_nodes <= 2 OR num_edges <= 1 THEN 1 WHEN num_nodes <= 4 OR num_edges <= 3 THEN 2
    WHEN num_nodes <= 8 OR num_edges <= 6 THEN 3 ELSE 4 END AS max_types FROM subgraphs""",
)
def subgraph_max_types(spark, sf_dir):
    sized = planning.graph_profile(*graph_tables(spark, sf_dir))
    return sized.select("graph_id", planning.subgraph_max_types().alias("max_types"))


TOPIC_WORDS = {"noun": ["tion", "keit"], "verb": ["ing", "eau"], "article": ["the", "der"]}


@query(
    "question_category",
    f"""WITH {QA_SQL}, c AS (SELECT CASE WHEN contains(lower(question), 'tion') OR contains(lower(question), 'keit') THEN 'noun'
      WHEN contains(lower(question), 'ing') OR contains(lower(question), 'eau') THEN 'verb' WHEN contains(lower(question), 'the') OR contains(lower(question), 'der') THEN 'article' ELSE '通用技术问题' END AS category FROM qa)
    SELECT category, count(*) AS questions FROM c GROUP BY category""",
)
def question_category(spark, sf_dir):
    named = qa(spark, sf_dir).select(planning.question_category("question", TOPIC_WORDS).alias("category"))
    return named.groupBy("category").agg(F.count("*").alias("questions"))


FIXED = [(1, "Why does a hot bolt fail?"), (2, "How do ring and bolt differ?"), (3, "What is a large ring for?"), (4, "Name a colour.")]
FEATURES = {"fastener": ["bolt", "nut"], "ring": ["ring"], "heat": ["hot"], "size": ["large", "small"]}


@query(
    "fixed_question_match",
    f"""WITH {SUBGRAPHS_SQL}, f AS (SELECT graph_id, (names LIKE '%bolt%' OR names LIKE '%nut%')::INT AS fastener, (names LIKE '%ring%')::INT AS ring, (names LIKE '%hot%')::INT AS heat, (names LIKE '%large%' OR names LIKE '%small%')::INT AS size FROM subgraphs),
    s AS (SELECT graph_id, 1 AS question_id, fastener + heat AS score FROM f UNION ALL SELECT graph_id, 2, fastener + ring FROM f UNION ALL SELECT graph_id, 3, ring + size FROM f),
    r AS (SELECT *, row_number() OVER (PARTITION BY graph_id ORDER BY score DESC, question_id) AS rank FROM s WHERE score > 0)
    SELECT graph_id, question_id, score, rank FROM r WHERE rank <= 2""",
)
def fixed_question_match(spark, sf_dir):
    nodes, _ = graph_tables(spark, sf_dir)
    matched = planning.fixed_question_match(planning.graph_features(nodes, FEATURES), FIXED, 2, FEATURES)
    return matched.select("graph_id", "question_id", "score", "rank")


@query(
    "type_length_filter",
    f"""WITH {QA_SQL} SELECT qa_id, question_type FROM qa WHERE CASE coalesce(question_type, '')
      WHEN 'factual' THEN length(question) BETWEEN 30 AND 200 AND length(answer) >= 20 WHEN 'comparison' THEN length(question) BETWEEN 50 AND 300 AND length(answer) >= 50
      WHEN 'reasoning' THEN length(question) BETWEEN 60 AND 400 AND length(answer) >= 80 WHEN 'multi_hop' THEN length(question) BETWEEN 70 AND 350 AND length(answer) >= 60
      WHEN 'open_ended' THEN length(question) BETWEEN 80 AND 500 AND length(answer) >= 100 ELSE length(question) >= 20 AND length(answer) >= 10 END""",
)
def type_length_filter(spark, sf_dir):
    return planning.type_length_filter(qa(spark, sf_dir)).select("qa_id", "question_type")
