"""Sources, sinks and resume."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaloom.functions.text import decode_text
from qaloom.operators.stats import batch_report as report_batches
from qaloom.operators.stats import quality_report
from qaloom.plans.fixtures import (
    BLOCKS_SQL, QA_SQL, blocks, document_files, documents, qa, table,
)
from qaloom.plans.registry import query
from qaloom.session import new_scratch_path
from qaloom.sources import files, json_array, records, resume
from qaloom.streaming.ingest import incremental_ingest as ingest
from qaloom.streaming.ingest import keyed_ingest as ingest_by_key
from qaloom.streaming.ingest import read_keyed


@query(
    "text_source",
    r"SELECT length(text) + 1 AS n_chars, md5(text || chr(10)) AS content_md5 FROM documents WHERE regexp_matches(text, '\S')",
)
def text_source(spark, sf_dir):
    found = files.text_source(spark, document_files(spark, sf_dir))
    return found.select(F.char_length("content").alias("n_chars"), F.md5("content").alias("content_md5"))


CATALOG_SQL = r"""
named AS (
  SELECT doc_id, '/corpus/' || source || '/doc' || doc_id || (['.txt', '.PDF', '.md', '.docx', ''])[CAST(doc_id % 5 AS INT) + 1] AS file_path,
         CASE WHEN doc_id % 11 = 0 THEN ' ' || chr(10) ELSE text END AS content
  FROM documents
),
typed AS (
  SELECT *, string_split(file_path, '/')[-1] AS file_name,
         CASE WHEN doc_id % 5 = 1 THEN 'pdf' WHEN doc_id % 5 IN (0, 2) THEN 'text' ELSE 'unknown' END AS file_type
  FROM named
),
catalog AS (
  SELECT file_path, file_name, file_type, CASE WHEN file_type = 'unknown' THEN '' ELSE content END AS content,
         file_type <> 'unknown' AND regexp_matches(content, '\S') AS success,
         CASE WHEN file_type = 'unknown' THEN 'unsupported file type: unknown'
              WHEN NOT regexp_matches(content, '\S') THEN 'empty content' END AS error
  FROM typed
)"""


def catalog(spark, sf_dir):
    suffixes = F.array(*[F.lit(s) for s in (".txt", ".PDF", ".md", ".docx", "")])
    raw = documents(spark, sf_dir).select(
        F.concat(
            F.lit("/corpus/"), "source", F.lit("/doc"), F.col("doc_id").cast("string"),
            F.element_at(suffixes, (F.col("doc_id") % 5 + 1).cast("int")),
        ).alias("file_path"),
        F.when(F.col("doc_id") % 11 == 0, " \n").otherwise(F.col("text")).alias("content"),
    )
    return files.file_catalog(raw)


@query(
    "file_catalog",
    f"WITH {CATALOG_SQL} SELECT file_path, file_name, file_type, md5(content) AS content_md5, success, error FROM catalog",
)
def file_catalog(spark, sf_dir):
    return catalog(spark, sf_dir).select(
        "file_path", "file_name", "file_type", F.md5("content").alias("content_md5"), "success", "error"
    )


@query(
    "decode_text",
    r"""SELECT doc_id, md5(CASE doc_id % 3 WHEN 0 THEN text
        WHEN 1 THEN '文档' || doc_id || '：半导体 ' || regexp_replace(text, '[^ -~\n]', '字', 'g') ELSE '' END) AS text_md5 FROM documents""",
)
def decode(spark, sf_dir):
    with files.java_charsets(spark):
        plain = F.regexp_replace("text", r"[^ -~\n]", "字")
        mixed = F.concat(F.lit("文档"), F.col("doc_id").cast("string"), F.lit("：半导体 "), plain)
        kind = F.col("doc_id") % 3
        raw = (
            F.when(kind == 0, F.encode("text", "UTF-8"))
            .when(kind == 1, F.encode(mixed, "GBK"))
            .otherwise(F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FFFE80"))))
        )
        staged = documents(spark, sf_dir).select("doc_id", raw.alias("raw"))
        return staged.select("doc_id", F.md5(decode_text("raw")).alias("text_md5"))


@query(
    "retrieval_input",
    f"""WITH {CATALOG_SQL} SELECT file_name AS source_file, file_type, md5(content) AS content_md5, file_path,
        CASE file_type WHEN 'pdf' THEN 'pdf_extraction' ELSE 'direct_read' END AS extraction_method FROM catalog WHERE success""",
)
def retrieval_input(spark, sf_dir):
    return files.retrieval_input(catalog(spark, sf_dir)).select(
        "source_file", "file_type", F.md5("content").alias("content_md5"), "metadata.file_path", "metadata.extraction_method"
    )


QA_ROWS_SQL = f"WITH {QA_SQL} SELECT qa_id, source_file, question, answer, question_type FROM qa"
QA_COLUMNS = ["qa_id", "source_file", "question", "answer", "question_type"]
QA_SCHEMA = ", ".join(f"{c} string" for c in QA_COLUMNS)


@query("json_array_source", QA_ROWS_SQL)
def json_array_source(spark, sf_dir):
    """Pairs written as files that are one JSON array each, read back by ranges."""
    path = new_scratch_path(spark, "arrays")
    rows = qa(spark, sf_dir).select(F.pmod(F.xxhash64("qa_id"), F.lit(4)).alias("part"), F.to_json(F.struct(*QA_COLUMNS)).alias("json"))
    arrays = rows.groupBy("part").agg(F.concat(F.lit("[\n"), F.expr("listagg(json, ',\n')"), F.lit("\n]")).alias("value"))
    arrays.write.partitionBy("part").text(path)
    return json_array.json_array_source(spark, path, QA_SCHEMA, "*.txt")


@query("records_source", QA_ROWS_SQL)
def records_source(spark, sf_dir):
    path = new_scratch_path(spark, "records") + ".csv"
    records.csv_sink(qa(spark, sf_dir).select(QA_COLUMNS), path)
    return records.records_source(spark, path, QA_SCHEMA)


@query("json_sink", QA_ROWS_SQL)
def json_sink(spark, sf_dir):
    path = new_scratch_path(spark, "records") + ".json"
    records.json_sink(qa(spark, sf_dir).select(QA_COLUMNS), path)
    return records.records_source(spark, path, QA_SCHEMA, multi_line=False)


@query(
    "csv_sink",
    f"""WITH {QA_SQL} SELECT qa_id, question, '{{"question_length":' || length(question) || ',"answer_length":' || length(answer) || '}}' AS details FROM qa""",
)
def csv_sink(spark, sf_dir):
    path = new_scratch_path(spark, "records") + ".csv"
    details = F.struct(
        F.char_length("question").alias("question_length"), F.char_length("answer").alias("answer_length")
    )
    records.csv_sink(qa(spark, sf_dir).select("qa_id", "question", details.alias("details")), path)
    return records.records_source(spark, path, "qa_id string, question string, details string")


@query(
    "qa_flatten",
    f"""WITH {QA_SQL}, nested AS (SELECT *, turn % 4 < 2 AS is_nested FROM qa)
    SELECT question, answer, question_type, coalesce(CASE WHEN conv_id % 3 > 0 THEN source_file END, 'unknown') AS source_file FROM nested WHERE is_nested
    UNION ALL
    SELECT question || ' Why?', answer, NULL, coalesce(CASE WHEN conv_id % 3 > 0 THEN source_file END, 'unknown') FROM nested WHERE is_nested
    UNION ALL
    SELECT question, answer, question_type, CASE WHEN conv_id % 3 > 0 THEN source_file END FROM nested WHERE NOT is_nested""",
)
def qa_flatten(spark, sf_dir):
    pairs = qa(spark, sf_dir)
    nested = F.col("turn") % 4 < 2
    first = F.struct("question", "answer", "question_type")
    second = F.struct(
        F.concat("question", F.lit(" Why?")).alias("question"), "answer", F.lit(None).cast("string").alias("question_type")
    )
    items = pairs.select(
        F.when(F.col("conv_id") % 3 > 0, F.col("source_file")).alias("source_file"),
        F.when(nested, F.array(first, second)).alias("qa_pairs"),
        *[F.when(~nested, F.col(c)).alias(c) for c in ("question", "answer", "question_type")],
    )
    return records.qa_flatten(items)


@query(
    "quality_fanout",
    f"""WITH {QA_SQL} SELECT 'detailed' AS output, count(*) AS n FROM qa UNION ALL
    SELECT 'high_quality', count(*) FROM qa WHERE (conv_id + turn) % 3 = 1 UNION ALL
    SELECT 'results', count(*) FROM qa UNION ALL SELECT 'report', 1""",
)
def quality_fanout(spark, sf_dir):
    checked = qa(spark, sf_dir).withColumn("quality_label", ((F.col("conv_id") + F.col("turn")) % 3).cast("int"))
    out = records.quality_fanout(checked, quality_report, new_scratch_path(spark, "fanout"))

    def count(name, df):
        return df.agg(F.count("*").alias("n")).select(F.lit(name).alias("output"), "n")

    frames = [count(n, spark.read.schema(checked.schema).json(out[n])) for n in ("detailed", "high_quality")]
    frames.append(count("results", records.records_source(spark, out["results"] + "/*.csv", "qa_id string")))
    frames.append(count("report", spark.read.json(out["report"])))
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


@query(
    "resume_text",
    "SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def resume_text(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "n_chars")
    return resume.resume(docs, table(spark, sf_dir, "labels"), "doc_id")


@query(
    "resume_bloom",
    "SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def resume_bloom(spark, sf_dir):
    """As for a history too large to broadcast."""
    docs = documents(spark, sf_dir).select("doc_id", "n_chars")
    return resume.resume(docs, table(spark, sf_dir, "labels"), "doc_id", bloom=True)


@query(
    "resume_image",
    f"""WITH {BLOCKS_SQL} SELECT '/data/' || source || '/' || img_path AS image_path FROM blocks
    WHERE type = 'image' AND doc NOT IN (SELECT doc_id FROM labels)""",
)
def resume_image(spark, sf_dir):
    images = blocks(spark, sf_dir).filter("type = 'image'")
    new = images.select(F.concat(F.lit("/data/"), "source", F.lit("/"), "img_path").alias("image_path"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("doc"))
    done = images.join(labels, "doc", "left_semi").select(F.concat(F.lit("old/"), "img_path").alias("image_path"))
    return resume.resume_images(new, done)


@query(
    "merge_history",
    """SELECT d.doc_id, d.lang, l.quality, l.doc_id IS NOT NULL AS is_history FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def merge_history(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = documents(spark, sf_dir).select("doc_id", "lang")
    return resume.merge_history(resume.resume(docs, labels, "doc_id"), docs.join(labels, "doc_id"))


@query("task_limit", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100")
def task_limit(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "n_chars")
    return resume.task_limit(docs, 100, F.desc("n_chars"), "doc_id")


@query(
    "batch_assign",
    "SELECT doc_id, lang, (row_number() OVER (ORDER BY lang, doc_id) - 1) // 64 AS batch_id FROM documents",
)
def batch_assign(spark, sf_dir):
    return resume.batch_assign(documents(spark, sf_dir).select("doc_id", "lang"), 64, "lang", "doc_id")


@query(
    "multi_input",
    r"SELECT lang AS input_dir, count(*) AS files, sum(length(text) + 1)::BIGINT AS n_chars FROM documents WHERE regexp_matches(text, '\S') GROUP BY lang",
)
def multi_input(spark, sf_dir):
    found = files.multi_input(spark, document_files(spark, sf_dir))
    return found.groupBy("input_dir").agg(
        F.count("*").alias("files"), F.sum(F.char_length("content")).alias("n_chars")
    )


@query(
    "batch_report",
    """WITH per_dir AS (SELECT source, count(*) AS n FROM documents GROUP BY source)
    SELECT source AS input_dir, n AS qa_pairs, NULL::BIGINT AS average_per_dir FROM per_dir
    UNION ALL SELECT 'TOTAL', sum(n)::BIGINT, (sum(n) // count(*))::BIGINT FROM per_dir""",
)
def batch_report(spark, sf_dir):
    return report_batches(documents(spark, sf_dir).withColumnRenamed("source", "input_dir"))


@query(
    "incremental_ingest",
    "SELECT event_type, count(*) AS n, sum(user_id)::BIGINT AS users FROM events GROUP BY event_type",
)
def incremental_ingest(spark, sf_dir):
    root = new_scratch_path(spark, "ingest")
    schema = table(spark, sf_dir, "events").schema
    ingest(spark, sf_dir, f"{root}/sink", f"{root}/checkpoint", schema, pathGlobFilter="events.parquet")
    arrived = spark.read.schema(schema).parquet(f"{root}/sink")
    return arrived.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))


@query(
    "keyed_ingest",
    "SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids, sum(user_id)::BIGINT AS users FROM events GROUP BY event_type",
)
def keyed_ingest(spark, sf_dir):
    """The file is delivered, and then again to a stream whose checkpoint is lost: every event is stored once."""
    root = new_scratch_path(spark, "keyed")
    schema = table(spark, sf_dir, "events").schema
    for checkpoint in ("first", "second"):
        ingest_by_key(spark, sf_dir, f"{root}/sink", f"{root}/{checkpoint}", schema, "event_id", pathGlobFilter="events.parquet")
    arrived = read_keyed(spark, f"{root}/sink", schema)
    return arrived.groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.sum("user_id").alias("users"))


@query("domain_sink", "SELECT source AS domain, count(*) AS n, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY source")
def domain_sink(spark, sf_dir):
    path = new_scratch_path(spark, "domains")
    docs = documents(spark, sf_dir).select("doc_id", "n_chars", F.col("source").alias("domain"))
    records.domain_sink(docs, path, run="first")
    stored = spark.read.schema("doc_id bigint, n_chars bigint, domain string, run string").json(path)
    return stored.groupBy("domain").agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"))
