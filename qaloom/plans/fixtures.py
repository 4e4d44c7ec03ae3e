"""Record shapes derived from the shared tables, in Spark and as SQL common table expressions.

Each ``X_SQL`` constant names the same rows as the function ``x``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.functions.text import escape_json
from qaloom.session import new_scratch_path, spread
from qaloom.sources.files import text_sink


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


# --- question-answer pairs: a user turn and the assistant turn after it -----------------------

QA_SQL = """
qa AS (
  SELECT u.conv_id, u.turn, u.conv_id || '-' || u.turn AS qa_id, 'conv' || u.conv_id AS source_file,
         u.text AS question, a.text AS answer,
         CASE (u.conv_id + u.turn) % 6 WHEN 0 THEN 'factual' WHEN 1 THEN 'comparison'
              WHEN 2 THEN 'reasoning' WHEN 3 THEN 'open_ended' WHEN 4 THEN 'multi_hop' END AS question_type
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'
)"""


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined on (conversation, turn), so one endless conversation still spreads over tasks."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    replied = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    kind = (F.col("conv_id") + F.col("turn")) % 6
    names = ["factual", "comparison", "reasoning", "open_ended", "multi_hop"]
    question_type = F.lit(None).cast("string")
    for i, name in enumerate(names):
        question_type = F.when(kind == i, F.lit(name)).otherwise(question_type)
    return asked.join(replied, ["conv_id", "turn"]).select(
        "conv_id",
        "turn",
        F.concat_ws("-", "conv_id", "turn").alias("qa_id"),
        F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("source_file"),
        "question",
        "answer",
        question_type.alias("question_type"),
    )


# --- lines of documents, standing for chunks and layout blocks --------------------------------

LINES_SQL = """
lines AS (
  SELECT doc_id, source, lang, len(parts) AS n_lines, unnest(range(len(parts))) AS ord, unnest(parts) AS line
  FROM (SELECT doc_id, source, lang, string_split(text, chr(10)) AS parts FROM documents)
)"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.split("text", "\n")
    return documents(spark, sf_dir).select(
        "doc_id", "source", "lang", F.size(parts).alias("n_lines"), F.posexplode(parts).alias("ord", "line")
    )


BLOCKS_SQL = (
    LINES_SQL
    + """,
blocks AS (
  SELECT doc_id AS doc, ord, source, ord // 4 AS page_idx,
         CASE WHEN (doc_id + ord) % 5 = 3 THEN 'image' ELSE 'text' END AS type,
         CASE WHEN (doc_id + ord) % 5 <> 3 THEN line END AS text,
         CASE WHEN (doc_id + ord) % 5 = 3 THEN 'images/d' || doc_id || '_' || ord || '.png' END AS img_path,
         CASE WHEN (doc_id + ord) % 5 = 3 THEN CASE WHEN ord % 2 = 0 THEN [line] ELSE CAST([] AS VARCHAR[]) END END AS img_caption
  FROM lines
)"""
)


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    image = (F.col("doc_id") + F.col("ord")) % 5 == 3
    captions = F.when(F.col("ord") % 2 == 0, F.array("line")).otherwise(F.array().cast("array<string>"))
    return lines(spark, sf_dir).select(
        F.col("doc_id").alias("doc"),
        "ord",
        "source",
        F.expr("cast(ord div 4 as int)").alias("page_idx"),
        F.when(image, "image").otherwise("text").alias("type"),
        F.when(~image, F.col("line")).alias("text"),
        F.when(image, F.concat(F.lit("images/d"), F.col("doc_id").cast("string"), F.lit("_"), F.col("ord").cast("string"), F.lit(".png"))).alias("img_path"),
        F.when(image, captions).alias("img_caption"),
    )


MARKDOWN_SQL = """
markdown AS (
  SELECT doc, string_agg(CASE WHEN type = 'image' THEN '![](' || img_path || ')' || CASE WHEN len(img_caption) > 0 THEN chr(10) || img_caption[1] ELSE '' END
                              ELSE text END, chr(10) || chr(10) ORDER BY ord) AS markdown
  FROM blocks GROUP BY doc
)"""


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's markdown, built inside its own row."""
    parts = F.split("text", "\n")

    def part(line: Column, i: Column) -> Column:
        image = (F.col("doc_id") + i) % 5 == 3
        link = F.concat(F.lit("![](images/d"), F.col("doc_id").cast("string"), F.lit("_"), i.cast("string"), F.lit(".png)"))
        return F.when(
            image, F.concat(link, F.when(i % 2 == 0, F.concat(F.lit("\n"), line)).otherwise(F.lit("")))
        ).otherwise(line)

    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("doc"), F.array_join(F.transform(parts, part), "\n\n").alias("markdown")
    )


# --- page documents: four lines to a page ------------------------------------------------------

PAGEDOCS_SQL = (
    BLOCKS_SQL
    + """,
pagedocs AS (
  SELECT doc, page_idx + 1 AS page_num,
         string_agg(coalesce(text, img_caption[1], ''), chr(10) ORDER BY ord) AS text,
         coalesce(list(img_path ORDER BY ord) FILTER (WHERE type = 'image'), CAST([] AS VARCHAR[])) AS images
  FROM blocks GROUP BY doc, page_idx
)"""
)


def pagedocs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        blocks(spark, sf_dir)
        .groupBy("doc", F.col("page_idx").alias("_p"))
        .agg(
            F.expr("listagg(coalesce(text, get(img_caption, 0), ''), '\n') WITHIN GROUP (ORDER BY ord)").alias("text"),
            F.array_sort(
                F.expr("collect_list(struct(ord, img_path)) FILTER (WHERE type = 'image')")
            ).alias("_i"),
        )
        .select("doc", (F.col("_p") + 1).alias("page_num"), "text", F.col("_i.img_path").alias("images"))
    )


# --- raw model replies: one per line, in every shape a reply takes ------------------------------

def sql_escape(expr: str) -> str:
    return r"""replace(replace(replace(replace(EXPR, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(9), '\t')""".replace("EXPR", expr)


def sql_escape_single(expr: str) -> str:
    """Escaped for a text within single quotes."""
    return f"replace({sql_escape(expr)}, chr(39), '{SINGLE_QUOTE}')"


# Fixed value: how JSON writes a single quote that would end a single-quoted text.
SINGLE_QUOTE = r"\u0027"

REPLIES_SQL = (
    LINES_SQL
    + """,
bodies AS (
  SELECT *, '{"question": "What about line ' || ord || '?", "answer": "' || """
    + sql_escape("line")
    + """ || '", "question_type": ' || CASE WHEN ord % 3 = 0 THEN 'null' ELSE '"reasoning"' END || ', "rank": ' || ord || '}' AS body
  FROM lines
),
replies AS (
  SELECT 'doc' || doc_id AS source_file, ord AS chunk_index, n_lines AS total_chunks, line AS text_content, body,
         (doc_id + ord) % 8 AS shape,
         CASE (doc_id + ord) % 8
           WHEN 0 THEN 'Here it is:' || chr(10) || '```json' || chr(10) || body || chr(10) || '```'
           WHEN 1 THEN '```json' || chr(10) || '{"question": "draft"}' || chr(10) || '```' || chr(10) || 'Better:' || chr(10) || '```json' || chr(10) || body || chr(10) || '```'
           WHEN 2 THEN body
           WHEN 3 THEN 'Result: ' || body || ' done.'
           WHEN 4 THEN '```json' || chr(10) || '{"question": ["' || """
    + sql_escape("line")
    + r""" || '"' || chr(10) || '}' || chr(10) || '```'
           WHEN 5 THEN 'I cannot answer. ' || line
           WHEN 6 THEN '```json' || chr(10) || '{"question": "无法设计出问题", "answer": "' || """
    + sql_escape("line")
    + r""" || '"}' || chr(10) || '```'
           ELSE '```json' || chr(10) || '{''question'': ''single ' || ord || ''', ''answer'': ''' || """
    + sql_escape_single("line")
    + r""" || '''}' || chr(10) || '```' END AS content
  FROM bodies
)"""
)

REPLY_SCHEMA = "question string, answer string, question_type string, rank int"


def single_quoted(col: str) -> Column:
    return F.replace(escape_json(col), F.lit("'"), F.lit(SINGLE_QUOTE))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    lit, i = F.lit, F.col("ord").cast("string")
    body = F.concat(
        lit('{"question": "What about line '), i, lit('?", "answer": "'), escape_json("line"),
        lit('", "question_type": '), F.when(F.col("ord") % 3 == 0, "null").otherwise('"reasoning"'),
        lit(', "rank": '), i, lit("}"),
    )
    shape = (F.col("doc_id") + F.col("ord")) % 8

    def fenced(text: Column) -> Column:
        return F.concat(lit("```json\n"), text, lit("\n```"))

    staged = lines(spark, sf_dir).withColumn("body", body)
    b = F.col("body")
    content = (
        F.when(shape == 0, F.concat(lit("Here it is:\n"), fenced(b)))
        .when(shape == 1, F.concat(fenced(lit('{"question": "draft"}')), lit("\nBetter:\n"), fenced(b)))
        .when(shape == 2, b)
        .when(shape == 3, F.concat(lit("Result: "), b, lit(" done.")))
        .when(shape == 4, fenced(F.concat(lit('{"question": ["'), escape_json("line"), lit('"\n}'))))
        .when(shape == 5, F.concat(lit("I cannot answer. "), "line"))
        .when(shape == 6, fenced(F.concat(lit('{"question": "无法设计出问题", "answer": "'), escape_json("line"), lit('"}'))))
        .otherwise(fenced(F.concat(lit("{'question': 'single "), i, lit("', 'answer': '"), single_quoted("line"), lit("'}"))))
    )
    return staged.select(
        F.concat(lit("doc"), F.col("doc_id").cast("string")).alias("source_file"),
        F.col("ord").alias("chunk_index"),
        F.col("n_lines").alias("total_chunks"),
        F.col("line").alias("text_content"),
        "body",
        shape.alias("shape"),
        content.alias("content"),
    )


# --- knowledge records: what a chunk's reply holds ----------------------------------------------

KNOWLEDGE_SQL = (
    LINES_SQL
    + r""",
knowledge AS (
  SELECT 'doc' || doc_id AS source_file, ord AS chunk_index, n_lines AS total_chunks, line,
         regexp_extract_all(lower(line), '[\p{L}]{7,}') AS key_concepts,
         regexp_extract_all(line, '\p{Lu}\p{Ll}+') AS materials,
         regexp_extract_all(lower(line), '[\p{L}]{3,4}') AS methods
  FROM lines
)"""
)


def knowledge(spark: SparkSession, sf_dir: str) -> DataFrame:
    def found(text: Column, pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    line = F.col("line")
    no_text = F.lit(None).cast("string")
    pair = F.struct(
        F.concat(F.lit("Q"), F.col("ord").cast("string")).alias("question"),
        line.alias("answer"),
        no_text.alias("question_type"),
        no_text.alias("difficulty"),
        no_text.alias("reasoning"),
    )
    return lines(spark, sf_dir).select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("source_file"),
        F.col("ord").alias("chunk_index"),
        F.col("n_lines").alias("total_chunks"),
        F.array(pair).alias("qa_pairs"),
        found(F.lower(line), r"[\p{L}]{7,}").alias("key_concepts"),
        F.struct(
            found(line, r"\p{Lu}\p{Ll}+").alias("materials"),
            F.array().cast("array<string>").alias("parameters"),
            found(F.lower(line), r"[\p{L}]{3,4}").alias("methods"),
        ).alias("technical_details"),
        F.array(line).alias("main_findings"),
    )


# --- multiple choice from orders, subgraphs from line items -------------------------------------

MCQ_SQL = """
mcq AS (
  SELECT o_orderkey AS id, 'Which priority has order ' || o_orderkey || '?' AS question,
         CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE CAST(o_orderkey % 6 AS VARCHAR) END AS answer,
         ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'] AS choices,
         CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 AS gt, o_orderstatus AS status,
         CASE o_orderkey % 3 WHEN 0 THEN './' WHEN 1 THEN '/' ELSE '' END || 'orders/' || o_custkey || '/' || o_orderkey || '.png' AS image_path
  FROM orders
)"""


def mcq(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    text = key.cast("string")
    choices = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    root = F.when(key % 3 == 0, "./").when(key % 3 == 1, "/").otherwise("")
    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        F.concat(F.lit("Which priority has order "), text, F.lit("?")).alias("question"),
        F.when(key % 3 == 0, F.col("o_orderpriority")).otherwise((key % 6).cast("string")).alias("answer"),
        F.array(*[F.lit(c) for c in choices]).alias("choices"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("gt"),
        F.col("o_orderstatus").alias("status"),
        F.concat(root, F.lit("orders/"), F.col("o_custkey").cast("string"), F.lit("/"), text, F.lit(".png")).alias("image_path"),
    )


SUBGRAPHS_SQL = """
items AS (
  SELECT l_orderkey AS graph_id, l_linenumber, p_name, p_type, l_suppkey
  FROM lineitem JOIN part ON p_partkey = l_partkey
),
subgraphs AS (
  SELECT graph_id, count(DISTINCT p_name) + count(DISTINCT l_suppkey) AS num_nodes, count(*) AS num_edges,
         string_agg(DISTINCT p_name, ' ') AS names
  FROM items GROUP BY graph_id
)"""


def graph_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One graph per order: its parts and suppliers as nodes, its lines as edges."""
    items = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("p_partkey") == F.col("l_partkey")
    )
    supplier = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    edges = items.select(
        F.col("l_orderkey").alias("graph_id"),
        supplier.alias("source"),
        F.col("p_name").alias("target"),
        F.lit("supplies").alias("relation"),
    )
    nodes = edges.select(
        "graph_id",
        F.explode(
            F.array(
                F.struct(F.col("source").alias("id"), F.lit("supplier").alias("type")),
                F.struct(F.col("target").alias("id"), F.lit("part").alias("type")),
            )
        ).alias("node"),
    ).select("graph_id", "node.*")
    return nodes, edges


# --- deterministic stand-ins for models, stated in SQL as well -----------------------------------

def _digest(prompt: str) -> str:
    return hashlib.md5(prompt.encode()).hexdigest()


def echo_client():
    """Replies with the digest of the prompt; one prompt in sixteen always fails."""

    def ask(prompt: str) -> str:
        d = _digest(prompt)
        if d[0] == "0":
            raise ConnectionError("model unavailable")
        return "reply " + d

    return ask


def echo_sql(prompt: str) -> str:
    return f"CASE WHEN md5({prompt})[1] <> '0' THEN 'reply ' || md5({prompt}) END"


def judge_client():
    """Mostly approves; rejects, rambles or fails for some prompts."""

    def ask(prompt: str) -> str:
        head = _digest(prompt)[0]
        if head == "f":
            raise ConnectionError("model unavailable")
        if head in "01":
            return "-1"
        return "cannot tell" if head == "2" else "Score: 1"

    return ask


def judge_sql(prompt: str) -> str:
    head = f"md5({prompt})[1]"
    return (
        f"CASE WHEN {head} IS NULL OR {head} = 'f' THEN NULL WHEN {head} IN ('0', '1') THEN '-1' "
        f"WHEN {head} = '2' THEN 'cannot tell' ELSE 'Score: 1' END"
    )


def first_int_sql(text: str) -> str:
    return rf"coalesce(TRY_CAST(nullif(regexp_extract({text}, '-?\d+'), '') AS INT), 0)"


def bucket_sql(*parts: str) -> str:
    key = " || '|' || ".join(parts)
    return f"CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT)"


# --- documents staged as files --------------------------------------------------------------------

_staged: dict[tuple[str, str], str] = {}


def document_files(spark: SparkSession, sf_dir: str) -> str:
    """Every document as a text file of its own, in a folder per language; staged once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged:
        path = new_scratch_path(spark, "documents")
        text_sink(documents(spark, sf_dir), path, "text", "lang")
        _staged[key] = path
    return _staged[key]
