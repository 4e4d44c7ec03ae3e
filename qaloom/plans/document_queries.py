"""Chunks, text clean-up and page layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaloom.functions import text as tx
from qaloom.operators import chunking, layout, prepare
from qaloom.plans.fixtures import (
    BLOCKS_SQL, LINES_SQL, MARKDOWN_SQL, PAGEDOCS_SQL, blocks, bucket_sql, documents, markdown, pagedocs, table,
)
from qaloom.plans.registry import query

# The window loop as a recursive query: each step cuts one window and passes on where the next starts.
CHUNK_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, text, length(text) AS n FROM documents),
cuts AS (
  SELECT doc_id, 0 AS chunk_index, 0 AS s, {first} AS e, n FROM d
  UNION ALL
  SELECT c.doc_id, c.chunk_index + 1, c.e - 200, {next}, c.n FROM cuts c JOIN d ON d.doc_id = c.doc_id WHERE c.e < c.n
)
SELECT doc_id, chunk_index, (count(*) OVER (PARTITION BY doc_id))::INT AS total_chunks, e - s AS n_chars,
       md5(substr(text, s + 1, e - s)) AS chunk_md5
FROM cuts JOIN d USING (doc_id)
"""


def _cut_sql(start: str, n: str) -> str:
    window = f"substr(d.text, {start} + 1, 2000)"
    options = []
    for sep in ("chr(10) || chr(10)", "'。' || chr(10)", "'。'", "'.' || chr(10)", "'.'", "chr(10)"):
        back = f"strpos(reverse({window}), reverse({sep}))"
        options.append(f"WHEN {back} > 0 AND 2000 - {back} + 1 > 200 THEN {start} + 2000 - {back} + 1")
    return f"CASE WHEN {n} - ({start}) <= 2000 THEN {n} {' '.join(options)} ELSE {start} + 2000 END"


@query("chunk_text", CHUNK_SQL.format(first=_cut_sql("0", "d.n"), next=_cut_sql("c.e - 200", "d.n")))
def chunk_text(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return chunking.chunk_text(docs, "text").select(
        "doc_id", "chunk_index", "total_chunks", F.char_length("chunk").alias("n_chars"), F.md5("chunk").alias("chunk_md5")
    )


@query(
    "chunk_meta",
    f"""WITH {LINES_SQL} SELECT doc_id, ord AS chunk_index, n_lines AS total_chunks, md5(line) AS chunk_md5,
    CASE WHEN n_lines > 1 THEN '(Chunk ' || (ord + 1) || '/' || n_lines || ')' ELSE '' END AS chunk_label FROM lines""",
)
def chunk_meta(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", F.split("text", "\n").alias("chunks"))
    return chunking.chunk_meta(docs).withColumn("chunk_md5", F.md5("chunk")).drop("chunk")


@query(
    "preview",
    "SELECT doc_id, CASE WHEN length(text) > 500 THEN substr(text, 1, 500) || '...' ELSE text END AS text_content FROM documents",
)
def preview(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", tx.preview("text").alias("text_content"))


@query(
    "length_filter",
    r"SELECT doc_id, n_chars FROM documents WHERE length(text) BETWEEN 50 AND 10000 AND regexp_matches(text, '\S')",
)
def length_filter(spark, sf_dir):
    return prepare.length_filter(documents(spark, sf_dir), "text").select("doc_id", "n_chars")


MESSY_SQL = r"replace(replace(text, '. ', '.   ' || chr(9) || ' '), chr(10), '  ' || chr(10) || chr(10) || ' ' || chr(10) || chr(10))"


@query(
    "normalize_text",
    rf"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace({MESSY_SQL}, '[ \t]+', ' ', 'g'),
    ' ?\n ?', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g')) AS text_md5 FROM documents""",
)
def normalize_text(spark, sf_dir):
    messy = F.replace("text", F.lit(". "), F.lit(".   \t "))
    messy = F.replace(messy, F.lit("\n"), F.lit("  \n\n \n\n"))
    return documents(spark, sf_dir).select("doc_id", F.md5(tx.normalize_text(messy)).alias("text_md5"))


@query(
    "figure_refs",
    r"""WITH noted AS (
      SELECT doc_id, 'See Figure A' || doc_id % 4 || ', 图 ' || doc_id % 3 || ' and 图片' || doc_id % 5 || '. '
             || replace(text, '.', ' (fig. ' || doc_id % 7 || ', Fig. 2, figure ' || doc_id % 2 || ', Fig B).') AS t FROM documents)
    SELECT doc_id, array_to_string(list_sort(list_distinct(
      regexp_extract_all(t, '[Ff]igure\s+\d+') || regexp_extract_all(t, '[Ff]ig\.?\s+\d+') || regexp_extract_all(t, '图\s*\d+')
      || regexp_extract_all(t, '图片\s*\d+') || regexp_extract_all(t, 'Figure\s+[A-Za-z]\d*') || regexp_extract_all(t, 'Fig\s+[A-Za-z]\d*'))), '|') AS refs
    FROM noted""",
)
def figure_refs(spark, sf_dir):
    d = F.col("doc_id")

    def mod(m):
        return (d % m).cast("string")

    note = F.concat(F.lit(" (fig. "), mod(7), F.lit(", Fig. 2, figure "), mod(2), F.lit(", Fig B)."))
    noted = F.concat(
        F.lit("See Figure A"), mod(4), F.lit(", 图 "), mod(3), F.lit(" and 图片"), mod(5), F.lit(". "),
        F.replace("text", F.lit("."), note),
    )
    return documents(spark, sf_dir).select("doc_id", F.array_join(tx.figure_refs(noted), "|").alias("refs"))


RANGES_SQL = """ranges AS (
  SELECT doc_id AS doc, 1 AS s, 2 AS e FROM labels UNION ALL SELECT doc_id, 6 + quality, 9 FROM labels UNION ALL SELECT doc_id, 8, 12 FROM labels
)"""


@query(
    "page_range_filter",
    f"""WITH {BLOCKS_SQL}, {RANGES_SQL} SELECT doc, ord, page_idx, type FROM blocks b
    WHERE EXISTS (SELECT 1 FROM ranges r WHERE r.doc = b.doc AND b.page_idx BETWEEN r.s - 1 AND r.e + 1)""",
)
def page_range_filter(spark, sf_dir):
    def span(start, end):
        return F.struct(start.cast("int").alias("start"), F.lit(end).alias("end"))

    ranges = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("doc"), F.array(span(F.lit(1), 2), span(F.lit(6) + F.col("quality"), 9), span(F.lit(8), 12)).alias("pages")
    )
    return layout.page_range_filter(blocks(spark, sf_dir), ranges).select("doc", "ord", "page_idx", "type")


WINDOW_SQL = f"""{BLOCKS_SQL},
pieces AS (
  SELECT doc, ord, page_idx, 0 AS sub, CASE WHEN type = 'image' THEN '![](' || img_path || ')' ELSE text END AS t FROM blocks
  UNION ALL SELECT doc, ord, page_idx, 1, img_caption[1] FROM blocks WHERE len(img_caption) > 0
),
pairs AS (
  SELECT i.doc, i.ord, i.img_path, p.ord AS p_ord, p.sub, p.t FROM blocks i JOIN pieces p
  ON p.doc = i.doc AND p.page_idx BETWEEN greatest(i.page_idx - 1, 0) AND i.page_idx + 1 WHERE i.type = 'image'
)"""


@query(
    "page_window",
    f"""WITH {WINDOW_SQL} SELECT doc, ord, img_path, count(*) AS n_blocks, md5(string_agg(t, '|' ORDER BY p_ord, sub)) AS blocks_md5
    FROM pairs GROUP BY doc, ord, img_path""",
)
def page_window(spark, sf_dir):
    return layout.page_window(blocks(spark, sf_dir)).select(
        "doc", "ord", "img_path", F.size("blocks").alias("n_blocks"), F.md5(F.array_join("blocks", "|")).alias("blocks_md5")
    )


@query(
    "window_pieces",
    f"""WITH {WINDOW_SQL}, shown AS (SELECT DISTINCT doc, page_idx AS page FROM blocks WHERE type = 'image')
    SELECT s.doc, s.page, p.ord, p.sub, md5(p.t) AS text_md5 FROM shown s JOIN pieces p
    ON p.doc = s.doc AND p.page_idx BETWEEN greatest(s.page - 1, 0) AND s.page + 1""",
)
def window_pieces(spark, sf_dir):
    return layout.window_pieces(blocks(spark, sf_dir)).select("doc", "page", "ord", "sub", F.md5("text").alias("text_md5"))


SLICE_SQL = f"""{WINDOW_SQL}, {MARKDOWN_SQL},
placed AS (
  SELECT p.*, m.markdown, strpos(m.markdown, p.t) AS pos FROM pairs p JOIN markdown m USING (doc) WHERE length(p.t) > 0
),
started AS (
  SELECT *, first_value(pos) OVER (PARTITION BY doc, ord ORDER BY CASE WHEN pos > 0 THEN 0 ELSE 1 END, p_ord, sub) AS start FROM placed
),
sliced AS (
  SELECT doc, ord, img_path, any_value(markdown) AS markdown, any_value(start) AS start,
         max(CASE WHEN strpos(substr(markdown, start), t) > 0 THEN strpos(substr(markdown, start), t) - 1 + length(t) ELSE 0 END) AS span
  FROM started GROUP BY doc, ord, img_path
),
context AS (SELECT doc, ord, img_path, substr(markdown, start, span) AS md_content FROM sliced)"""


@query("markdown_slice", f"WITH {SLICE_SQL} SELECT doc, ord, length(md_content) AS n_chars, md5(md_content) AS md_md5 FROM context")
def markdown_slice(spark, sf_dir):
    return layout.markdown_slice(blocks(spark, sf_dir), markdown(spark, sf_dir)).select(
        "doc", "ord", F.char_length("md_content").alias("n_chars"), F.md5("md_content").alias("md_md5")
    )


@query(
    "mark_images",
    rf"""WITH {SLICE_SQL}, tagged AS (
      SELECT doc, ord, replace(regexp_replace(md_content, '!\[.*?\]\((.*?)\)', chr(1) || '\1' || chr(2), 'g'),
             chr(1) || img_path || chr(2), '<image>') AS t FROM context)
    SELECT doc, ord, md5(regexp_replace(t, chr(1) || '[^' || chr(2) || ']*' || chr(2), '<irrelevant>', 'g')) AS md_md5 FROM tagged""",
)
def mark_images(spark, sf_dir):
    sliced = layout.markdown_slice(blocks(spark, sf_dir), markdown(spark, sf_dir))
    return layout.mark_images(sliced).select("doc", "ord", F.md5("md_content").alias("md_md5"))


@query(
    "figure_span",
    f"""WITH {BLOCKS_SQL}, spans AS (
      SELECT doc, arg_min(page_idx, ord) FILTER (WHERE type = 'image' AND len(img_caption) > 0) AS start_page,
             arg_max(page_idx, ord) FILTER (WHERE type = 'image') AS end_page FROM blocks GROUP BY doc)
    SELECT * FROM spans WHERE start_page IS NOT NULL AND end_page IS NOT NULL""",
)
def figure_span(spark, sf_dir):
    return layout.figure_span(blocks(spark, sf_dir))


@query("sample_documents", f"SELECT doc_id, source FROM documents ORDER BY {bucket_sql(chr(39) + '7' + chr(39), 'doc_id')}, doc_id LIMIT 100")
def sample_documents(spark, sf_dir):
    return prepare.sample_documents(documents(spark, sf_dir).select("doc_id", "source"), 100, "doc_id", seed="7")


@query(
    "page_markdown",
    rf"""WITH {PAGEDOCS_SQL}, pieces AS (
      SELECT doc, page_num, '## Page ' || page_num || chr(10) || CASE WHEN regexp_matches(text, '\S') THEN chr(10) || text || chr(10) || chr(10) ELSE '' END
        || coalesce(array_to_string(list_transform(images, lambda i: chr(10) || '![Image](< image >) <!-- ' || i || ' -->' || chr(10)), ''), '') AS p
      FROM pagedocs)
    SELECT doc, page_num, md5(p) AS text_md5, CAST(length('# ' || doc) + 2 + coalesce(sum(length(p) + 1) OVER (
      PARTITION BY doc ORDER BY page_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "at" FROM pieces""",
)
def page_markdown(spark, sf_dir):
    return layout.page_markdown(pagedocs(spark, sf_dir)).select("doc", "page_num", F.md5("text").alias("text_md5"), "at")


@query(
    "pages_to_markdown",
    rf"""WITH {PAGEDOCS_SQL}, pieces AS (
      SELECT doc, page_num, '## Page ' || page_num || chr(10) || CASE WHEN regexp_matches(text, '\S') THEN chr(10) || text || chr(10) || chr(10) ELSE '' END
        || coalesce(array_to_string(list_transform(images, lambda i: chr(10) || '![Image](< image >) <!-- ' || i || ' -->' || chr(10)), ''), '') AS p
      FROM pagedocs)
    SELECT doc, 0 AS part_index, md5('# ' || doc || chr(10) || chr(10) || string_agg(p, chr(10) ORDER BY page_num)) AS markdown_md5 FROM pieces GROUP BY doc""",
)
def pages_to_markdown(spark, sf_dir):
    return layout.pages_to_markdown(pagedocs(spark, sf_dir)).select(
        "doc", F.lit(0).alias("part_index"), F.md5("markdown").alias("markdown_md5")
    )


@query(
    "corpus_summary",
    f"""WITH {PAGEDOCS_SQL}, docs AS (
      SELECT d.doc_id, count(*) AS pages, sum(len(images)) AS images, any_value(d.n_chars) BETWEEN 50 AND 10000 AS success
      FROM documents d JOIN pagedocs p ON p.doc = d.doc_id GROUP BY d.doc_id)
    SELECT count(*) AS documents_found, count(*) FILTER (WHERE success) AS documents_processed, count(*) FILTER (WHERE NOT success) AS documents_failed,
           (sum(pages) FILTER (WHERE success))::BIGINT AS total_pages, (sum(images) FILTER (WHERE success))::BIGINT AS total_images FROM docs""",
)
def corpus_summary(spark, sf_dir):
    pages = pagedocs(spark, sf_dir).groupBy("doc").agg(
        F.count("*").alias("total_pages"), F.sum(F.size("images")).alias("total_images")
    )
    docs = documents(spark, sf_dir).select(
        F.col("doc_id").alias("doc"), F.col("n_chars").between(50, 10000).alias("success")
    )
    return prepare.corpus_summary(docs.join(pages, "doc"))


@query(
    "image_rel_path",
    """WITH p AS (SELECT page_id, string_split(url, '/') AS s FROM pages)
    SELECT page_id, './' || array_to_string(s[greatest(len(s) - 2, 1):], '/') AS image_path FROM p""",
)
def image_rel_path(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.image_rel_path("url").alias("image_path"))


@query(
    "data_uri",
    """SELECT page_id, md5('data:image/' || CASE page_id % 3 WHEN 0 THEN 'png' WHEN 1 THEN 'jpg' ELSE 'webp' END || ';base64,' || base64(encode(html))) AS uri_md5 FROM pages""",
)
def data_uri(spark, sf_dir):
    ext = F.element_at(F.array(F.lit(".png"), F.lit(".JPG"), F.lit(".webp")), (F.col("page_id") % 3 + 1).cast("int"))
    path = F.concat(F.lit("/img/"), F.col("page_id").cast("string"), ext)
    return table(spark, sf_dir, "pages").select(
        "page_id", F.md5(tx.data_uri(path, F.encode("html", "UTF-8"))).alias("uri_md5")
    )


@query(
    "image_dir_listing",
    f"""WITH {PAGEDOCS_SQL}, listed AS (
      SELECT doc, page_num, len(images) AS image_count, unnest(range(len(images))) AS img_index, unnest(images) AS relative_path FROM pagedocs)
    SELECT *, string_split(relative_path, '/')[-1] AS img_name FROM listed""",
)
def image_dir_listing(spark, sf_dir):
    return layout.image_listing(pagedocs(spark, sf_dir))
