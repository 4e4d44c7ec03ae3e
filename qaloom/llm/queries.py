"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from qaloom.llm import alignment, decontamination, fmindex, jaccard, lm, packing, pii, sharding, simple8b, suffixes, topk, toxicity, zfast
from qaloom.llm.common import held_out, table
from qaloom.llm.registry import ORACLES, QUERIES, query
from qaloom.session import new_scratch_path

__all__ = ["ORACLES", "QUERIES"]


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query(
    "op2_exact_topk",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
    ), r AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
)
def op2_exact_topk(spark, sf_dir):
    vectors = topk.usable_vectors(table(spark, sf_dir, "embeddings"), 1024)
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)


@query("op3_proportional_interleaving")
def op3_proportional_interleaving(spark, sf_dir):
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.interleave(rows).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op6_weak_supervision_toxicity")
def op6_weak_supervision_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    classifier = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_texts(docs, classifier).select(
        "doc_id", held_out("doc_id", 5).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), i AS (
  SELECT item_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), iw AS (
  SELECT item_id, least(len(w), 10) AS n, array_to_string(w[s + 1 : s + least(len(w), 10)], ' ') AS g
  FROM (SELECT *, unnest(range(greatest(len(w) - 10, 0) + 1)) AS s FROM i WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM iw), dw AS (
  SELECT r, s, n, array_to_string(w[s + 1 : s + n], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)
), hit AS (SELECT DISTINCT r, s, dw.n, item_id FROM dw JOIN iw USING (g)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS xs FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(xs, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


@query("op9_positional_index_decontamination", OP9_SQL)
def op9_positional_index_decontamination(spark, sf_dir):
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 4], ' ') AS g
  FROM (SELECT *, unnest(range(greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y USING (g) WHERE x.doc_id < y.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (
  SELECT doc_id AS node, doc_id AS least FROM d
  UNION
  SELECT e.b, reach.least FROM reach JOIN e ON e.a = reach.node WHERE reach.least < e.b
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node AS doc_id, min(least) AS component_id FROM reach GROUP BY node) c USING (doc_id)
"""


@query("op10_ngram_jaccard_join", OP10_SQL)
def op10_ngram_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op4_bilstm_crf_pii")
def op4_bilstm_crf_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_spans(docs, pii.fit(docs))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@query("op8_log_bilinear_lm")
def op8_log_bilinear_lm(spark, sf_dir):
    return lm.score_documents(table(spark, sf_dir, "documents"))


@query("op5_columnwise_suffix_dedup")
def op5_columnwise_suffix_dedup(spark, sf_dir):
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_fm_index_dedup")
def op7_fm_index_dedup(spark, sf_dir):
    return fmindex.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_simple8b_ids")
def op11_simple8b_ids(spark, sf_dir):
    path = new_scratch_path(spark, "token-ids")
    simple8b.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1, by_word=True)
    return simple8b.read_ids(spark, path)


@query("op12_diagonal_run_alignment")
def op12_diagonal_run_alignment(spark, sf_dir):
    return alignment.align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))


# crc32 of the decimal id, bit by bit: a character is xored in, then eight shifts (-1) follow.
OP13_SQL = r"""
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
         CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                 md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS BIGINT) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
           lambda l: [CAST(ord(l) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
         lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a // 2, (a % 2) * 3988292384) END), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM o)
), t AS (
  SELECT c.conv_id, 0 AS own, p, r, x FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 5 WHERE p < h
  UNION ALL SELECT c.conv_id, 1, p, r, x FROM c JOIN o ON o.conv_id = c.conv_id WHERE p >= h
), s AS (
  SELECT c.conv_id, coalesce(q.s, []) AS s, coalesce(q.b, []) AS b
  FROM c LEFT JOIN (SELECT conv_id, list(length(r) || ':' || r || x ORDER BY own, p) AS s, list(CAST(strlen(x) AS BIGINT) ORDER BY own, p) AS b
                    FROM t GROUP BY conv_id) q ON q.conv_id = c.conv_id
), m AS (
  SELECT conv_id, d, s[1:d] AS k, CASE WHEN d > 0 THEN b[d] ELSE 0 END AS size, d = len(s) AS ends
  FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM s)
), n AS (
  SELECT k, CAST(min(d) AS BIGINT) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size,
         coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS e
  FROM m GROUP BY k
), kids AS (SELECT k[1:depth - 1] AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids ON kids.k = n.k),
sub AS (
  SELECT k[1:a] AS k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS a FROM w) GROUP BY ALL
)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, CAST(sub.n_leaves AS BIGINT) AS n_leaves,
       CAST(sub.saved_tokens AS BIGINT) AS saved_tokens, sha256(w.e) AS ends_sha256
FROM w JOIN sub ON sub.k = w.k LEFT JOIN w p ON w.depth > 0 AND p.k = w.k[1:w.depth - 1]
"""


@query("op13_zfast_conversation_trie", OP13_SQL)
def op13_zfast_conversation_trie(spark, sf_dir):
    return zfast.conversation_trie(table(spark, sf_dir, "conversations"))
