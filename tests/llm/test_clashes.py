"""Stages leave columns alone that are called like their own working columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from qaloom.llm import decontamination, jaccard, pii
from rows import documents, frame

NAMES = ("row_key", "ROW_KEY_", "_row_key", "score", "_score", "spans", "_spans", "found_spans", "key", "row", "n_hit", "bands", "kept")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [r for r in documents() if r[0] is not None]
    return frame(spark, rows, clash=False).select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in NAMES]).cache()


def unharmed(got, docs):
    assert got.columns == docs.columns
    rows = got.collect()
    assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in NAMES)


def test_near_copies(docs):
    unharmed(jaccard.one_of_each(docs), docs)


def test_decontamination(spark, docs):
    items = spark.createDataFrame([("i", "kaban lofol migim nehut pujes raban sider tufol kagim lohut mijes")], "item_id string, text string")
    unharmed(decontamination.drop_contaminated(docs, items), docs)


def test_personal_data(docs):
    unharmed(pii.redact(docs, None), docs)


def test_toxicity(spark, docs, tmp_path):
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 20 == 0).cast("int").alias("toxic")).distinct()
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).columns == docs.columns


def test_most_sequences_come_from_patterns():
    import numpy as np

    from qaloom.llm import packing

    rng = np.random.default_rng(1)
    counts = np.bincount(np.minimum(rng.lognormal(6, 1, 20000).astype(int) + 1, 2048), minlength=2049)
    left = counts.copy()
    left[2048] = 0
    patterns = packing.exact_patterns(np.flatnonzero(counts), 2048)
    fitted, rest = packing.round_repeats(patterns, packing.fit_repeats(patterns, left.astype(float)), left)
    used = np.zeros(2049, int)
    for lengths, n in fitted:
        assert sum(lengths) == 2048
        for v in lengths:
            used[v] += n
    assert (used + rest == left).all()
    patterned, remainder = sum(n for _, n in fitted), sum(n for _, n in packing.pack_rest(rest, 2048))
    assert patterned > 0.8 * (patterned + remainder)
    bound = -(-int(counts @ np.arange(2049)) // 2048)
    assert bound <= packing.plan_packing(counts).sequences <= bound * 1.002 + 1


def test_vectors_without_an_id_take_no_part(spark):
    from qaloom.llm import topk

    rows = spark.createDataFrame([(0, [1.0, 2.0]), (None, [9.0, 9.0]), (1, [2.0, 1.0]), (2, None), (3, [None, 1.0])], "vec_id long, embedding array<double>")
    usable = topk.usable_vectors(rows, 1024)
    found = topk.top_k(usable, usable.where("vec_id = 0"), 10).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found] == [(0, 1, 1, 4 * 1024 * 1024)]
