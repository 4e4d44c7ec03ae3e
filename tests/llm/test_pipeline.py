"""The pipeline's stages, one after another, against brute force on small tables with planted cases."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from qaloom.llm import packing, pii
from qaloom.session import materialize
from rows import WORDS
from test_corpus import JSON, RANKS, bench_words, private_texts

BAD = ["vileone", "grubby", "rotten", "vileish"]


def planted():
    """(doc_id, text), labels, benchmark; kinds by id: 0-599 plain or toxic, then copies, leaks, private."""
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for k in range(600):
        words, toxic = list(rng.choice(WORDS, 40)), k % 6 == 0
        if toxic:
            for at in rng.choice(40, 5, replace=False):
                words[at] = str(rng.choice(BAD))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    for k in range(20):  # near copies of clean documents, the first ones exact
        words = rows[6 * k + 1][1].split()
        if k > 4:
            words[-1] = "other"
        rows.append((1000 + k, " ".join(words)))
    items = [(k, " ".join(rng.choice(WORDS, 15))) for k in range(5)]
    rows += [(2000 + k, f"{' '.join(rng.choice(WORDS, 9))} {items[k % 5][1].upper()} tail") for k in range(10)]
    rows += [(3000 + k, t) for k, t in enumerate(private_texts(60, 8))]
    rows += [(4000, None), (4001, ""), (None, "a lone text without id"), rows[1]]
    return rows, labels, items


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, labels, items = planted()
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "CAST(length(text) AS bigint) AS n_chars", "1 AS key")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[k: k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()


def test_stages_in_turn(spark, tables):
    rows, labels, items = planted()
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, tables), "stage")
        if name != "packing":
            assert docs.columns == columns
            seen[name] = [(r.doc_id, r.text) for r in docs.collect()]

    toxic = {k for k, _, t in labels if t}
    left = {k for k, _ in seen["toxicity"]}
    assert len(toxic & left) <= 2 and not {k for k, _ in rows} - left - toxic

    groups, kept = seen["toxicity"], []
    sets = [shingles(t) for _, t in groups]
    root = list(range(len(groups)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    owners = {}
    for i, s in enumerate(sets):
        for g in s:
            owners.setdefault(g, []).append(i)
    for i, j in {(i, j) for members in owners.values() for i in members for j in members if i < j}:
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            root[max(find(i), find(j))] = min(find(i), find(j))
    best = {}
    for i, (key, text) in enumerate(groups):
        if not sets[i]:
            kept.append((key, text))
        else:
            best.setdefault(find(i), []).append((key is None, key or 0, key, text))
    kept += [min(m)[2:] for m in best.values()]
    assert sorted(map(str, seen["near copies"])) == sorted(map(str, kept))

    windows = {tuple(w[k: k + 10]) for _, t in items for w in [bench_words(t)] for k in range(len(w) - 9)}
    clean = [(k, t) for k, t in seen["near copies"]
             if not any(tuple(w[k: k + 10]) in windows for w in [bench_words(t)] for k in range(len(w) - 9))]
    assert sorted(map(str, seen["benchmark decontamination"])) == sorted(map(str, clean)) and len(clean) < len(kept)

    before = dict(seen["benchmark decontamination"])
    for key, text in seen["personal data"]:
        assert not pii.pattern_spans(text or "")
        if not pii.pattern_spans(before[key] or "") and not pii.CUE.search(before[key] or ""):
            assert text == before[key]
    assert all("[EMAIL]" in t and "[PHONE]" in t for k, t in seen["personal data"] if k and 3000 <= k < 4000)

    encode = packing.encoder(JSON, RANKS)
    want = {}
    for key, text in seen["personal data"]:
        ids = np.array(encode(text or "") + [0], "<u4")
        want[key] = (len(ids), zlib.crc32(ids.tobytes()))
    got = docs.collect()
    assert {r.doc_id: (r.length, r.ids_crc32) for r in got} == want
    totals = docs.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 2048 for r in totals)


def test_run_gives_the_last_stage(spark, tables):
    got = corpus_pipeline.run(spark, tables)
    assert got.columns[:2] == ["doc_id", "piece"] and got.count() > 400
