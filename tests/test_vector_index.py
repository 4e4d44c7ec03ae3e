"""The partition index against all pairs, and what it reads; bounds of the blockwise BM25."""

import re
from collections import Counter

import numpy as np
import pytest

from qaloom.operators import retrieval, vector_index


def by_hand(queries, nodes, k):
    out = set()
    for qid, q in queries:
        scored = []
        for nid, n in nodes:
            lengths = np.linalg.norm(q) * np.linalg.norm(n)
            scored.append((-round(float(np.dot(q, n) / lengths) if lengths else 0.0, 6) + 0.0, nid))
        out |= {(qid, nid, round(-s, 6) + 0.0, rank) for rank, (s, nid) in enumerate(sorted(scored)[:k], 1)}
    return out


def frames(spark, queries, nodes):
    return (spark.createDataFrame(queries, "query_id bigint, vector array<double>"), spark.createDataFrame(nodes, "node_id bigint, vector array<double>").repartition(4))


def rows(df):
    return {(r.query_id, r.node_id, round(r.score, 6) + 0.0, r.rank) for r in df.collect()}


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 6))
    nodes = [(i, (centres[i % 20] + rng.normal(scale=0.05, size=6)).tolist()) for i in range(1200)]
    nodes += [(2000 + i, nodes[3][1]) for i in range(600)]  # a third are copies of one
    nodes += [(5000 + i, [0.0] * 6) for i in range(3)]
    queries = [(i, nodes[i * 37][1]) for i in range(25)] + [(100, [0.0] * 6), (101, rng.normal(size=6).tolist()), (102, nodes[3][1])]
    return queries, nodes


@pytest.mark.parametrize("pivots,block", [(64, 4096), (1, 16), (64, 16)])
def test_index_equals_all_pairs(spark, clustered, monkeypatch, pivots, block):
    monkeypatch.setattr(vector_index, "QUERY_BLOCK", block)
    queries, nodes = frames(spark, *clustered)
    index = vector_index.build_index(nodes, pivots)
    assert index.size == len(clustered[1])
    assert rows(vector_index.search_index(index, queries, 10)) == by_hand(*clustered, 10)


def test_index_reads_a_part(spark, clustered):
    queries, nodes = frames(spark, *clustered)
    index = vector_index.build_index(nodes, 64)
    near = queries.filter("query_id BETWEEN 4 AND 5")
    got = rows(vector_index.search_index(index, near, 5))
    assert got == by_hand([q for q in clustered[0] if 4 <= q[0] <= 5], clustered[1], 5)
    assert index.read[-1] < 0.3 * index.size


def test_index_of_little(spark, clustered):
    queries, nodes = frames(spark, *clustered)
    few = vector_index.build_index(nodes.filter("node_id < 4"))
    assert rows(vector_index.search_index(few, queries, 10)) == by_hand(clustered[0], clustered[1][:4], 10)
    assert vector_index.search_index(vector_index.build_index(nodes.limit(0)), queries, 3).count() == 0
    assert vector_index.search_index(few, queries.limit(0), 3).count() == 0
    still = vector_index.build_index(nodes.filter("node_id >= 5000"))
    assert rows(vector_index.search_index(still, queries.filter("query_id < 2"), 2)) == {(q, 5000 + r, 0.0, r + 1) for q in (0, 1) for r in (0, 1)}


def test_bounds_skip_common_words():
    rng = np.random.default_rng(2)
    nodes = [Counter({0: 5, 1: 3} | {int(t): 1 for t in rng.integers(2, 300, 6)}) for _ in range(6000)]
    queries = [(q, t, w) for q in range(20) for t, w in [(0, 0.01), (1, 0.02), *[(int(t), 5.0) for t in np.unique(rng.integers(2, 300, 4))]]]
    block = retrieval._MaxScore(*(np.array(x) for x in zip(*queries)), 5, 1.5, 0.75, 14.0)
    length = np.array([sum(n.values()) for n in nodes])
    for at in range(0, 6000, 500):
        part = [sorted(n.items()) for n in nodes[at: at + 500]]
        block.scan(np.arange(at, at + 500), length[at: at + 500], np.array([len(p) for p in part]), np.array([t for p in part for t, _ in p]),
                   np.array([c for p in part for _, c in p]))
    own = {}
    for q, t, w in queries:
        own.setdefault(q, {})[t] = w
    want = []
    for q, weights in own.items():
        scored = []
        for i, n in enumerate(nodes):
            shared = [t for t in weights if t in n]
            score = sum(weights[t] * n[t] * 2.5 / (n[t] + 1.5 * (0.25 + 0.75 * length[i] / 14.0)) for t in shared)
            scored.append((-round(score, 6), i))
        want += [(q, i) for _, i in sorted(scored)[:5]]
    assert sorted(zip(block.queries[block.best[0]].tolist(), block.best[1].tolist())) == sorted(want)
    assert block.scored < 0.4 * 20 * 6000  # every node shares the common words with every query


def test_words_are_the_same_in_both_branches(spark):
    texts = ["Ünïcode wörds, and_under scores 12 x", "the the cat", None, "", "日本語 テスト the", "ŒUVRE the cat's"]
    nodes = spark.createDataFrame(list(enumerate(texts)), "node_id long, text string")
    queries = spark.createDataFrame([(1, "the CAT wörds"), (2, "日本語 x"), (3, None), (4, "absent")], "query_id long, text string")
    one, other = (rows(retrieval.bm25_topk(queries, nodes, 3, by_blocks=b)) for b in (False, True))
    assert one == other and {r[0] for r in one} == {1, 2} and re.match(r"\w+", "x")
