import random

from pyspark.sql import functions as F

from qaloom.operators import merge

SCHEMA = (
    "source_file string, chunk_index int, total_chunks int, qa_pairs array<struct<question string>>, key_concepts array<string>, "
    "technical_details struct<materials array<string>, parameters array<string>, methods array<string>>, main_findings array<string>"
)


def records(n_sources=4, seed=1):
    rng = random.Random(seed)
    rows = []
    for s in range(n_sources):
        n = [1, 3, 7, 25][s % 4]
        for i in range(n):
            def some():
                return [f"v{rng.randrange(12)}" for _ in range(rng.randrange(5))]

            rows.append((f"s{s}", i, n, [(f"q{i}",)], None if rng.random() < 0.2 else some(), (some(), some(), some()), [f"f{i}"]))
    rng.shuffle(rows)
    return rows


def brute(rows):
    out = {}
    for source in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == source), key=lambda r: r[1])
        single = mine[0][2] == 1

        def joined(pick):
            values = [v for r in mine for v in (pick(r) or [])]
            return values if single else list(dict.fromkeys(values))

        out[source] = (
            [p[0] for r in mine for p in r[3]], joined(lambda r: r[4]), joined(lambda r: r[5][0]), joined(lambda r: r[5][1]),
            joined(lambda r: r[5][2]), [f for r in mine for f in r[6]],
        )
    return out


def merged(spark, rows, parts=3):
    found = merge.merge_chunk_knowledge(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    assert len(found) == len({r[0] for r in rows})
    out = {}
    for r in found:
        d = r.technical_details
        out[r.source_file] = ([p.question for p in r.qa_pairs], r.key_concepts, d.materials, d.parameters, d.methods, r.main_findings)
    return out


def test_knowledge_matches_brute_force_one_row_a_source(spark):
    rows = records()
    want = brute(rows)
    assert merged(spark, rows) == want
    assert merged(spark, rows, parts=1) == want
    long = [("long", i, 5000, [(f"q{i}",)], [f"v{i % 7}"], ([], [], []), []) for i in range(5000)]
    only = merge.merge_chunk_knowledge(spark.createDataFrame(long, SCHEMA)).collect()
    assert len(only) == 1 and len(only[0].qa_pairs) == 5000 and only[0].key_concepts == [f"v{i}" for i in range(7)]


def test_long_form_agrees_with_the_rows(spark):
    rows = records()
    want = {k: v for k, v in brute(rows).items() if k != "s0"}
    got = {}
    for r in merge.chunk_values(spark.createDataFrame(rows, SCHEMA)).orderBy("source_file", "list", "position").collect():
        got.setdefault(r.source_file, {}).setdefault(r["list"], []).append(r.value)
    for source, (_, concepts, materials, parameters, methods, _) in want.items():
        lists = dict(key_concepts=concepts, materials=materials, parameters=parameters, methods=methods)
        assert got[source] == {k: v for k, v in lists.items() if v}


def test_single_records_stay_apart(spark):
    one = (["k", "k"], (["m"], [], []), ["f"])
    rows = [("s", None, None, [("q1",)], *one), ("s", 0, 1, [("q2",)], *one), ("s", 0, 1, None, None, None, None)]
    got = merge.merge_chunk_knowledge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((len(r.qa_pairs), r.key_concepts, r.main_findings) for r in got) == [(0, [], []), (1, ["k", "k"], ["f"]), (1, ["k", "k"], ["f"])]
    mixed = spark.createDataFrame(rows[:2] + [("t", i, 2, [], *one) for i in (0, 1)], SCHEMA).withColumn("text_content", F.lit("whole"))
    texts = {(r.source_file, r.chunk_index, r.text_content) for r in merge.merge_chunk_knowledge(mixed).collect()}
    assert texts == {("s", None, "whole"), ("s", 0, "whole"), ("t", None, None)}


def test_text_merge_in_order(spark):
    rows = [("a", i, f"c{i}", None if i == 1 else f"t{i}") for i in (3, 0, 2, 1)] + [("b", None, "only", "t")]
    df = spark.createDataFrame(rows, "source_file string, chunk_index int, content string, text_content string")
    out = {r.source_file: (r.content, r.full_text) for r in merge.merge_chunk_text(df).collect()}
    assert out == {"a": ("c0\n\nc1\n\nc2\n\nc3", "t0\n\nt2\nt3"), "b": ("only", "t")}


def test_dedup_keeps_the_lowest_id(spark):
    df = spark.createDataFrame([(3, "a b"), (1, "A, B!"), (2, "c"), (4, "c"), (5, None), (6, None)], "id int, q string")
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(merge.dedup_records(df, ["q"], "id")) == [1, 2, 3, 5]
    assert ids(merge.dedup_records(df, ["q"], "id", fold=True)) == [1, 2, 5]
