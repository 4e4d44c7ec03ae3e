import pytest
from pyspark.sql import functions as F

from qaloom.operators import planning, prepare, quality, stats
from qaloom.session import checked_broadcast, global_index, scratch_dir

# The recorded example set: four equal factual pairs of one file.
QUESTION = "What is the main topic discussed in this text?"
ANSWER = "The text discusses semiconductor technology and its applications in modern electronics."


@pytest.fixture(scope="module")
def golden(spark):
    return spark.createDataFrame(
        [(QUESTION, ANSWER, "factual", "test.txt", 0)] * 4,
        "question string, answer string, question_type string, source_file string, quality_label int",
    )


def test_golden_statistics(golden):
    r = stats.qa_stats(golden).first()
    assert (r.total_qa_pairs, r.factual_count, r.reasoning_count) == (4, 4, 0)
    assert (r.average_question_length, r.average_answer_length) == (46.0, 87.0)
    assert (r.factual_percent, r.open_ended_percent) == ("100.0%", "0.0%")
    assert stats.source_counts(golden).first() == ("test.txt", 4)


def test_golden_report(golden):
    r = stats.quality_report(golden, 0.7).first()
    assert (r.total_qa_pairs, r.passed_qa_pairs, r.pass_rate, r.meets_threshold) == (4, 0, 0.0, False)
    assert r.question_types_distribution == {"factual": 4}
    assert (r.avg_question_length, r.avg_answer_length) == (46.0, 87.0)


def test_empty_sets(golden):
    none = golden.limit(0)
    s, r = stats.qa_stats(none).first(), stats.quality_report(none).first()
    assert s.total_qa_pairs == 0 and s.average_answer_length == 0 and s.factual_percent == "0.0%"
    assert r.total_qa_pairs == 0 and r.pass_rate == 0 and r.question_types_distribution == {}
    assert stats.file_stats(none).first() == (0, 0, 0.0)
    assert quality.check_summary(none.withColumn("passed", F.lit(True))).first() == (0, 0, 0.0)


def test_unknown_types(spark):
    df = spark.createDataFrame([(None,), ("multi_hop",), ("multi_x",)], "question_type string")
    assert {(r.question_type, r.qa_pairs) for r in stats.type_distribution(df).collect()} == {("unknown", 1), ("multi_hop", 1), ("multi_x", 1)}
    assert {(r.type_prefix, r.share) for r in stats.type_share(df, "question_type").collect()} == {("unknown", "33.3%"), ("multi", "66.7%")}


def test_vote_mean_at_the_pass_score(spark):
    df = spark.createDataFrame([(1, "r"), (2, "r"), (3, "r")], "id int, reasoning_content string")
    votes = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, -1), (3, 1), (3, 0)], "id int, score int")
    kept = quality.vote_filter(df, votes, ["id"])
    assert [r.id for r in kept.collect()] == [1] and kept.columns == ["id"]
    assert quality.vote_filter(df, votes, ["id"], 0.5).count() == 2


def test_dimensions(spark):
    df = spark.createDataFrame([(1, [1, -1]), (2, [0, 0]), (3, [1, 0]), (4, [])], "id int, s array<int>")
    checks = F.transform("s", lambda s, i: F.struct(F.concat(F.lit("c"), i.cast("string")).alias("name"), s.alias("score"), F.lit("why").alias("reason")))
    rows = {r.id: r for r in quality.dimension_score(df.withColumn("checks", checks)).withColumn("x", quality.suggestions()).collect()}
    assert [(rows[i].overall_score, rows[i].passed) for i in (1, 2, 3, 4)] == [(0.0, False), (0.0, False), (0.5, True), (0.0, False)]
    assert rows[1].x == ["c1: why"] and rows[2].x == ["c0: why", "c1: why"]


def test_plan_for_thirty_rows(spark):
    planned = planning.plan_question_types(spark.range(30).repartition(4), "id")
    rows = planned.collect()
    due = {(r.row_index, r.question_type) for r in rows}
    moduli = {"factual": 6, "comparison": 6, "reasoning": 2, "open_ended": 5}
    want = {(i, t) for i in range(30) for t, m in moduli.items() if i % m == 0 or i == 29}
    assert want <= due and len(want) == 35 and len(rows) == 46
    assert {r.row_index for r in rows} == set(range(30)) and all(r.id == r.row_index for r in rows)


def test_global_index_matches_sort(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), F.md5(F.col("id").cast("string")).alias("v")).repartition(7)
    rows = global_index(df, F.desc("v"), "k", total="n", partitions=6).collect()
    assert [r.v for r in sorted(rows, key=lambda r: r.row_index)] == sorted((r.v for r in rows), reverse=True)
    assert sorted(r.row_index for r in rows) == list(range(1000)) and {r.n for r in rows} == {1000}
    assert global_index(df.limit(0), "k").count() == 0


def test_quota_adds_up(spark):
    for ratios in planning.RATIO_PRESETS.values():
        df = spark.createDataFrame([(n,) for n in (0, 1, 7, 50, 333, 10000)], "total int")
        sums = planning.type_quota(df, ratios).groupBy("total").agg(F.sum("target").alias("s"), F.min("target").alias("m")).collect()
        assert all(r.s == r.total and r.m >= 0 for r in sums) and len(sums) == 6


def test_max_types(spark):
    cases = [(2, 9, 1), (9, 1, 1), (4, 9, 2), (9, 3, 2), (8, 9, 3), (9, 6, 3), (9, 7, 4)]
    df = spark.createDataFrame(cases, "num_nodes int, num_edges int, want int")
    assert all(r.got == r.want for r in df.withColumn("got", planning.subgraph_max_types()).collect())


def test_category(spark):
    qs = ["怎么实现短沟道的顶栅氧化物TFT器件", "OLED显示时会出现残影", "介电层厚度", "天气", None]
    df = spark.createDataFrame([(q,) for q in qs], "question string")
    got = [r.c for r in df.select(planning.question_category().alias("c")).collect()]
    assert got == ["TFT器件技术", "OLED显示技术", "薄膜制造工艺", "通用技术问题", "通用技术问题"]


def test_fixed_questions_on_sample_graphs(spark):
    rows = [(1, ["TFT器件", "短沟道"]), (2, ["OLED显示"]), (3, ["PCB基板"])]
    df = spark.createDataFrame(rows, "id int, names array<string>").select(
        "id", F.transform("names", lambda n: F.struct(n.alias("id"))).alias("nodes")
    ).withColumn("features", planning.node_features())
    questions = [(1, "如何避免TFT失效"), (2, "OLED残影如何改善"), (3, "TFT驱动OLED")]
    got = {(r.id, r.question_id, r["rank"]) for r in planning.fixed_question_match(df, questions, 2).collect()}
    assert got == {(1, 1, 1), (1, 3, 2), (2, 2, 1), (2, 3, 2)}


def test_graphs_as_tables(spark):
    nodes = spark.createDataFrame([(1, "TFT x"), (1, "TFT x"), (1, "gate"), (2, "OLED")], "graph_id int, id string")
    edges = spark.createDataFrame([(1,), (1,), (3,)], "graph_id int")
    got = {tuple(r) for r in planning.graph_profile(nodes, edges).collect()}
    assert got == {(1, 2, 2), (2, 1, 0), (3, 0, 1)}
    assert {r.graph_id: r.features for r in planning.graph_features(nodes).collect()} == {1: ["semiconductor"], 2: ["display"]}


def test_observed_stages(spark):
    df = spark.createDataFrame([(1, None), (2, "down"), (3, None)], "id int, error string")
    checked, seen = stats.observe_stage(df, "checked")
    kept, kept_seen = stats.observe_stage(checked.filter("error IS NULL").drop("error"), "kept")
    assert kept.count() == 2
    got = stats.observed_report(spark, {"checked": seen, "kept": kept_seen})
    plain = stats.stage_report({"checked": df, "kept": df.filter("error IS NULL").drop("error")})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_nested_graph_profile(spark):
    df = spark.sql("SELECT array(struct('a' AS id), struct('b' AS id)) AS nodes, array(struct('a' AS source, 'b' AS target)) AS edges")
    assert planning.subgraph_profile(df).select("num_nodes", "num_edges").first() == (2, 1)


def test_bands(spark):
    df = spark.createDataFrame([(0.95,), (0.8,), (0.75,), (0.6,), (0.55,), (0.4,), (0.1,)], "t double")
    got = [r.b for r in df.select(quality.threshold_band("t").alias("b")).collect()]
    assert got == ["strict", "strict", "standard", "standard", "loose", "loose", "none"]


def test_length_filter(spark):
    df = spark.createDataFrame([("x" * 49,), ("x" * 50,), ("x" * 10000,), ("x" * 10001,), (" " * 60,), (None,)], "content string")
    assert sorted(len(r.content) for r in prepare.length_filter(df).collect()) == [50, 10000]


def test_sample_is_stable(spark):
    a = {r.id for r in prepare.sample_documents(spark.range(100).repartition(3), 10, "id", seed="s").collect()}
    b = {r.id for r in prepare.sample_documents(spark.range(100), 10, "id", seed="s").collect()}
    assert a == b and len(a) == 10


def test_broadcast_is_checked(spark):
    small = spark.range(10)
    assert "ResolvedHint" in checked_broadcast(small, 10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in checked_broadcast(small, 9)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in checked_broadcast(small, 10, 5)._jdf.queryExecution().analyzed().toString()
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
