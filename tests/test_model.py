import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from qaloom.operators import augment, prompts, quality
from qaloom.operators.model import ask, drop_failed, embed_map, model_map
from qaloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_ask_retries_until_it_works():
    calls = []

    def flaky(prompt):
        calls.append(prompt)
        if len(calls) < 3:
            raise TimeoutError("slow")
        return "ok"

    assert ask(flaky, ("p",), 5, 0.0) == ("ok", None, None)
    assert len(calls) == 3
    assert ask(lambda p: None, ("p",), 2, 0.0) == (None, "empty reply", None)
    assert ask(lambda p: 1 / 0, ("p",), 2, 0.0)[1].startswith("ZeroDivisionError")
    assert ask(lambda p: "x", (None,), 2, 0.0) == (None, None, None)


def shout():
    def client(prompt):
        if "bad" in prompt:
            raise ValueError("bad prompt")
        return prompt.upper()

    return client


@pytest.mark.parametrize("concurrency, partitions", [(1, None), (4, 3)])
def test_model_map_keeps_rows(spark, concurrency, partitions):
    df = spark.createDataFrame([(i, "bad" if i == 3 else None if i == 4 else f"p{i}") for i in range(20)], "id int, prompt string")
    out = model_map(df, shout, concurrency=concurrency, tries=2, pause=0.0, partitions=partitions)
    got = {r.id: (r.reply, r.error) for r in out.collect()}
    assert len(got) == 20 and got[0] == ("P0", None) and got[3] == (None, "ValueError: bad prompt") and got[4] == (None, None)
    assert drop_failed(out).count() == 18


def test_each_prompt_is_sent_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counting():
        def client(prompt):
            seen.add(1)
            return prompt

        return client

    df = spark.range(50).select(F.col("id").cast("string").alias("prompt"))
    stored = materialize(model_map(df, counting, tries=1, pause=0.0).filter("reply <> '7'"))
    assert stored.count() == 49 and stored.filter("length(reply) = 2").count() == 40
    assert seen.value == 50


def test_embed_map(spark):
    df = spark.createDataFrame([("ab",), ("c",), (None,)], "content string")
    out = embed_map(df, lambda: lambda texts: [[float(len(t)), 1.0] for t in texts], batch=2)
    assert sorted(r.embedding for r in out.collect()) == [[0.0, 1.0], [1.0, 1.0], [2.0, 1.0]]


def test_render_checks_fields(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    assert prompts.render_prompt(df, "{a}-{b}-{{c}}").first().prompt == "x--{c}"
    with pytest.raises(KeyError):
        prompts.render_prompt(df, "{missing}")
    with pytest.raises(ValueError):
        prompts.template_fields("{a.b}")
    registry = prompts.PromptRegistry({1: "one {a}", 2.5: "two"}, {"x": "three"})
    assert registry.ids() == ["1", "2.5", "x"] and registry.get(9) == "" and registry.get(2.5) == "two"
    with pytest.raises(KeyError):
        registry.render_by_id(df.withColumn("prompt_id", F.lit("9")), [9])


def test_registry_table(spark):
    df = spark.createDataFrame([("1",), ("9",), (None,)], "prompt_id string")
    table = spark.createDataFrame([("1", "one")], "prompt_id string, template string")
    assert sorted(r.template for r in prompts.prompt_lookup(df, table).collect()) == ["", "", "one"]


def test_dual_stage(spark):
    def judge():
        def client(prompt):
            if prompt.startswith("ask"):
                return "my answer"
            if "boom" in prompt:
                raise RuntimeError("down")
            return "-1" if "wrong" in prompt else "1"

        return client

    rows = [("q", "right"), ("q", "wrong"), ("", "a"), (None, "a"), ("q", ""), ("boom", "a")]
    df = spark.createDataFrame(rows, "question string, answer string")
    out = quality.dual_stage_verify(df, judge, "ask {question}", "{question} {standard_answer} {model_answer}", tries=1, pause=0.0)
    got = {(r.question, r.answer): (r.quality_label, r.error, r.verification_details) for r in out.collect()}
    assert got[("q", "right")][0] == 1 and got[("q", "wrong")][0] == -1
    assert got[("", "a")][:2] == (0, "incomplete") and got[(None, "a")][2] is None and got[("q", "")][0] == 0
    assert got[("boom", "a")][:2] == (0, "RuntimeError: down")
    assert got[("q", "right")][2].model_answer_length == 9
    high, low = quality.quality_split(out)
    assert high.count() == 1 and low.count() == 4  # the -1 is in neither


def test_preference_bad_judge_is_negative(spark):
    df = spark.createDataFrame([(1, "q")], "id int, question string")

    def judge():
        return lambda p: {"0": "junk", "1": '{"label": "positive"}', "2": '{"x": 1}'}[p[-1]]

    out = augment.preference_sample(df, lambda: lambda p: p[-1], judge, "{question}{sample}", "{response}", "id", n=3, tries=1, pause=0.0)
    row = out.first()
    assert [(s.response, s.label) for s in row.samples] == [("0", "negative"), ("1", "positive"), ("2", "negative")]
    split = augment.preference_pairs(out).first()
    assert split.positives == ["1"] and split.negatives == ["0", "2"]


def test_images_and_reasoning_reach_the_client(spark):
    def factory():
        return lambda prompt, image: (f"{prompt}+{image}", f"because {prompt}")

    df = spark.createDataFrame([(1, "a", "x.png"), (2, "b", None), (3, None, "y.png")], "id int, prompt string, img string")
    got = {r.id: (r.reply, r.error, r.why) for r in model_map(df, factory, image="img", reasoning="why", tries=1, pause=0).collect()}
    assert got == {1: ("a+x.png", None, "because a"), 2: ("b+None", None, "because b"), 3: (None, None, None)}


def test_evolving_keeps_the_reasoning(spark):
    def factory():
        return lambda prompt: (prompt.upper(), f"r{len(prompt)}")

    df = spark.createDataFrame([(1, "q", "a", "z")], "id int, prompt string, answer string, reasoning string")
    row = augment.evolve_dataset(df, factory, {"deepen": "d: {prompt}"}, "{method}|{instruction}", "id", with_reasoning=True, tries=1, pause=0).first()
    assert row.new_output == "R4|D: Q" and row.reasoning_content == "r7"


def test_first_rows_by_cut(spark, monkeypatch):
    from qaloom import session

    df = spark.range(50).selectExpr("id", "id % 7 AS g").repartition(4)
    want = [r.id for r in session.first_rows(df, 11, "g", "id").orderBy("g", "id").collect()]
    monkeypatch.setattr(session, "ROWS_IN_ONE_TASK", 5)
    assert [r.id for r in session.first_rows(df, 11, "g", "id").orderBy("g", "id").collect()] == want


def test_fan_out_asks_once(spark, tmp_path):
    from qaloom.sources import records

    log = tmp_path / "calls"

    def factory():
        def judge(prompt):
            with open(log, "a") as f:
                f.write("x")
            return "1"

        return judge

    df = spark.createDataFrame([(i, str(i)) for i in range(10)], "id int, prompt string")
    checked = model_map(df, factory, tries=1, pause=0).withColumn("quality_label", F.col("reply").cast("int"))
    records.quality_fanout(checked, lambda rows: rows.groupBy("quality_label").count(), str(tmp_path / "out"))
    assert len(log.read_text()) == 10
