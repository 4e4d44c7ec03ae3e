import sys

from pyspark import cloudpickle

from qaloom.operators import augment
from qaloom.operators.model import model_fanout, model_map
from qaloom.plans import quality_queries

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SMOKE = "/root/testdata/sf0.001"


def shout():
    def client(prompt):
        if "bad" in prompt:
            raise ValueError("bad prompt")
        return prompt.upper()

    return client


def python_steps(df):
    return df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_fanout_is_one_call_after_the_other(spark):
    df = spark.createDataFrame([(1, "a", "bad b"), (2, None, "c"), (3, "bad", None)], "id int, p string, q string")
    for concurrency in (1, 3):
        call = {"tries": 1, "pause": 0.0, "concurrency": concurrency}
        one = model_map(model_map(df, shout, "p", "r0", "e0", **call), shout, "q", "r1", "e1", **call)
        both = model_fanout(df, shout, [("p", "r0", "e0"), ("q", "r1", "e1")], **call)
        assert both.columns == one.columns and sorted(both.collect()) == sorted(one.collect())
    assert model_fanout(df.limit(0), shout, [("p", "r0", "e0")]).count() == 0


def test_checks_are_one_python_step(spark):
    assert python_steps(quality_queries.check_errors(spark, SMOKE)) == 1


def test_candidates_and_judgements_are_steps_apart(spark):
    df = spark.createDataFrame([(i, f"q{i}", "a") for i in range(50)], "id int, question string, answer string")
    judged = augment.preference_sample(df, shout, shout, "{question}#{sample}", "{answer}~{response}", "id", tries=1, pause=0.0)
    assert python_steps(judged) == 1
    assert {len(r.samples) for r in judged.collect()} == {5}


def test_batches_are_small(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, wanted in (("10000", "1000"), ("50", "50"), ("0", "1000")):
            spark.conf.set(name, given)
            model_map(spark.createDataFrame([("x",)], "prompt string"), shout)
            assert spark.conf.get(name) == wanted
    finally:
        spark.conf.set(name, before)
