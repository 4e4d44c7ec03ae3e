from qaloom.operators import merge
from qaloom.plans.fixtures import knowledge

SMOKE = "/root/testdata/sf0.001"


def test_items_come_from_generators(spark):
    plan = merge.chunk_values(knowledge(spark, SMOKE))._jdf.queryExecution().optimizedPlan().toString()
    assert "flatten(" not in plan and "transform(" not in plan and "posexplode(" in plan
