"""The filter before the exact anti join: same rows, few of them shuffled, false positives still checked."""

import pytest
from pyspark.sql import functions as F

from qaloom.sources import resume


@pytest.fixture(scope="module")
def tables(spark):
    rows = spark.range(0, 20000).select(F.concat(F.lit("f"), "id").alias("source_file"), F.col("id").alias("n"), F.lit(1).alias("key"))
    rows = rows.unionByName(spark.createDataFrame([(None, -1, 1), ("f7", -2, 1), ("f19999", -3, 1)], "source_file string, n long, key int")).repartition(6)
    history = spark.range(0, 5000).select(F.concat(F.lit("f"), F.col("id") % 2500).alias("source_file")).union(
        spark.createDataFrame([(None,), ("f7",)], "source_file string"))
    return rows, history


def test_same_rows_as_the_plain_join(tables):
    rows, history = tables
    plain, filtered = (sorted(map(tuple, resume.resume(rows, history, bloom=b).collect()), key=repr) for b in (False, True))
    assert plain == filtered and len(plain) == 20003 - 2501
    assert resume.resume(rows, history, bloom=True).columns == rows.columns
    assert resume.resume(rows, history.limit(0), bloom=True).count() == 20003
    assert resume.resume(rows.limit(0), history, bloom=True).count() == 0


def test_new_rows_are_ruled_out_by_the_filter(tables):
    rows, history = tables
    done = history.filter("source_file IS NOT NULL").distinct()
    bits = 1 << 15
    filters = resume.bloom_filter(done, "source_file", bits).cache()
    assert filters.count() == 1
    probed = resume.maybe_seen(rows, "source_file", filters, bits, "may").cache()
    known = probed.join(done, "source_file", "left_semi")
    assert known.filter("NOT may").count() == 0
    new = probed.join(done, "source_file", "left_anti")
    assert 0 < new.filter("may").count() < 0.05 * new.count()
    plan = resume.resume(rows, history, bloom=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_bitmap0") and "LeftAnti" in plan


def test_a_full_filter_is_still_exact(tables, monkeypatch):
    monkeypatch.setattr(resume, "MOST_BITS", 1 << 10)
    monkeypatch.setattr(resume, "BITMAP_BITS", 1 << 10)
    rows, history = tables
    assert resume.resume(rows, history, bloom=True).count() == 20003 - 2501
