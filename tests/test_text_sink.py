import os

from pyspark.sql import functions as F

from qaloom.session import new_scratch_path
from qaloom.sources import files

ROWS = [("one\ntwo", "en"), ("drei", "de"), ("drei", "de"), ("", "en"), (None, "en"), ("größe", "a b"), ("x", "x:y"), ("y", None), ("z", "")]


def labelled(spark, path):
    found = files.multi_input(spark, path)
    return sorted((r.input_dir, r.content) for r in found.select("input_dir", "content").collect())


def test_rows_become_files_without_a_commit_each(spark):
    path = new_scratch_path(spark, "texts")
    df = spark.createDataFrame(ROWS, "text string, lang string").repartition(3)
    files.text_sink(df, path, "text", "lang")
    made = [f for _, _, names in os.walk(path) for f in names]
    assert len(made) == len(ROWS) and all(f.endswith(".txt") for f in made)
    found = files.text_source(spark, path)
    assert sorted(r.content for r in found.collect()) == sorted(t + "\n" for t, _ in ROWS if t)


def test_folders_are_those_of_the_partitioned_writer(spark):
    ours, theirs = new_scratch_path(spark, "texts"), new_scratch_path(spark, "texts")
    df = spark.createDataFrame(ROWS, "text string, lang string")
    files.text_sink(df, ours, "text", "lang")
    df.select(F.coalesce("text", F.lit("")).alias("text"), "lang").write.option("maxRecordsPerFile", 1).partitionBy("lang").text(theirs)
    assert {d for d in os.listdir(ours)} == {d for d in os.listdir(theirs) if d.startswith("lang=")}
    assert labelled(spark, ours) == labelled(spark, theirs)
