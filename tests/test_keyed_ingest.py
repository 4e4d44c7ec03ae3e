"""Ingestion by key: deliveries repeated, batches that stop halfway or are not logged, a lost checkpoint."""

import glob
import os
import tempfile

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.sources import files
from qaloom.streaming.ingest import keyed_ingest, read_keyed

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="spark-")


def deliver(root, name, *lines):
    os.makedirs(f"{root}/in", exist_ok=True)
    with open(f"{root}/in/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def run(spark, root, checkpoint="log", **more):
    keyed_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/{checkpoint}", SCHEMA, "k", fmt="csv", max_files_per_trigger=1, **more)


def stored(spark, root):
    found = read_keyed(spark, f"{root}/out", SCHEMA)
    return sorted((r.k if r.k is not None else -1, r.v) for r in found.collect()) if found is not None else []


def test_each_key_once(spark, root):
    assert stored(spark, root) == []
    deliver(root, "a.csv", "1,x", "1,b", "2,y", ",n", ",n")
    run(spark, root)
    assert stored(spark, root) == [(-1, "n"), (-1, "n"), (1, "b"), (2, "y")]
    deliver(root, "b.csv", "2,later", "3,z")
    deliver(root, "c.csv", "3,z", "4,w")
    run(spark, root)
    want = [(-1, "n"), (-1, "n"), (1, "b"), (2, "y"), (3, "z"), (4, "w")]
    assert [r for r in stored(spark, root)] == want
    run(spark, root)
    assert stored(spark, root) == want


def test_lost_checkpoint_and_unlogged_batch(spark, root):
    deliver(root, "a.csv", "1,x", "2,y")
    deliver(root, "b.csv", "3,z")
    run(spark, root)
    last = sorted(f for f in glob.glob(f"{root}/log/commits/*") if not f.endswith(".crc"))[-1]
    os.remove(last)  # written, then stopped before the log had it
    os.remove(os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc"))
    run(spark, root)
    assert stored(spark, root) == [(1, "x"), (2, "y"), (3, "z")]
    deliver(root, "c.csv", "1,x", "4,w")
    run(spark, root, "another")
    assert stored(spark, root) == [(1, "x"), (2, "y"), (3, "z"), (4, "w")]


def test_batch_that_stops_halfway(spark, root):
    deliver(root, "a.csv", "1,x")
    run(spark, root)
    deliver(root, "b.csv", *[f"{k},v" for k in range(2, 200)])
    broken = F.when(F.col("k") == 150, F.raise_error(F.lit("stop"))).otherwise(F.col("v"))
    with pytest.raises(StreamingQueryException):
        run(spark, root, transform=lambda df: df.repartition(8).withColumn("v", broken.cast("string")))
    assert stored(spark, root) == [(1, "x")]
    run(spark, root)
    assert stored(spark, root) == [(1, "x")] + [(k, "v") for k in range(2, 200)]


def test_inputs_below_one_folder(spark, root):
    for place in ("top.txt", "a b+c/x.txt", "lang=de/in/y.txt", "lang=de/z.txt"):
        os.makedirs(os.path.dirname(f"{root}/in/{place}"), exist_ok=True)
        with open(f"{root}/in/{place}", "w") as f:
            f.write(place)
    got = sorted((r.input_dir, r.source_file) for r in files.multi_input(spark, f"{root}/in/").collect())
    assert got == [("a b+c", "x.txt"), ("de", "y.txt"), ("de", "z.txt")]
