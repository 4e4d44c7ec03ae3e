"""JSON arrays read by byte ranges: records of any shape, at any border."""

import json
import random

import pytest

from qaloom.sources.json_array import json_array_source, json_array_texts


def records(n, seed=1):
    rng = random.Random(seed)
    odd = ['}', '{', '"', "\\", '\\"', "]", "[", ",", "\n", "a", "é", "文", "}\",{\"", "\\\\", "'"]
    return [{"id": i, "text": "".join(rng.choice(odd) for _ in range(rng.randrange(12))), "tags": [rng.choice(odd) for _ in range(rng.randrange(3))],
             "more": {"deep": {"x": rng.choice(odd)}, "list": [{"y": 1}, {}]} if rng.random() < 0.3 else None} for i in range(n)]


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, "300")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_arrays_in_many_ranges(spark, tmp_path, small_ranges, style):
    want = {}
    for name, n in (("a", 150), ("b", 1), ("c", 0), ("d", 40)):
        rows = records(n, seed=len(name) + n)
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, **style), encoding="utf-8")
        want[f"{name}.json"] = rows
    (tmp_path / "empty.json").write_text("")
    found = json_array_texts(spark, str(tmp_path))
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 20
    got = {}
    for r in found.orderBy("file", "record").collect():
        got.setdefault(r.file.rsplit("/", 1)[-1], []).append(json.loads(r.json))
    assert got == {k: v for k, v in want.items() if v}


def test_typed_records_and_ends_of_files(spark, tmp_path, small_ranges):
    (tmp_path / "x.json").write_text('[1, {"q": "a}b", "n": {"m": [2]}}, "s", {"q": null}, {"q": "cut')
    rows = json_array_source(spark, str(tmp_path), "q string, n struct<m: array<int>>").collect()
    assert sorted((r.q or "", r.n.m if r.n else None) for r in rows) == [("", None), ("a}b", [2])]
