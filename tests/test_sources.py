import os
import tempfile

from pyspark.sql import functions as F

from qaloom.operators.stats import quality_report
from qaloom.sources import files, records, resume
from qaloom.streaming.ingest import incremental_ingest


def folder():
    return tempfile.mkdtemp(prefix="spark-")


def put(root, name, data):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return path


def test_text_source(spark):
    root = folder()
    put(root, "a.txt", "one\ntwo")
    put(root, "sub/b.txt", "半导体")
    put(root, "blank.txt", " \n ")
    put(root, "c.md", "not text")
    got = {(r.source_file, r.content) for r in files.text_source(spark, root).collect()}
    assert got == {("a.txt", "one\ntwo"), ("b.txt", "半导体")}
    both = files.multi_input(spark, [f"{root}/sub", root]).groupBy("input_dir").count().collect()
    assert {r["count"] for r in both} == {1, 2}


def test_decoded_catalog(spark):
    root = folder()
    put(root, "u.txt", "光学 é")
    put(root, "g.TXT", "半导体".encode("gbk"))
    put(root, "bad.md", b"\xff\xfe\x80")
    put(root, "x.pdf", b"%PDF")
    got = {r.file_name: (r.file_type, r.content, r.success, r.error) for r in files.read_text_files(spark, root).collect()}
    assert got == {
        "u.txt": ("text", "光学 é", True, None),
        "g.TXT": ("text", "半导体", True, None),
        "bad.md": ("text", "", False, "empty content"),
    }
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"


def test_records_keep_awkward_text(spark):
    root = folder()
    rows = [(1, 'say "hi", ok\nnext', "半导体"), (2, "back\\slash", None)]
    df = spark.createDataFrame(rows, "id int, question string, answer string")
    records.csv_sink(df, f"{root}/a.csv")
    records.json_sink(df, f"{root}/a.json")
    for path in ("a.csv", "a.json"):
        back = records.records_source(spark, f"{root}/{path}", df.schema, multi_line=False)
        assert sorted(map(tuple, back.collect())) == rows
    text = "".join(open(os.path.join(root, "a.json", f), encoding="utf-8").read() for f in os.listdir(f"{root}/a.json") if f.endswith(".json"))
    assert "半导体" in text
    put(root, "array.json", '[{"id": 7, "question": "q"}, {"id": 8}]')
    assert records.records_source(spark, f"{root}/array.json").count() == 2


def test_nested_cells(spark):
    root = folder()
    df = spark.range(1).select("id", F.struct(F.lit(1).alias("a")).alias("s"), F.array(F.lit("x")).alias("l"))
    records.csv_sink(df, f"{root}/n.csv")
    row = records.records_source(spark, f"{root}/n.csv", "id int, s string, l string").first()
    assert (row.s, row.l) == ('{"a":1}', '["x"]')


def test_flatten(spark):
    schema = "source_file string, question string, qa_pairs array<struct<question string, answer string>>"
    df = spark.createDataFrame([("f", None, [("q1", "a1"), ("q2", "a2")]), (None, None, [("q3", "a3")]), ("g", "plain", None), ("h", None, [])], schema)
    got = {(r.question, r.answer, r.source_file) for r in records.qa_flatten(df).collect()}
    assert got == {("q1", "a1", "f"), ("q2", "a2", "f"), ("q3", "a3", "unknown"), ("plain", None, "g")}


def test_resume(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "source_file string")
    none = df.limit(0)
    assert resume.resume(df, none).count() == 4
    done = spark.createDataFrame([("b",), ("b",), (None,)], "source_file string")
    assert sorted(r.source_file or "" for r in resume.resume(df, done).collect()) == ["", "a"]
    images = spark.createDataFrame([("/x/d1/i.png",), ("/x/d2/i.png",)], "image_path string")
    old = spark.createDataFrame([("old/root/d1/i.png",)], "image_path string")
    assert [r.image_path for r in resume.resume_images(images, old).collect()] == ["/x/d2/i.png"]
    assert resume.merge_history(df, done).count() == 7


def test_batches(spark):
    df = resume.batch_assign(spark.range(10).repartition(3), 4, "id")
    assert sorted((r.batch_id, r.id) for r in df.collect()) == [(i // 4, i) for i in range(10)]
    path = f"{folder()}/b"
    resume.write_batches(df, path)
    assert spark.read.parquet(path).filter("batch_id = 2").count() == 2
    assert [r.id for r in resume.task_limit(spark.range(10), 3, "id").collect()] == [0, 1, 2]


def test_fanout(spark):
    df = spark.createDataFrame([("q", "a", "factual", 1), ("q", "a", None, 0), ("q", "a", None, 2)], "question string, answer string, question_type string, quality_label int")
    out = records.quality_fanout(df, quality_report, f"{folder()}/o")
    assert spark.read.json(out["detailed"]).count() == 3 and spark.read.json(out["high_quality"]).count() == 1
    assert spark.read.csv(out["results"], header=True).count() == 3
    assert spark.read.json(out["report"]).first().total_qa_pairs == 3


def test_domain_sink_appends(spark):
    path = f"{folder()}/d"
    df = spark.createDataFrame([(1, "optics"), (2, "materials")], "id int, domain string")
    records.domain_sink(df, path, "r1")
    records.domain_sink(df.limit(1), path, "r2")
    assert spark.read.json(path).groupBy("domain").count().count() == 2 and spark.read.json(path).count() == 3


def test_each_file_is_ingested_once(spark):
    root = folder()
    put(root, "in/a.txt", "first")
    args = (spark, f"{root}/in", f"{root}/out", f"{root}/log", "value string")
    incremental_ingest(*args, fmt="text", max_files_per_trigger=1, wholetext="true")
    put(root, "in/b.txt", "second")
    put(root, "in/c.txt", "third")
    for _ in range(2):
        incremental_ingest(*args, fmt="text", max_files_per_trigger=1, wholetext="true")
        assert sorted(r.value for r in spark.read.parquet(f"{root}/out").collect()) == ["first", "second", "third"]
