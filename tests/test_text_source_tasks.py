import os
import tempfile

import pytest
from pyspark.sql import functions as F

from qaloom.functions.text import has_text
from qaloom.sources import files

NAMES = ["a.txt", "b c#d%e?f[g]{h}.txt", "größe €.txt", "_hidden.txt", "_a=1.txt", ".dot.txt", "sub/deep/f.txt", "_dir/x.txt", "_d=1/x.txt",
         "lang=a%20b/part-0/1.txt", "d.txt/in.txt", "no.md", "TXT.TXT", "_metadata.txt", "half.txt._COPYING_"]


@pytest.fixture(scope="module")
def folder():
    root = os.path.join(tempfile.mkdtemp(prefix="run-"), "in é%x")
    for name in NAMES:
        os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
        with open(os.path.join(root, name), "wb") as file:
            file.write(f"{name}\r\n".encode())
    for name, content in (("bad.txt", b"ab\xff\xfec\x00d"), ("blank.txt", b" \n"), ("empty.txt", b""), ("bom.txt", b"\xef\xbb\xbfhi")):
        with open(os.path.join(root, name), "wb") as file:
            file.write(content)
    return root


def by_spark(spark, path):
    found = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt").filter(has_text("value"))
    return found.select(F.col("_metadata.file_path"), F.col("_metadata.file_name").alias("source_file"), F.col("value").alias("content"))


def bytes_of(df):
    return sorted(tuple(r) for r in df.select("file_path", "source_file", F.hex(F.col("content").cast("binary"))).collect())


@pytest.mark.parametrize("small", [False, True])
def test_tasks_list_and_read_what_spark_reads(spark, folder, monkeypatch, small):
    if small:
        monkeypatch.setattr(files, "FILES_OF_A_TASK", 2)
        monkeypatch.setattr(files, "NAMES_AT_ONCE", 1)
        monkeypatch.setattr(files, "BYTES_AT_ONCE", 1)
    for path in (folder, [folder, f"{folder}/sub"], [f"{folder}/_dir", f"{folder}/_d=1"]):
        found = files.text_source(spark, path)
        # A scan of the files themselves has every one of them in the driver's memory.
        assert "FileScan text" not in found._jdf.queryExecution().executedPlan().toString()
        assert bytes_of(found) == bytes_of(by_spark(spark, path)) != []


def test_other_paths_are_left_to_spark(spark, folder):
    assert bytes_of(files.text_source(spark, f"{folder}/s*")) == bytes_of(by_spark(spark, f"{folder}/sub"))
    assert files.text_source(spark, f"{folder}/a.txt").count() == 1
    assert files.text_source(spark, folder, "{a,bom}.txt").count() == 2
    empty = tempfile.mkdtemp(prefix="run-")
    assert files.text_source(spark, empty).collect() == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.text_source(spark, f"{folder}/none")
