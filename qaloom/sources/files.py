"""Text and binary file sources."""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from contextlib import contextmanager
from fnmatch import fnmatchcase
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.functions.text import base_name, decode_text, file_type, has_text
from qaloom.session import new_scratch_path

# How the content of each kind of file was obtained.
EXTRACTION_METHODS = {"pdf": "pdf_extraction", "text": "direct_read"}


# Files and bytes one task reads, names and bytes sent on at once.
FILES_OF_A_TASK = 10_000
BYTES_OF_A_TASK = 128 * 1024 * 1024
NAMES_AT_ONCE = 10_000
BYTES_AT_ONCE = 8 * 1024 * 1024


def text_source(spark: SparkSession, path: str | list[str], glob: str = "*.txt") -> DataFrame:
    """One row per text file below ``path``; blank files are dropped.

    Tasks list the folders and read the files where these are in a file system that they have mounted, so the driver
    holds no list, however many files there are. Elsewhere, and for paths or ``glob`` with more than ``*`` and ``?`` in
    the file's name, Spark's reader does both; it keeps every file's name and place on the driver.
    """
    roots = _mounted(spark, [path] if isinstance(path, str) else path)
    if roots and re.fullmatch(r"[\w*?. -]*\.txt", glob):
        return _read_files(_list_files(spark, roots, glob)).filter(has_text("content"))
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    return files.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("value").alias("content"),
    ).filter(has_text("content"))


def _mounted(spark: SparkSession, paths: list[str]) -> list[str] | None:
    """``paths`` as folders of the mounted file system, if all of them are, exist and hold no pattern."""
    roots = []
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        uri = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(place).toUri()
        root = uri.getPath()
        if uri.getScheme() != "file" or re.search(r"[{}\[\]*?\\]", root) or not os.path.isdir(root):
            return None
        roots.append(root)
    return roots


def _list_files(spark: SparkSession, roots: list[str], glob: str) -> DataFrame:
    """``path, size`` of the files below ``roots`` whose names match ``glob``, as Spark's reader chooses them.

    Folders are listed level by level by tasks; a level is written before the next, so only its number of folders is known here.
    """

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(paths: list, sizes: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "size"])

        paths, sizes = [], []
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                with os.scandir(folder) as entries:
                    for entry in entries:
                        name = entry.name
                        hidden = name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")
                        if not name.isascii() and re.search("[\ud800-\udfff]", name):  # no name Spark can open
                            continue
                        if entry.is_dir():
                            if hidden and not name.startswith(("_metadata", "_common_metadata")):
                                continue
                            size = None
                        elif not hidden and fnmatchcase(name, glob) and entry.is_file():
                            size = entry.stat().st_size
                        else:
                            continue
                        paths.append(entry.path)
                        sizes.append(size)
                        if len(paths) >= NAMES_AT_ONCE:
                            yield rows(paths, sizes)
                            paths, sizes = [], []
        yield rows(paths, sizes)

    found, depth = new_scratch_path(spark, "files"), 0
    folders = spark.createDataFrame([(r,) for r in dict.fromkeys(roots)], "path string")
    while True:
        folders.select("path").mapInArrow(listing, "path string, size bigint").write.parquet(f"{found}/{depth}")
        level = spark.read.schema("path string, size bigint").parquet(f"{found}/{depth}")
        folders = level.filter("size IS NULL")
        n = folders.count()
        if not n:
            break
        folders = folders.repartition(min(n, max(spark.sparkContext.defaultParallelism, n // 1000)))
        depth += 1
    files = spark.read.schema("path string, size bigint").option("recursiveFileLookup", True).parquet(found).filter("size IS NOT NULL")
    return files.distinct() if len(roots) > 1 else files


def _read_files(listed: DataFrame) -> DataFrame:
    """``file_path, source_file, content`` of the files ``path, size``, names as Spark's reader writes them."""
    seen = listed.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    tasks = max(min(seen["n"], listed.sparkSession.sparkContext.defaultParallelism), -(-seen["n"] // FILES_OF_A_TASK), -(-seen["bytes"] // BYTES_OF_A_TASK), 1)

    def encoded(c: str) -> str:
        other = ord(c) > 127 and unicodedata.category(c)[0] != "Z" and unicodedata.category(c) != "Cc"
        return c if other else "".join(f"%{b:02X}" for b in c.encode())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(paths: list, contents: list) -> pa.RecordBatch:
            shown = [re.sub(r"[^A-Za-z0-9_.!~'()*,;:$&+=@/-]", lambda m: encoded(m.group()), p) for p in paths]
            return pa.RecordBatch.from_arrays(
                [pa.array(["file:" + p for p in shown], pa.string()), pa.array([p.rsplit("/", 1)[-1] for p in shown], pa.string()),
                 pa.array(contents, pa.binary())], names=["file_path", "source_file", "content"])

        for batch in batches:
            paths, contents, held = [], [], 0
            for path in batch.column(0).to_pylist():
                with open(path, "rb") as file:
                    contents.append(file.read())
                paths.append(path)
                held += len(contents[-1])
                if held >= BYTES_AT_ONCE:
                    yield rows(paths, contents)
                    paths, contents, held = [], [], 0
            yield rows(paths, contents)

    read_files = listed.select("path").repartition(tasks).mapInArrow(read, "file_path string, source_file string, content binary")
    return read_files.withColumn("content", F.col("content").cast("string"))


# Characters Spark writes as %XX in the name of a partition folder.
_ESCAPED = {chr(c) for c in range(32)} | set("\"#%'*/:=?\\\x7f{[]^")


def text_sink(df: DataFrame, path: str, text: str, by: str) -> None:
    """Every row's ``text`` and a line end as a file of its own below ``path``, in the folder ``by=value``.

    Tasks write their files themselves where ``path`` is in a file system that they have mounted: Spark's writer
    commits each file through Hadoop, which starts a process to set its mode. A file is named by its task and place
    there, so a repeated task replaces its own. Elsewhere Spark's writer makes the files.
    """
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(place).toUri()
    if uri.getScheme() != "file":
        df.select(text, by).write.option("maxRecordsPerFile", 1).partitionBy(by).text(path)
        return
    root = uri.getPath()

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, made = TaskContext.get().partitionId(), 0, {}
        for part in parts:
            for content, value in zip(part.column(0), part.column(1).to_pylist()):
                if value not in made:
                    name = "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value or "__HIVE_DEFAULT_PARTITION__")
                    made[value] = os.path.join(root, f"{by}={name}", f"part-{task:05d}")
                    os.makedirs(made[value], exist_ok=True)
                with open(os.path.join(made[value], f"{number:08d}.txt"), "wb") as file:
                    file.write((content.as_py() or b"") + b"\n")
                number += 1
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64())], names=["files"])

    os.makedirs(root, exist_ok=True)
    df.select(F.col(text).cast("binary"), F.col(by).cast("string")).mapInArrow(write, "files long").agg(F.sum("files")).first()


def multi_input(spark: SparkSession, dirs: dict[str, str] | list[str] | str, glob: str = "*.txt") -> DataFrame:
    """The same text source over several directories, each row labelled with its own.

    Given one parent folder, every folder directly below it is an input, labelled by its name (``b`` for
    ``a=b``): one scan, however many there are. Files that lie in the parent itself belong to none.
    """
    if isinstance(dirs, str):
        parent = spark._jvm.org.apache.hadoop.fs.Path(dirs)
        parent = parent.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(parent).toUri().getRawPath()
        below = F.get(F.split("file_path", rf"\Q{parent}/\E", 2), F.lit(1))
        folder = F.when(F.contains(below, F.lit("/")), F.substring_index(below, "/", 1))
        label = F.url_decode(F.replace(F.substring_index(folder, "=", -1), F.lit("+"), F.lit("%2B")))
        return text_source(spark, dirs, glob).withColumn("input_dir", label).filter("input_dir IS NOT NULL")
    labelled = dirs if isinstance(dirs, dict) else {d.rstrip("/").rsplit("/", 1)[-1]: d for d in dirs}
    if len(labelled) != len(dirs):
        raise ValueError("two input directories share a label")
    frames = [
        text_source(spark, path, glob).withColumn("input_dir", F.lit(label))
        for label, path in labelled.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def binary_source(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .select(F.col("path").alias("file_path"), "length", F.col("content").alias("raw"))
    )


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """Text files decoded as UTF-8 or GBK, in the catalog's shape."""
    raw = binary_source(spark, path).filter(file_type("file_path") == "text")
    with java_charsets(spark):
        return file_catalog(raw.select("file_path", decode_text("raw").alias("content")))


def file_catalog(df: DataFrame) -> DataFrame:
    """Classify files (``file_path``, ``content``) and mark which of them can be used.

    Unknown types and blank contents are failures with an error text, and stay as rows.
    """
    kind = file_type("file_path")
    known = kind != "unknown"
    text = F.when(known, F.coalesce("content", F.lit(""))).otherwise(F.lit(""))
    filled = has_text(text)
    error = F.when(~known, F.concat(F.lit("unsupported file type: "), kind)).when(
        ~filled, "empty content"
    )
    return df.select(
        "file_path",
        base_name("file_path").alias("file_name"),
        kind.alias("file_type"),
        text.alias("content"),
        (known & filled).alias("success"),
        error.alias("error"),
    )


def retrieval_input(catalog: DataFrame) -> DataFrame:
    """Usable files in the retrieval shape, with a metadata struct naming how they were read."""
    method = F.create_map(*[F.lit(x) for pair in EXTRACTION_METHODS.items() for x in pair])
    return catalog.filter("success").select(
        F.col("file_name").alias("source_file"),
        "file_type",
        "content",
        F.struct("file_path", method[F.col("file_type")].alias("extraction_method")).alias("metadata"),
    )


@contextmanager
def java_charsets(spark: SparkSession):
    """Allow GBK and lenient decoding for plans built inside the block.

    Spark fixes both settings when an expression is analysed, so they are restored afterwards.
    """
    names = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "true")
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
