"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import gc
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# str.translate table: only A-Z change, unlike str.lower.
LOWER_ASCII = str.maketrans(UPPER, UPPER.lower())
# Words of contracts that split on ASCII white space only: space and 0x09-0x0D.
SPACE_WORDS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send at most ``rows`` rows to Python at once, for the rest of the session.

    Whole texts make large batches: the default of 10,000 rows holds tens of megabytes several times
    over, in the executor and in each of its Python workers.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def held_out(doc_id: Column | str, folds: int) -> Column:
    """True for rows of fold 0: crc32 of the id as text, modulo ``folds``. A null id is never held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % folds == 0, F.lit(False))


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 8192) -> Iterator[pa.RecordBatch]:
    """Row tuples as Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def kept(name: str, make: Callable[[], object]) -> object:
    """What ``make`` gives at the first call in a process; the same object ever after.

    Modules of this package travel to tasks by value and are new in each of them, so the object hangs on a
    module of the process. For what is dear to load and of a fixed size.
    """
    holder = sys.modules.setdefault("_qaloom_kept", types.ModuleType("_qaloom_kept")).__dict__
    if name not in holder:
        holder[name] = make()
    return holder[name]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def flat_ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + size), one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def release_memory() -> None:
    """Give back what this process holds but no longer uses; workers live on for other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def released(step: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``step`` of mapInArrow, after which the worker gives its free memory back."""

    @functools.wraps(step)
    def run(parts):
        try:
            yield from step(parts)
        finally:
            release_memory()

    return run
