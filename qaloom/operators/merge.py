"""Put the replies of one source's chunks together again.

Long forms hold a row per piece, so a source may be of any size: ``chunk_texts`` (pieces with their
place in the merged text), ``chunk_values`` (distinct values with their first place) and ``chunk_items`` (all items in
order). ``merge_chunk_text`` and ``merge_chunk_knowledge`` have one row per source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from qaloom.session import checked_broadcast, materialize, positions, small_batches

PAIR = "question string, answer string, question_type string, difficulty string, reasoning string"
KNOWLEDGE_LISTS = ("key_concepts", "materials", "parameters", "methods")
_PATHS = ("key_concepts", "technical_details.materials", "technical_details.parameters", "technical_details.methods")

_POSITION_BITS = 32
# Stands between values that travel as one text; those that hold it travel as a list.
_BETWEEN = "\0"


def _chunk_pieces(df: DataFrame) -> DataFrame:
    return df.filter("source_file IS NOT NULL").select(
        "source_file",
        F.coalesce("chunk_index", F.lit(0)).alias("chunk_index"),
        F.coalesce("content", F.lit("")).alias("content"),
        F.coalesce("text_content", F.lit("")).alias("text_content"),
    )


def chunk_texts(df: DataFrame) -> DataFrame:
    """``source_file, chunk_index, content, content_at, text_content, text_at``: the pieces of ``merge_chunk_text``.

    ``content_at`` and ``text_at`` are the characters before the piece in the source's merged content and
    text, separators counted, so any stretch of a merged text is found by range without
    building it. Rows are never gathered by source; pieces of one chunk_index stand in the order of their texts.
    """
    return positions(
        _chunk_pieces(df), "source_file", "chunk_index", "content", "text_content",
        content_at=F.char_length("content") + 2, text_at=F.char_length("text_content") + 1,
    )


def merge_chunk_text(df: DataFrame) -> DataFrame:
    """Per source: reply contents joined by a blank line, texts by a newline, in chunk order."""
    return _chunk_pieces(df).groupBy("source_file").agg(
        F.expr("listagg(content, '\n\n') WITHIN GROUP (ORDER BY chunk_index)").alias("content"),
        F.expr("listagg(text_content, '\n') WITHIN GROUP (ORDER BY chunk_index)").alias("full_text"),
    )


def _list(col: str) -> Column:
    return F.coalesce(F.col(col), F.array())


def _chunked() -> Column:
    return F.coalesce(F.col("chunk_index").isNotNull() & (F.col("total_chunks") > 1), F.lit(False))


def chunk_values(df: DataFrame) -> DataFrame:
    """``source_file, list, value, position``: each distinct list value of a multi-chunk source once.

    ``position`` orders values by first occurrence. Values are reduced where they are before the
    shuffle, so neither a long source nor a repeated value makes a large group. Lists go by number until they
    are named at the end, and items are made by generators, not by functions on arrays.
    """
    lists = F.array(*[_list(path) for path in _PATHS])
    items = (
        df.filter(_chunked())
        .select("source_file", "chunk_index", F.posexplode(lists).alias("_list", "_values"))
        .select("source_file", "_list", "chunk_index", F.posexplode("_values").alias("_i", "value"))
    )
    found = items.groupBy("source_file", "_list", "value").agg(F.min(_place(F.col("_i"))).alias("position"))
    names = F.array(*[F.lit(n) for n in KNOWLEDGE_LISTS])
    return found.select("source_file", F.get(names, F.col("_list")).alias("list"), "value", "position")


def _place(i: Column) -> Column:
    return F.shiftleft(F.coalesce("chunk_index", F.lit(0)).cast("bigint"), _POSITION_BITS) + i


def chunk_items(df: DataFrame, col: str) -> DataFrame:
    """``source_file, position, value``: every item of the array ``col`` of multi-chunk sources, in chunk order by ``position``."""
    return df.filter(_chunked()).select("source_file", "chunk_index", F.posexplode(col).alias("_i", "value")).select(
        "source_file", _place(F.col("_i")).alias("position"), "value")


def _reduced(df: DataFrame) -> DataFrame:
    """Multi-chunk records, reduced where they are: a row per source of every batch, nothing is shuffled.

    Of each of the four lists a batch's distinct values stay, each with the chunk and the place where it is first:
    ``X_chunk, X_place`` and ``X_joined``, the values one after another, or ``X`` where they cannot be told apart
    so. ``items`` are the other lists of each record, side by side.
    """
    pairs = df.schema["qa_pairs"].dataType
    item = F.struct(
        F.col("chunk_index").cast("bigint").alias("chunk"), F.coalesce("qa_pairs", F.array().cast(pairs)).alias("qa_pairs"),
        _list("main_findings").cast("array<string>").alias("main_findings"),
    )
    records = df.filter(_chunked()).select(
        "source_file", F.col("chunk_index").cast("bigint").alias("chunk_index"), item.alias("items"),
        *[_list(path).cast("array<string>").alias(name) for name, path in zip(KNOWLEDGE_LISTS, _PATHS)],
    )
    schema = StructType([df.schema["source_file"]]).add("items", ArrayType(records.schema["items"].dataType))
    for name in KNOWLEDGE_LISTS:
        schema.add(f"{name}_chunk", ArrayType(LongType())).add(f"{name}_place", ArrayType(IntegerType()))
        schema.add(f"{name}_joined", StringType()).add(name, ArrayType(StringType()))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = batch.column(0).dictionary_encode(null_encoding="encode")
            source, chunk, n = sources.indices.to_numpy().astype(np.int64), batch.column(1).to_numpy(), len(sources.dictionary)

            def offsets(owner: np.ndarray) -> pa.Array:
                return pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]), pa.int32())

            order = np.lexsort((chunk, source))
            columns = [sources.dictionary, pa.ListArray.from_arrays(offsets(source), batch.column(2).take(pa.array(order)))]
            for column in batch.columns[3:]:
                row, values = pc.list_parent_indices(column).to_numpy(), pc.list_flatten(column)
                place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
                of, owner = chunk[row], source[row]
                found = values.dictionary_encode(null_encoding="encode")
                key = owner * (len(found.dictionary) + 1) + found.indices.to_numpy()
                order = np.lexsort((place, of, key))
                keep = order[np.flatnonzero(np.diff(key[order], prepend=-1))]
                keep = keep[np.lexsort((place[keep], of[keep], owner[keep]))]
                ends, kept = offsets(owner[keep]), values.take(pa.array(keep))
                lists = pa.ListArray.from_arrays(ends, kept)
                apart = np.ones(n, bool)
                apart[owner[keep][pc.fill_null(pc.match_substring(kept, _BETWEEN), True).to_numpy(zero_copy_only=False)]] = False
                joined = pa.array(apart & (np.diff(ends.to_numpy()) > 0))
                none, empty = pa.scalar(None, pa.string()), pa.scalar([], lists.type)
                columns += [
                    pa.ListArray.from_arrays(ends, pa.array(of[keep])), pa.ListArray.from_arrays(ends, pa.array(place[keep], pa.int32())),
                    pc.if_else(joined, pc.binary_join(lists, _BETWEEN), none), pc.if_else(joined, empty, lists),
                ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    small_batches(df.sparkSession)
    return records.mapInArrow(reduce, schema)


def _in_order(placed: Column) -> Column:
    """Of structs of chunk, place and value the values, by chunk and place."""
    return F.transform(F.sort_array(placed), lambda x: x["value"])


def merge_chunk_knowledge(df: DataFrame) -> DataFrame:
    """Merge knowledge records of multi-chunk sources; single-chunk records pass through.

    QA pairs and findings are concatenated in chunk order; concepts, materials, parameters and
    methods are too and keep their first occurrence. Records that pass through are not shuffled
    and keep their further columns (chunk position, text), which are NULL on merged rows.

    Records are read once and reduced where they are; the shuffle has one row per source and batch, with
    the four lists' distinct values. Items of equal chunk_index stand by their place in the record.
    """
    known = ("source_file", "qa_pairs", "key_concepts", "technical_details", "main_findings")
    others = [c for c in df.columns if c not in known]
    pairs = df.schema["qa_pairs"].dataType
    single = df.filter(~_chunked()).select(
        "source_file",
        F.coalesce("qa_pairs", F.array().cast(pairs)).alias("qa_pairs"),
        *[_list(path).alias(name) for name, path in zip(KNOWLEDGE_LISTS, _PATHS)],
        _list("main_findings").alias("main_findings"),
        *others,
    )
    parts = _reduced(df)
    held = F.collect_list(F.struct(*[c for c in parts.columns if c != "source_file"])).alias("_parts")

    def items(name: str) -> Column:
        placed = F.transform("_items", lambda x: F.transform(x[name], lambda value, i: F.struct(x["chunk"].alias("chunk"), i.alias("place"), value.alias("value"))))
        return _in_order(F.flatten(placed)).alias(name)

    def values(name: str) -> Column:
        placed = F.transform("_parts", lambda p: F.arrays_zip(
            p[f"{name}_chunk"].alias("chunk"), p[f"{name}_place"].alias("place"),
            F.coalesce(F.split(p[f"{name}_joined"], _BETWEEN), p[name]).alias("value")))
        return F.array_distinct(_in_order(F.flatten(placed))).alias(name)

    merged = parts.repartition("source_file").groupBy("source_file").agg(held).withColumn("_items", F.flatten("_parts.items")).select(
        "source_file", *[items(name) for name in ("qa_pairs", "main_findings")], *[values(name) for name in KNOWLEDGE_LISTS])
    return single.unionByName(merged, allowMissingColumns=True).select(
        "source_file",
        "qa_pairs",
        "key_concepts",
        F.struct("materials", "parameters", "methods").alias("technical_details"),
        "main_findings",
        *others,
    )


def dedup_records(df: DataFrame, keys: list[str], keep: str, fold: bool = False) -> DataFrame:
    """Of records equal in ``keys`` keep the one with the lowest ``keep`` (unique, orderable).

    Records meet by the SHA-256 of their keys: only digests and ``keep`` are shuffled, each group
    reduced to its minimum first, so one holding a third of all rows costs no more than any
    other. The records that go, usually few, are then taken out by an anti join, which sends them to
    the records while they are small by measure. ``fold`` compares texts without case,
    punctuation and spacing, which also catches re-worded copies of that degree.
    """

    def part(name: str) -> Column:
        text = F.col(name).cast("string")
        if fold:
            text = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "")
        # Lengths keep neighbouring fields apart, and NULL differs from ''.
        return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    digest = F.sha2(F.concat(*[part(k) for k in keys]), 256)
    # Written: the digests are used twice, and folding texts is the expensive part.
    slim = materialize(df.select(digest.alias("_key"), F.col(keep).alias("_keep")), "digests")
    repeated = slim.groupBy("_key").agg(F.min("_keep").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    gone = slim.join(repeated.select("_key", "_first"), "_key").filter("_keep <> _first").select("_keep")
    return df.join(checked_broadcast(gone), F.col(keep) == F.col("_keep"), "left_anti")
