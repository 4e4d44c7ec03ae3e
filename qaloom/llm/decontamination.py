"""Benchmark decontamination with a distributed positional inverted index. DataFrame functions only.

Postings of the training tokens (document key, position, term) are stored as Parquet, one pass over the
texts. A phrase is found by intersecting offset-adjusted lists: the list of its rarest term first, then the
next rarest, and the remaining terms only in documents where those two met.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaloom.llm.common import UPPER, free_name
from qaloom.session import checked_broadcast, materialize

# Everything between words, once A-Z are lower-cased: ASCII other than digits and a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Stands behind a document's last word; no word can equal it, since words hold no capitals A-Z.
END = "Z"
# Document keys that are sent to the postings at most; beyond that postings are shuffled by key.
MOST_KEYS = 2_000_000


def words_of(text: Column) -> Column:
    """Words in order; a null text has none. Only A-Z are lower-cased."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lower, BETWEEN), "")


@dataclass
class Index:
    """``postings``: ``key, position, term`` of every training token whose term the test set uses.
    ``documents``: ``key, <id>, n_words``, a row for each training row."""

    postings: DataFrame
    documents: DataFrame


def build_index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Store postings of ``docs`` for the words in ``terms`` (column ``word``).

    Other words cannot take part in a match, so they are dropped before anything is written;
    nothing is shuffled. Rows with the same id and text share a key and their results.
    """
    wanted = terms.select("word").union(terms.sparkSession.range(1).select(F.lit(END).alias("word"))).distinct()
    wanted = checked_broadcast(wanted.withColumn("term", F.xxhash64("word")))
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    tokens = docs.select(F.col(id_col), key.alias("key"), F.posexplode(F.array_append(words_of(F.col(text_col)), END)).alias("position", "word"))
    stored = materialize(tokens.join(wanted, "word").select("key", id_col, "position", "term"), "postings")
    end = F.col("term") == F.xxhash64(F.lit(END))
    return Index(stored.where(~end).select("key", "position", "term"),
                 stored.where(end).select("key", id_col, F.col("position").cast("long").alias("n_words")))


def windows_of(items: DataFrame, size: int = 10, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Windows of ``size`` words: ``(window, words)`` and ``(window, item)``.

    An item of fewer words is one window; an item without words has none. Equal windows are one.
    """
    words = items.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    cut = words.withColumn("start", F.explode(starts)).select(
        "item", F.slice("words", F.col("start") + 1, F.least(F.size("words"), F.lit(size))).alias("words"))
    cut = cut.withColumn("window", F.md5(F.array_join("words", " ")))
    return (cut.groupBy("window").agg(F.first("words").alias("words")),
            cut.select("window", "item").where("item IS NOT NULL").distinct())


def ranked_terms(index: Index, windows: DataFrame, lacking: bool = False) -> DataFrame:
    """``window, size, offset, term, rank``: rank 1 is the term with the shortest list. Windows with a
    term that the corpus lacks are left out, unless ``lacking``: such terms then rank first."""
    lengths = index.postings.groupBy("term").agg(F.count("*").alias("length"))
    terms = windows.select("window", F.size("words").alias("size"), F.posexplode("words").alias("offset", "word"))
    terms = terms.withColumn("term", F.xxhash64("word")).drop("word").join(lengths, "term", "left")
    per_window = Window.partitionBy("window")
    if not lacking:
        terms = terms.withColumn("_least", F.min(F.coalesce("length", F.lit(0))).over(per_window)).where("_least > 0")
    order = per_window.orderBy("length", "offset")
    return terms.withColumn("rank", F.row_number().over(order)).select("window", "size", "offset", "term", "rank")


def adjusted(index: Index, terms: DataFrame) -> DataFrame:
    """Lists of the given terms moved back by their offsets: ``window, size, key, start``."""
    found = index.postings.join(checked_broadcast(terms), "term")
    return found.select("window", "size", "key", (F.col("position") - F.col("offset")).alias("start")).where("start >= 0").distinct()


def in_documents(index: Index, found: DataFrame) -> DataFrame:
    """Postings of the documents in ``found``; their keys travel to the postings while few by measure."""
    keys = materialize(found.select("key").distinct(), "keys")
    return index.postings.join(checked_broadcast(keys, max_rows=MOST_KEYS), "key", "left_semi")


def phrases(index: Index, windows: DataFrame) -> DataFrame:
    """Exact occurrences of every window: ``window, size, key, start``."""
    terms = materialize(ranked_terms(index, windows), "terms")
    place = ["window", "size", "key", "start"]
    rarest = adjusted(index, terms.where("rank = 1"))
    both = rarest.where("size > 1").join(adjusted(index, terms.where("rank = 2")), place)
    met = materialize(both.unionByName(rarest.where("size = 1")), "met")
    rest = met.where("size > 2").join(checked_broadcast(terms.where("rank > 2").select("window", "offset", "term")), "window")
    rest = rest.withColumn("position", F.col("start") + F.col("offset"))
    near = in_documents(index, met)
    whole = (rest.join(near, ["key", "position", "term"]).select(*place, "offset").distinct()
             .groupBy(*place).agg(F.count("*").alias("n")).where("n = size - 2").select(*place))
    return whole.unionByName(met.where("size <= 2"))


def proximity_matches(index: Index, windows: DataFrame, slop: int = 2, share: float = 0.8) -> DataFrame:
    """Places where at least ``share`` of a window's terms stand within ``slop`` words of where the
    phrase has them, one of them in its place: ``window, size, key, start, matched``.

    The others may be missing, from the corpus too. ``start`` is negative where a document begins inside
    the phrase. Of the rarest terms, one more than may be missing are looked up: each such place has one
    of them within ``slop``.
    """
    terms = materialize(ranked_terms(index, windows, lacking=True), "terms")
    need = F.ceil(F.col("size") * F.lit(share))
    shift = F.explode(F.sequence(F.lit(-slop), F.lit(slop))).alias("shift")
    rare = terms.where(F.col("rank") <= F.col("size") - need + 1).select("window", "size", "offset", "term")
    found = index.postings.join(checked_broadcast(rare), "term").select("*", shift)
    place = ["window", "size", "key", "start"]
    seeds = materialize(found.withColumn("start", F.col("position") - F.col("offset") - F.col("shift")).select(*place).distinct(), "seeds")
    rest = seeds.join(checked_broadcast(terms.select("window", "offset", "term")), "window").select("*", shift)
    rest = rest.withColumn("position", F.col("start") + F.col("offset") + F.col("shift"))
    near = in_documents(index, seeds)
    held = rest.join(near, ["key", "position", "term"]).groupBy(*place, "offset").agg(F.min(F.abs("shift")).alias("_off"))
    counted = held.groupBy(*place).agg(F.count("*").alias("matched"), F.min("_off").alias("_off"))
    return counted.where((F.col("matched") >= need) & (F.col("_off") == 0)).drop("_off")


def hit_spans(found: DataFrame) -> DataFrame:
    """Maximal runs of hit words: ``key, start, end`` (exclusive), from phrase occurrences."""
    w = Window.partitionBy("key").orderBy("start", "_end")
    runs = found.select("key", "start", (F.col("start") + F.col("size")).alias("_end")).distinct()
    new = F.col("start") > F.coalesce(F.max("_end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    return (runs.withColumn("_run", F.sum(new.cast("int")).over(w)).groupBy("key", "_run")
            .agg(F.min("start").alias("start"), F.max("_end").alias("end")).drop("_run"))


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each row of ``docs``: ``<id>, key, n_words, n_hit, n_items, items`` (ids as sorted strings).

    A word is hit if it lies in an occurrence of a window. Null or empty texts and items have no
    words. Items without an id mark words but are not listed. Other columns are dropped;
    repeated rows get equal results.
    """
    windows, owners = windows_of(items, size, item_id, item_text)
    windows, owners = materialize(windows, "windows"), materialize(owners, "owners")
    index = build_index(docs, windows.select(F.explode("words").alias("word")), id_col, text_col)
    found = materialize(phrases(index, windows), "phrases")
    words = (hit_spans(found).groupBy("key").agg(F.sum(F.col("end") - F.col("start")).cast("long").alias("n_hit")))
    owned = (found.select("key", "window").distinct().join(checked_broadcast(owners), "window")
             .select("key", F.col("item").cast("string").alias("item")).distinct()
             .groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items")))
    hits = words.join(owned, "key", "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return index.documents.join(hits, "key", "left").select(
        id_col, "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"), listed.alias("items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a window of any item; other columns pass through."""
    found = contamination(docs, items, size, id_col, text_col)
    name = free_name(docs, "row_key")
    gone = materialize(found.where("n_hit > 0").select(F.col("key").alias(name)).distinct(), "contaminated")
    keyed = docs.withColumn(name, F.xxhash64(id_col, text_col))
    return keyed.join(checked_broadcast(gone), name, "left_anti").select(docs.columns)
