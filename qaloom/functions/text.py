"""Text and path expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The mention patterns a figure reference can take.
FIGURE_PATTERNS = [
    r"[Ff]igure\s+\d+",
    r"[Ff]ig\.?\s+\d+",
    r"图\s*\d+",
    r"图片\s*\d+",
    r"Figure\s+[A-Za-z]\d*",
    r"Fig\s+[A-Za-z]\d*",
]


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def has_text(col: str | Column) -> Column:
    """Whether anything but white space is there (ideographic and no-break spaces are space)."""
    return as_col(col).rlike(r"(?U)\S")


def strip(col: str | Column) -> Column:
    return F.regexp_replace(as_col(col), r"(?U)^\s+|\s+$", "")


def preview(col: str | Column, n: int = 500) -> Column:
    """The first ``n`` characters, with an ellipsis only if something was cut off."""
    c = as_col(col)
    return F.when(F.char_length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def normalize_text(col: str | Column) -> Column:
    """Collapse runs of blanks and of empty lines, keep the line structure, trim both ends."""
    c = F.regexp_replace(as_col(col), r"[ \t]+", " ")
    c = F.regexp_replace(c, r" ?\n ?", "\n")
    c = F.regexp_replace(c, r"\n{3,}", "\n\n")
    return F.regexp_replace(c, r"^[ \n]+|[ \n]+$", "")


def figure_refs(col: str | Column) -> Column:
    """Distinct figure mentions, sorted. Spaces and digits count in any script."""
    c = as_col(col)
    found = [F.regexp_extract_all(c, F.lit("(?U)" + p), F.lit(0)) for p in FIGURE_PATTERNS]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*found))))


def path_tail(col: str | Column, n: int) -> Column:
    """The last ``n`` segments of a slash path (all of them when it is shorter)."""
    parts = F.split(as_col(col), "/")
    keep = F.least(F.lit(n), F.size(parts))
    return F.concat_ws("/", F.slice(parts, -keep, keep))


def base_name(col: str | Column) -> Column:
    return F.substring_index(as_col(col), "/", -1)


def image_rel_path(col: str | Column) -> Column:
    return F.concat(F.lit("./"), path_tail(col, 3))


def suffix(col: str | Column) -> Column:
    """Lower-cased extension with its dot, '' when the file name has none."""
    return F.lower(F.regexp_extract(base_name(col), r"^.+(\.[^.]+)$", 1))


def file_type(col: str | Column) -> Column:
    """pdf, text or unknown, from the file suffix."""
    ext = suffix(col)
    return (
        F.when(ext == ".pdf", "pdf").when(ext.isin(".txt", ".text", ".md"), "text").otherwise("unknown")
    )


def data_uri(path: str | Column, content: str | Column) -> Column:
    ext = F.lower(F.substring_index(as_col(path), ".", -1))
    encoded = F.translate(F.base64(as_col(content)), "\r\n", "")
    return F.concat(F.lit("data:image/"), ext, F.lit(";base64,"), encoded)


def decode_text(col: str | Column) -> Column:
    """UTF-8 bytes as text; otherwise read as GBK; otherwise ''.

    Spark accepts only the Unicode family by default: build the plan inside
    :func:`qaloom.sources.files.java_charsets`.
    """
    raw = as_col(col)
    text = raw.cast("string")
    gbk = F.decode(raw, "GBK")
    readable = F.coalesce(~F.contains(gbk, F.lit("�")), F.lit(False))
    return F.when(F.is_valid_utf8(text), text).when(readable, gbk).otherwise(F.lit(""))


def first_int(col: str | Column) -> Column:
    """First signed integer in a text, 0 when there is none.

    The sign counts: a judge's "-1" is a rejection, so it must not read as 1. Full-width digits
    are digits.
    """
    text = F.translate(F.coalesce(as_col(col), F.lit("")), "０１２３４５６７８９", "0123456789")
    digits = F.regexp_extract(text, r"-?\d+", 0)
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def escape_json(col: str | Column) -> Column:
    c = F.replace(as_col(col), F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit('"'), F.lit('\\"'))
    c = F.replace(c, F.lit("\n"), F.lit("\\n"))
    return F.replace(c, F.lit("\t"), F.lit("\\t"))


def hash_bucket(*cols: str | Column, seed: str = "") -> Column:
    """A reproducible 32-bit number for a row, from the MD5 of its key."""
    key = F.concat_ws("|", F.lit(seed), *[as_col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def hash_fraction(*cols: str | Column, seed: str = "") -> Column:
    return hash_bucket(*cols, seed=seed) / F.lit(4294967296.0)
