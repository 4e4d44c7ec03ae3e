"""Expressions that pull structured data out of model replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.functions.text import as_col, first_int, let

# The fenced block replies are asked for, and the refusal text.
FENCED_JSON = r"```json\s*(\{[\s\S]*?\})\s*```"
REFUSAL = "无法设计出问题"

BAD_RECORD = "_bad_record"


def fenced_json(col: str | Column, which: str = "last") -> Column:
    """The last or first fenced JSON object of a reply, NULL when there is none."""
    blocks = F.regexp_extract_all(as_col(col), F.lit("(?U)" + FENCED_JSON), F.lit(1))
    if which not in ("first", "last"):
        raise ValueError(f"which must be 'first' or 'last', not {which!r}")
    return F.try_element_at(blocks, F.lit(1 if which == "first" else -1))


def braces(col: str | Column) -> Column:
    """From the first opening to the last closing brace, NULL when there is none."""
    return F.nullif(F.regexp_extract(as_col(col), r"(?s)\{.*\}", 0), F.lit(""))


def reply_json(col: str | Column, fallback: str = "raw", which: str = "last") -> Column:
    """JSON text of a reply: the fenced block, or what ``fallback`` makes of an unfenced reply.

    ``raw`` takes the reply itself, ``brace`` the span between its outer braces, ``none``
    gives NULL.
    """
    c = as_col(col)
    others = {"raw": c, "brace": braces(c), "none": F.lit(None).cast("string")}
    if fallback not in others:
        raise ValueError(f"fallback must be one of {sorted(others)}, not {fallback!r}")
    return F.coalesce(fenced_json(c, which), others[fallback])


# A quoted string, a stretch without quotes, or a quote that is never closed. Loops are possessive:
# long strings neither backtrack nor overflow the stack.
_TOKEN = r"""(?s)'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^'"]++|['"]"""


def as_json(col: str | Column) -> Column:
    """A dictionary literal as JSON: constants renamed, commas before a closing bracket dropped.

    Only what stands outside quoted strings is touched.
    """

    def repaired(text: Column) -> Column:
        for constant, name in (("True", "true"), ("False", "false"), ("None", "null")):
            text = F.regexp_replace(text, rf"([:\[,]\s*){constant}(?=\s*[,\]}}])", f"$1{name}")
        return F.regexp_replace(text, r",(?=\s*[}\]])", "")

    tokens = F.regexp_extract_all(as_col(col), F.lit(_TOKEN), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.when(t.rlike(r"^['\"]"), t).otherwise(repaired(t))), "")


def typed_json(col: str | Column, schema: T.StructType | str) -> Column:
    """Parse JSON text to ``schema``; NULL for invalid text or anything but an object.

    Single-quoted texts parse as well, and what does not is tried once more as a dictionary
    literal. Spark alone answers invalid input with a struct of NULLs, which looks like an
    empty object; the corrupt-record field tells the two apart.
    """
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    marked = T.StructType([*fields.fields, T.StructField(BAD_RECORD, T.StringType())])
    options = {"columnNameOfCorruptRecord": BAD_RECORD}

    def usable(p: Column) -> Column:
        return p.isNotNull() & p[BAD_RECORD].isNull()

    def parsed(text: Column, otherwise: Column | None) -> Column:
        def keep(p: Column) -> Column:
            record = F.when(usable(p), F.struct(*[p[n].alias(n) for n in fields.fieldNames()]))
            return record if otherwise is None else record.otherwise(otherwise)

        return let(F.from_json(text, marked, options), keep)

    def attempt(text: Column) -> Column:
        return parsed(text, parsed(as_json(text), None))

    return let(as_col(col), lambda t: F.when(F.ltrim(t).startswith("{"), attempt(t)))


def resolve_choice(answer: str | Column, choices: str | Column) -> Column:
    """An integer answer picks the choice at that 0-based place; a text answer stays."""
    a, options = as_col(answer), as_col(choices)
    place = F.when(F.trim(a).rlike(r"^\d+$"), F.trim(a)).try_cast("int")
    return F.coalesce(F.try_element_at(options, place + 1), a)


def reply_score(col: str | Column) -> Column:
    """Judge reply to 1 or -1; a missing reply (the call failed) to 0."""
    return F.when(as_col(col).isNull(), 0).when(first_int(col) == 1, 1).otherwise(-1)
