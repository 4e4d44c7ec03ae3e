"""Prompt lookup and rendering."""

from __future__ import annotations

from collections.abc import Mapping
from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.functions.text import as_col, let
from qaloom.session import checked_broadcast, local_frame

# Prompt ids used when a domain has no rule of its own.
DEFAULT_RETRIEVAL_PROMPT = "43"
DEFAULT_QA_PROMPT = "343"

# Words that tell the domain of a text.
DOMAIN_KEYWORDS = {
    "semiconductor": ["IGZO", "TFT", "OLED", "半导体", "晶体管", "能带", "载流子"],
    "optics": ["光谱", "光学", "激光", "折射", "反射", "衍射", "干涉"],
    "materials": ["材料", "晶体", "聚合物", "复合材料", "表面", "界面"],
}
DEFAULT_DOMAIN = "semiconductor"


def template_fields(template: str) -> list[str]:
    """Names in braces, in order of first use. Doubled braces are literal."""
    names = [name for _, name, _, _ in Formatter().parse(template) if name is not None]
    bad = [n for n in names if not n.isidentifier()]
    if bad:
        raise ValueError(f"placeholders must be plain names: {bad}")
    return list(dict.fromkeys(names))


def render(template: str, **columns: str | Column) -> Column:
    """The template as one concat of literals and columns, fixed when the plan is built.

    A placeholder without a column is an error here, before any row is read. A NULL field
    renders as ''.
    """
    missing = [n for n in template_fields(template) if n not in columns]
    if missing:
        raise KeyError(f"no column for placeholders {missing}")
    pieces: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            pieces.append(F.coalesce(as_col(columns[name]).cast("string"), F.lit("")))
    return F.concat(*pieces) if pieces else F.lit("")


def render_prompt(df: DataFrame, template: str, out: str = "prompt", **columns: str | Column) -> DataFrame:
    named = {n: columns.get(n, n if n in df.columns else None) for n in template_fields(template)}
    return df.withColumn(out, render(template, **{n: c for n, c in named.items() if c is not None}))


class PromptRegistry:
    """Templates by id. Ids may be given as int, float or text; they are kept as text."""

    def __init__(self, *sources: Mapping[int | float | str, str]):
        self.templates = {str(k): v for source in sources for k, v in source.items()}

    def ids(self) -> list[str]:
        return sorted(self.templates)

    def get(self, prompt_id: int | float | str) -> str:
        return self.templates.get(str(prompt_id), "")

    def frame(self, spark: SparkSession) -> DataFrame:
        return local_frame(spark, list(self.templates.items()), "prompt_id string, template string")

    def attach(self, df: DataFrame, id_col: str = "prompt_id") -> DataFrame:
        """Add ``template``, '' for an unknown id."""
        table = self.frame(df.sparkSession).withColumnRenamed("prompt_id", "_id")
        return (
            df.join(table, F.col(id_col).cast("string") == F.col("_id"), "left")
            .withColumn("template", F.coalesce("template", F.lit("")))
            .drop("_id")
        )

    def render_by_id(self, df: DataFrame, ids: list, id_col: str = "prompt_id", out: str = "prompt") -> DataFrame:
        """Render each row with the template its id names; ids outside ``ids`` get NULL.

        An id without a template, or a template naming an absent column, fails right away.
        """
        unknown = [i for i in ids if str(i) not in self.templates]
        if unknown:
            raise KeyError(f"no templates for prompt ids {unknown}")
        key = F.col(id_col).cast("string")
        rendered = F.lit(None).cast("string")
        for i in ids:
            template = self.templates[str(i)]
            fields = {n: n for n in template_fields(template) if n in df.columns}
            rendered = F.when(key == str(i), render(template, **fields)).otherwise(rendered)
        return df.withColumn(out, rendered)


def prompt_lookup(df: DataFrame, registry: DataFrame, id_col: str = "prompt_id") -> DataFrame:
    """The same lookup against a registry kept as a table; broadcast if its size allows."""
    table = checked_broadcast(registry.select(F.col("prompt_id").cast("string").alias("_id"), "template"))
    return (
        df.join(table, F.col(id_col).cast("string") == F.col("_id"), "left")
        .withColumn("template", F.coalesce("template", F.lit("")))
        .drop("_id")
    )


def context_fallback(df: DataFrame, out: str = "qa_context") -> DataFrame:
    """The text itself where there is one, else the knowledge fields as one JSON object.

    Fields a row or the whole frame lacks are '' or [] there.
    """

    def field(name: str, empty: Column) -> Column:
        return (F.coalesce(F.col(name), empty) if name in df.columns else empty).alias(name)

    nothing, no_list = F.lit(""), F.array().cast("array<string>")
    fields = [field("source_file", nothing), field("key_concepts", no_list)]
    if "technical_details" in df.columns:
        fields.append(F.col("technical_details"))
    fields += [field("main_findings", no_list), field("context", nothing), field("text_content", nothing)]
    text = F.nullif(field("text_content", nothing), nothing)
    return df.withColumn(out, F.coalesce(text, F.to_json(F.struct(*fields))))


def domain_route(
    df: DataFrame,
    retrieval_ids: Mapping[str, int | str],
    qa_ids: Mapping[str, list[int | str]],
    domain: str = "domain",
) -> DataFrame:
    """Prompt ids by domain: the retrieval prompt and the first of the QA prompts."""

    def by_domain(rules: dict[str, str], default: str) -> Column:
        choice = F.lit(default)
        for name, value in rules.items():
            choice = F.when(F.col(domain) == name, F.lit(value)).otherwise(choice)
        return choice

    first_qa = {d: str(ids[0]) for d, ids in qa_ids.items() if ids}
    return df.withColumn(
        "retrieval_prompt_id",
        by_domain({d: str(v) for d, v in retrieval_ids.items()}, DEFAULT_RETRIEVAL_PROMPT),
    ).withColumn("qa_prompt_id", by_domain(first_qa, DEFAULT_QA_PROMPT))


def domain_tag(
    df: DataFrame,
    col: str = "content",
    keywords: Mapping[str, list[str]] = DOMAIN_KEYWORDS,
    default: str = DEFAULT_DOMAIN,
) -> DataFrame:
    """The domain with most of its keywords in the text; earlier domains win ties.

    Row by row against the keyword lists, so nothing is shuffled.
    """
    scored = [
        F.struct(
            sum((F.contains(F.col(col), F.lit(w)).cast("int") for w in words), F.lit(0)).alias("hits"),
            F.lit(-rank).alias("rank"),
            F.lit(name).alias("name"),
        )
        for rank, (name, words) in enumerate(keywords.items())
    ]
    best = F.array_max(F.array(*scored))
    result = let(
        best,
        lambda b: F.struct(
            F.coalesce(b["hits"], F.lit(0)).alias("hits"),
            F.when(b["hits"] > 0, b["name"]).otherwise(F.lit(default)).alias("name"),
        ),
    )
    tagged = df.withColumn("_domain", result)
    return tagged.withColumn("domain_hits", F.col("_domain.hits")).withColumn("domain", F.col("_domain.name")).drop("_domain")


def chat_messages(user: str | Column, system: str | Column | None = None) -> Column:
    """Messages as an array of (role, content); no system entry where it is NULL or ''."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    u = message("user", as_col(user))
    if system is None:
        return F.array(u)
    s = as_col(system)
    return F.array_compact(F.array(F.when(F.coalesce(s, F.lit("")) != "", message("system", s)), u))
