"""Which questions to ask of what, and how many."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from qaloom.functions.text import hash_fraction
from qaloom.operators.prompts import PromptRegistry
from qaloom.session import global_index, local_frame

# Share of each question type, and of each type in the presets.
TYPE_RATIOS = {"factual": 0.15, "comparison": 0.15, "reasoning": 0.50, "open_ended": 0.20}
RATIO_PRESETS = {
    "balanced_config": {"factual": 0.25, "comparison": 0.20, "reasoning": 0.25, "multi_hop": 0.15, "open_ended": 0.15},
    "open_ended_focused": {"factual": 0.15, "comparison": 0.15, "reasoning": 0.20, "multi_hop": 0.10, "open_ended": 0.40},
    "traditional_qa": {"factual": 0.40, "comparison": 0.30, "reasoning": 0.30, "multi_hop": 0.00, "open_ended": 0.00},
    "complex_reasoning": {"factual": 0.10, "comparison": 0.15, "reasoning": 0.35, "multi_hop": 0.25, "open_ended": 0.15},
    "technical": {"factual": 0.20, "comparison": 0.25, "reasoning": 0.30, "multi_hop": 0.10, "open_ended": 0.15},
}

# Question totals of the usage scenarios.
SCENARIO_TOTALS = {
    "training_data_generation": ("balanced_config", 10000),
    "innovation_workshop": ("open_ended_focused", 50),
    "technical_assessment": ("complex_reasoning", 200),
    "knowledge_base_qa": ("technical", 5000),
}

# Prompt id per question type.
TYPE_PROMPTS = {"factual": "43", "comparison": "44", "reasoning": "45", "open_ended": "46"}

# Target ratio and priority (1 is highest) per type.
TYPE_PRIORITIES = {
    "factual": (0.25, 3),
    "comparison": (0.18, 4),
    "reasoning": (0.25, 2),
    "multi_hop": (0.15, 5),
    "open_ended": (0.17, 1),
}

# Weights of the type score; step and bounds of a ratio change.
GAP_WEIGHT, PRIORITY_WEIGHT, DEVIATION_WEIGHT = 0.5, 0.3, 0.2
RATIO_STEP, RATIO_MIN, RATIO_MAX = 0.1, 0.05, 0.4

# Categories of open-ended questions and their words, first match wins.
QUESTION_CATEGORIES = {
    "TFT器件技术": ["tft", "薄膜晶体管", "器件失效", "短沟道", "顶栅氧化物"],
    "OLED显示技术": ["oled", "金属氧化物背板", "残影", "显示"],
    "薄膜制造工艺": ["薄膜晶体管", "栅极", "介电层", "厚度", "材料选择"],
    "显示面板优化": ["显示面板", "功耗", "亮度", "矛盾需求"],
    "OLED生产工艺": ["大尺寸", "oled面板", "均匀性", "良率"],
    "柔性显示技术": ["柔性显示", "显示性能", "机械可靠性"],
    "高分辨率技术": ["高分辨率", "信号完整性", "emi", "显示驱动"],
}
DEFAULT_CATEGORY = "通用技术问题"

# Words that show which technology a subgraph is about.
SUBGRAPH_FEATURES = {"display": ["display", "oled"], "semiconductor": ["tft", "semiconductor"]}

# Fixed values: (shortest question, longest question, shortest answer) per type, and for others.
LENGTH_LIMITS = {
    "factual": (30, 200, 20),
    "comparison": (50, 300, 50),
    "reasoning": (60, 400, 80),
    "multi_hop": (70, 350, 60),
    "open_ended": (80, 500, 100),
}
FLAT_LIMITS = (20, None, 10)


def due_types(index: Column, total: Column, ratios: Mapping[str, float]) -> Column:
    """Types whose turn it is at a row: every int(1/ratio)-th row, and all of them at the last."""
    last = index + 1 == total
    return F.array_compact(
        F.array(*[F.when((index % int(1 / r) == 0) | last, F.lit(t)) for t, r in ratios.items() if r > 0])
    )


def weighted_pick(ratios: Mapping[str, float], *key: str, seed: str = "") -> Column:
    """One type drawn by weight, the same for the same key."""
    x = hash_fraction(*key, seed=seed) * F.lit(float(sum(ratios.values())))
    live = [(t, r) for t, r in ratios.items() if r > 0]
    pick, below = F.lit(live[-1][0]), 0.0
    bounds = []
    for t, r in live:
        below += r
        bounds.append((t, below))
    for t, bound in reversed(bounds[:-1]):
        pick = F.when(x < bound, F.lit(t)).otherwise(pick)
    return pick


def plan_question_types(
    df: DataFrame, *order: str, ratios: Mapping[str, float] = TYPE_RATIOS, seed: str = ""
) -> DataFrame:
    """One row per (input row, planned type). Rows are numbered in ``order`` (ending unique).

    A row on no type's turn gets one weighted pick, so every row is asked about.
    """
    indexed = global_index(df, *order, name="row_index", total="_total")
    due = due_types(F.col("row_index"), F.col("_total"), ratios)
    planned = F.when(F.size(due) > 0, due).otherwise(F.array(weighted_pick(ratios, *order, seed=seed)))
    return indexed.withColumn("question_type", F.explode(planned)).drop("_total")


def explode_tasks(planned: DataFrame, registry: PromptRegistry, prompts: Mapping[str, str] = TYPE_PROMPTS) -> DataFrame:
    """Prompt id and rendered prompt of every planned (row, type)."""
    by_type = F.create_map(*[F.lit(x) for pair in prompts.items() for x in pair])
    tasks = planned.withColumn("prompt_id", by_type[F.col("question_type")])
    return registry.render_by_id(tasks, list(prompts.values()))


def type_quota(df: DataFrame, ratios: Mapping[str, float], total: str = "total") -> DataFrame:
    """Integer targets per type that add up to each row's ``total``, by largest remainder.

    Shares are exact decimals. Every row stays in place: nothing is shuffled.
    """
    n = F.col(total)
    shares = []
    for rank, (name, ratio) in enumerate(ratios.items()):
        exact = F.lit(str(ratio)).cast("decimal(10,4)") * n.cast("decimal(18,0)")
        whole = F.floor(exact)
        shares.append(
            F.struct(
                (whole - exact).cast("decimal(20,4)").alias("order"),
                F.lit(rank).alias("rank"),
                F.lit(name).alias("question_type"),
                whole.cast("bigint").alias("whole"),
            )
        )
    kept = [c for c in df.columns]
    ranked = df.withColumn("_shares", F.sort_array(F.array(*shares))).withColumn(
        "_left", n.cast("bigint") - F.aggregate("_shares", F.lit(0).cast("bigint"), lambda a, s: a + s["whole"])
    )
    return ranked.select(*kept, "_left", F.posexplode("_shares").alias("_pos", "_share")).select(
        *kept,
        F.col("_share.question_type").alias("question_type"),
        (F.col("_share.whole") + (F.col("_pos") < F.col("_left")).cast("bigint")).alias("target"),
    )


def _shares_now(current: DataFrame, types: Mapping[str, tuple[float, int]]) -> DataFrame:
    """Current count and share beside the target of each type; one row per type."""
    targets = local_frame(
        current.sparkSession,
        [(t, float(r), int(p)) for t, (r, p) in types.items()],
        "question_type string, ratio double, priority int",
    )
    counted = current.groupBy("question_type").agg(F.count("*").alias("n"))
    joined = counted.join(targets, "question_type", "right").withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.sum("n").over(Window.partitionBy())
    return joined.withColumn("share", F.coalesce(F.try_divide(F.col("n"), total), F.lit(0.0)))


def type_priority_score(
    current: DataFrame, target_total: int | None = None, types: Mapping[str, tuple[float, int]] = TYPE_PRIORITIES
) -> DataFrame:
    """Rank types by how much they are wanted next.

    Half of the score is the missing part of the type's target count (of ``target_total``, or
    of the questions there are now), 30% its priority, 20% how far its share is below target.
    """
    top = max(p for _, p in types.values())
    rows = _shares_now(current, types)
    wanted_total = F.lit(target_total) if target_total else F.sum("n").over(Window.partitionBy())
    wanted = F.col("ratio") * wanted_total
    gap = F.coalesce(F.try_divide(F.greatest(wanted - F.col("n"), F.lit(0.0)), wanted), F.lit(0.0))
    urgency = (F.lit(top + 1) - F.col("priority")) / F.lit(float(top))
    short = F.greatest(F.col("ratio") - F.col("share"), F.lit(0.0))
    scored = rows.withColumn(
        "score", F.round(gap * GAP_WEIGHT + urgency * PRIORITY_WEIGHT + short * DEVIATION_WEIGHT, 6)
    )
    order = Window.orderBy(F.desc("score"), "question_type")
    return scored.select("question_type", "n", "score", F.row_number().over(order).alias("rank"))


def clamp_ratio(current: DataFrame, types: Mapping[str, tuple[float, int]] = TYPE_PRIORITIES) -> DataFrame:
    """Shift each ratio a step towards types that fall short, within bounds, then renormalise."""
    rows = _shares_now(current, types)
    step = F.when(F.col("share") < F.col("ratio"), RATIO_STEP).when(F.col("share") > F.col("ratio"), -RATIO_STEP)
    moved = F.col("ratio") + F.coalesce(step, F.lit(0.0))
    bounded = F.least(F.greatest(moved, F.lit(RATIO_MIN)), F.lit(RATIO_MAX))
    clamped = rows.withColumn("clamped", bounded)
    return clamped.select(
        "question_type",
        "ratio",
        "clamped",
        (F.col("clamped") / F.sum("clamped").over(Window.partitionBy())).alias("adjusted"),
    )


def subgraph_profile(df: DataFrame) -> DataFrame:
    return df.withColumn("num_nodes", F.size("nodes")).withColumn("num_edges", F.size("edges"))


def graph_profile(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The same counts from graphs kept as tables (``graph_id, id`` and one row per edge).

    Both sides are counted with partial aggregation, so a graph of any size is no task of its own.
    """
    n = nodes.select("graph_id", "id").distinct().groupBy("graph_id").agg(F.count("*").alias("num_nodes"))
    e = edges.groupBy("graph_id").agg(F.count("*").alias("num_edges"))
    counted = n.join(e, "graph_id", "full_outer")
    return counted.select("graph_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("num_nodes", "num_edges")])


def graph_features(nodes: DataFrame, features: Mapping[str, list[str]] = SUBGRAPH_FEATURES) -> DataFrame:
    """Which features the nodes of each graph show, as ``graph_id, features ARRAY<STRING>``."""
    text = F.lower("id")
    flags = nodes.groupBy("graph_id").agg(
        *[F.bool_or(_any_word(text, words)).alias(name) for name, words in features.items()]
    )
    return flags.select(
        "graph_id", F.array_compact(F.array(*[F.when(F.col(n), F.lit(n)) for n in features])).alias("features")
    )


def node_features(nodes: str = "nodes", features: Mapping[str, list[str]] = SUBGRAPH_FEATURES) -> Column:
    """The same from a nested array of nodes."""
    text = F.lower(F.to_json(nodes))
    return F.array_compact(F.array(*[F.when(_any_word(text, words), F.lit(n)) for n, words in features.items()]))


def subgraph_max_types(nodes: str | Column = "num_nodes", edges: str | Column = "num_edges") -> Column:
    """How many question types a subgraph of this size can carry."""
    n = F.col(nodes) if isinstance(nodes, str) else nodes
    e = F.col(edges) if isinstance(edges, str) else edges
    return (
        F.when((n <= 2) | (e <= 1), 1).when((n <= 4) | (e <= 3), 2).when((n <= 8) | (e <= 6), 3).otherwise(4)
    )


def question_category(
    col: str = "question", rules: Mapping[str, list[str]] = QUESTION_CATEGORIES, default: str = DEFAULT_CATEGORY
) -> Column:
    """The first category one of whose words occurs in the question."""
    text = F.lower(F.coalesce(F.col(col), F.lit("")))
    category = F.lit(default)
    for name, words in reversed(list(rules.items())):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(text, F.lit(w))
        category = F.when(hit, F.lit(name)).otherwise(category)
    return category


def fixed_question_match(
    df: DataFrame,
    questions: list[tuple[int, str]],
    k: int,
    features: Mapping[str, list[str]] = SUBGRAPH_FEATURES,
) -> DataFrame:
    """The ``k`` fixed questions that share most features with each graph (its ``features``).

    A feature counts when the graph has it and one of its words occurs in the question.
    Questions sharing nothing are left out; ties go to the lower id. The question list is
    configuration, so each graph scores it in place: no join, no shuffle.
    """
    scored = []
    for qid, question in questions:
        mine = [n for n, words in features.items() if any(w in question.lower() for w in words)]
        shared = F.size(F.array_intersect("features", F.array(*[F.lit(n) for n in mine]).cast("array<string>")))
        scored.append(F.struct((-shared).alias("neg"), F.lit(qid).alias("question_id"), F.lit(question).alias("question")))
    ranked = F.slice(F.sort_array(F.filter(F.array(*scored), lambda s: s["neg"] < 0)), 1, k)
    kept = [c for c in df.columns if c not in ("nodes", "edges", "features")]
    return df.select(*kept, F.posexplode(ranked).alias("_pos", "_q")).select(
        *kept,
        F.col("_q.question_id").alias("question_id"),
        F.col("_q.question").alias("question"),
        (-F.col("_q.neg")).alias("score"),
        (F.col("_pos") + 1).alias("rank"),
    )


def _any_word(text: Column, words: list[str]) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | F.contains(text, F.lit(w))
    return hit


def type_length_filter(
    df: DataFrame,
    limits: Mapping[str, tuple[int | None, int | None, int | None]] = LENGTH_LIMITS,
    other: tuple[int | None, int | None, int | None] = FLAT_LIMITS,
) -> DataFrame:
    """Pairs whose question and answer lengths fit their type (``other`` for unlisted types)."""
    q = F.char_length(F.coalesce("question", F.lit("")))
    a = F.char_length(F.coalesce("answer", F.lit("")))

    def fits(low: int | None, high: int | None, low_answer: int | None) -> Column:
        ok = F.lit(True)
        if low is not None:
            ok = ok & (q >= low)
        if high is not None:
            ok = ok & (q <= high)
        if low_answer is not None:
            ok = ok & (a >= low_answer)
        return ok

    keep = fits(*other)
    for name, bounds in limits.items():
        keep = F.when(F.col("question_type") == name, fits(*bounds)).otherwise(keep)
    return df.filter(keep)
