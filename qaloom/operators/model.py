"""The model-call surface: callers bring the client, Spark brings the batches.

A client is any callable taking one prompt (and, if asked, an image) and returning one reply, or a pair of
reply and reasoning; ``client_factory`` builds it once per task, on the executor. Replies are neither cheap nor repeatable, so write them
out (:func:`qaloom.session.materialize`) before more than one thing reads them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.session import small_batches

Client = Callable[..., "str | tuple[str, str | None]"]

# Tries per prompt and the pause between them.
MAX_TRIES = 16
RETRY_SECONDS = 5.0

_CALL = "_model_call"


def ask(client: Client, given: tuple, tries: int, pause: float) -> tuple[str | None, str | None, str | None]:
    """Reply, error and reasoning of one call; reply or error is set for a non-NULL prompt."""
    if given[0] is None:
        return None, None, None
    error = "no attempt made"
    for attempt in range(tries):
        try:
            answer = client(*given)
            reply, reasoning = answer if isinstance(answer, tuple) else (answer, None)
            if reply is not None:
                return reply, None, reasoning
            error = "empty reply"
        except Exception as problem:  # a failed row must not fail the job
            error = f"{type(problem).__name__}: {problem}"
        if pause and attempt + 1 < tries:
            time.sleep(pause)
    return None, error, None


def model_map(
    df: DataFrame,
    client_factory: Callable[[], Client],
    prompt: str = "prompt",
    reply: str = "reply",
    error: str = "error",
    concurrency: int = 1,
    tries: int = MAX_TRIES,
    pause: float = RETRY_SECONDS,
    partitions: int | None = None,
    image: str | None = None,
    reasoning: str | None = None,
) -> DataFrame:
    """Add ``reply`` and ``error`` columns by calling a model on the ``prompt`` column.

    With ``image`` the client gets that column's value as a second argument (a link, a data URI or
    NULL). With ``reasoning`` the second part of a paired reply is kept under that name.

    At most ``concurrency`` calls are in flight per task; ``partitions`` spreads the rows over
    that many tasks first, bounding the total. Only prompts and replies cross to Python. A
    call that keeps failing leaves a NULL reply and its error text.
    """

    inputs = [prompt, image] if image else [prompt]
    spread = df.repartition(partitions) if partitions else df
    names = {"reply": reply, "error": error} | ({"reasoning": reasoning} if reasoning else {})
    kept = [c for c in df.columns if c not in names.values()]
    called = _called(spread, client_factory, [inputs], concurrency, tries, pause)
    return called.select(*kept, *[F.col(f"{_CALL}.{field}0").alias(name) for field, name in names.items()])


def model_fanout(
    df: DataFrame,
    client_factory: Callable[[], Client],
    calls: list[tuple[str, str, str]],
    concurrency: int = 1,
    tries: int = MAX_TRIES,
    pause: float = RETRY_SECONDS,
    partitions: int | None = None,
) -> DataFrame:
    """Several prompts of a row in one step: ``calls`` names a (prompt, reply, error) column for each.

    The result is that of one ``model_map`` after the other. Those would be as many Python workers at a
    time for every core; here it is one, whatever the number of prompts.
    """
    spread = df.repartition(partitions) if partitions else df
    names = [name for _, *made in calls for name in made]
    called = _called(spread, client_factory, [[p] for p, _, _ in calls], concurrency, tries, pause)
    told = [F.col(f"{_CALL}.{field}{i}").alias(name) for i, (_, *made) in enumerate(calls) for field, name in zip(("reply", "error"), made)]
    return called.select(*[c for c in df.columns if c not in names], *told)


def _called(df: DataFrame, client_factory: Callable[[], Client], calls: list[list[str]], concurrency: int, tries: int, pause: float) -> DataFrame:
    """``df`` with ``_CALL``: fields reply, error and reasoning, numbered, for each list of a client's input columns."""
    small_batches(df.sparkSession)
    width = [len(inputs) for inputs in calls]
    fields = [f"{field}{i}" for i in range(len(calls)) for field in ("reply", "error", "reasoning")]

    @F.pandas_udf(", ".join(f"{f} string" for f in fields))
    def call(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            for columns in batches:
                columns = columns if isinstance(columns, tuple) else (columns,)
                values = iter([[None if pd.isna(v) else v for v in c] for c in columns])
                answers = []
                for n in width:
                    given = list(zip(*[next(values) for _ in range(n)]))
                    if concurrency == 1:
                        answers.append([ask(client, g, tries, pause) for g in given])
                    else:
                        answers.append(list(pool.map(lambda g: ask(client, g, tries, pause), given)))
                rows = [sum(row, ()) for row in zip(*answers)]
                yield pd.DataFrame(rows, columns=fields, dtype=object)

    call = call.asNondeterministic()
    return df.select("*", call(*[F.col(c) for inputs in calls for c in inputs]).alias(_CALL))


def drop_failed(df: DataFrame, reply: str = "reply") -> DataFrame:
    return df.filter(F.col(reply).isNotNull())


def embed_map(
    df: DataFrame,
    embedder_factory: Callable[[], Callable[[list[str]], list[list[float]]]],
    col: str = "content",
    out: str = "embedding",
    batch: int = 64,
) -> DataFrame:
    """Add a vector column from an embedder that takes a list of texts."""

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        embedder = embedder_factory()
        for texts in batches:
            vectors: list = []
            for at in range(0, len(texts), batch):
                vectors.extend(embedder(texts.iloc[at : at + batch].fillna("").tolist()))
            yield pd.Series(vectors, dtype=object)

    return df.withColumn(out, embed(F.col(col)))
