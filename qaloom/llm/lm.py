"""Log-bilinear language model, trained in numpy by noise-contrastive estimation.

A token is predicted in two steps. Units come first: the most frequent tokens, and classes of all others. Inside
a class its members follow, the tokens that occur often enough to have vectors of their own, and one rest for
all others, which have their smoothed share of it. How many members there are grows with the text.
A context's vector is the sum of the vectors of the last token and of the unit before it, weighted by position; a
score is its product with the target's vector plus a bias. Every training token is learnt from: each task trains
on its own rows and Spark averages the parameters, each vector by how often a task used it. Scoring normalises
exactly at both steps: one matrix product over the units for the distinct contexts of a block of texts, and one
over a class's members for the contexts in which the class occurs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.llm.common import flat_ranges, held_out, released
from qaloom.llm.hashing import LOWER, text_blocks, words_in
from qaloom.session import materialize

WORDS, CLASSES, WIDTH, NOISE, INNER_NOISE, BATCH = 383, 128, 16, 24, 2, 2048
# A token is a member of its class if it occurs at least total ** POWER / SPREAD times: at most
# SPREAD * total ** (1 - POWER) tokens do, by frequency laws a tenth of that; six million in 100 TB is the bound.
POWER, SPREAD = 0.6, 32
# Tasks that train; each holds one copy of the parameters.
MOST_TRAINERS = 4096
# Bytes of text scored at once, and units whose parameters travel in one row.
BLOCK, UNITS_A_ROW = 1 << 22, 64
# Scores held at once: a table of contexts by units that fits a core's cache.
TABLE = 1 << 18
SHORT_RUN = 6
# Counts of at most so many frequent tokens travel with the tasks; the counts of all others are joined.
MOST_CARRIED = 1_000_000
SMOOTH = 0.1
# The end token: no word hash equals it but by chance of 1 in 2**64.
END = np.uint64(0xE17DE17DE17DE17D)


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes, classes, first token of each row and the end); each row ends in END, class -1."""
    starts, ends, hashes, first = words_in(data, offsets, lower=True)
    second = np.where(ends - starts > 1, LOWER[data[np.minimum(starts + 1, max(len(data) - 1, 0))]], 0) if len(starts) else np.zeros(0)
    classes = (LOWER[data[starts]].astype(np.int64) * 31 + second.astype(np.int64)) % CLASSES if len(starts) else np.zeros(0, np.int64)
    rows = np.diff(first)
    stop = first[1:]
    return np.insert(hashes, stop, END), np.insert(classes, stop, -1), np.concatenate([[0], np.cumsum(rows + 1)])


# --- counts -----------------------------------------------------------------------------------

def count_tokens(docs: DataFrame, text_col: str) -> DataFrame:
    """``token, class, n`` over all of ``docs``."""

    def partial(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for _, data, offsets in text_blocks(part.column(0), BLOCK):
                tokens, classes, _ = tokens_of(data, offsets)
                found, at, n = np.unique(tokens, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(classes[at].astype(np.int16)), pa.array(n)],
                                                 names=["token", "class", "n"])

    rows = docs.select(text_col).mapInArrow(released(partial), "token long, class short, n long")
    return rows.groupBy("token", "class").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Numbers of units: tokens (sorted hashes ``words``), then the classes, then all members, class by
    class (class k has ``starts[k]:starts[k + 1]`` of them), then the rest of every class. ``carried`` are the
    hashes (sorted) and counts of frequent tokens, units and members included."""

    words: np.ndarray
    frequency: np.ndarray  # of tokens and classes, summing to 1
    members: np.ndarray  # sorted hashes
    member_units: np.ndarray  # their numbers
    member_class: np.ndarray  # class of member j
    starts: np.ndarray
    inner: np.ndarray  # share of every member, then of every rest, in its class
    rest_log: np.ndarray  # log10 of the smoothed size of a class's rest
    carried: np.ndarray
    carried_counts: np.ndarray
    total: int
    distinct: int

    def units(self, tokens: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """A token's own number, or that of its class."""
        out = len(self.words) + np.maximum(classes, 0)
        for hashes, numbers in ((self.words, np.arange(len(self.words))), (self.members, self.member_units)):
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, tokens), len(hashes) - 1)
                out = np.where(hashes[at] == tokens, numbers[at], out)
        return out

    def tops(self, units: np.ndarray) -> np.ndarray:
        """The same with members as their classes."""
        if not len(self.members):
            return units
        size = len(self.frequency)
        return np.where(units < size, units, len(self.words) + self.member_class[np.maximum(units - size, 0)])

    def inner_targets(self, units: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, unit to be told within it) of every token; class -1 where nothing is left to be told."""
        k = tops - len(self.words)
        open_ = (k >= 0) & (np.diff(self.starts)[np.maximum(k, 0)] > 0)
        rest = len(self.frequency) + len(self.members) + np.maximum(k, 0)
        return np.where(open_, k, -1), np.where(units < len(self.frequency), rest, units)


def build_vocabulary(counts: DataFrame) -> Vocabulary:
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    end = F.lit(int(END.view(np.int64)))
    top = counts.where(F.col("token") != end).orderBy(F.desc("n"), "token").limit(WORDS).collect()
    chosen = {r["token"]: r["n"] for r in top}
    ended = counts.where(F.col("token") == end).collect()
    chosen[int(END.view(np.int64))] = ended[0]["n"] if ended else 0
    hashes = np.sort(np.array(list(chosen), np.int64).view(np.uint64))
    word_counts = np.array([chosen[int(h)] for h in hashes.view(np.int64)], float)
    sizes = counts.where(F.col("class") >= 0).groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    held = np.zeros((2, CLASSES))
    for r in sizes:
        held[:, r["class"]] = r["n"], r["v"]
    for r in top:
        held[:, r["class"]] -= r["n"], 1
    frequency = np.concatenate([word_counts, held[0]]) + 0.5
    least = max(2, math.ceil(totals["n"] ** POWER / SPREAD))
    often = counts.where((F.col("n") >= least) & (F.col("class") >= 0)).select("token", "class", "n").toArrow()
    tokens, classes, n = (often.column(c).to_numpy() for c in ("token", "class", "n"))
    tokens, classes = tokens.view(np.uint64), classes.astype(np.int64)
    new = ~np.isin(tokens, hashes)
    order = np.lexsort((tokens[new], classes[new]))
    tokens, classes, n = tokens[new][order], classes[new][order], n[new][order]
    starts = np.searchsorted(classes, np.arange(CLASSES + 1))
    rest = held - np.stack([np.bincount(classes, n, CLASSES), np.bincount(classes, minlength=CLASSES)])
    inner = np.concatenate([n + 0.5, rest[0] + 0.5])
    of = np.concatenate([classes, np.arange(CLASSES)])
    inner = inner / np.bincount(of, inner, CLASSES)[of]
    by_hash = np.argsort(tokens)
    # Frequent tokens by a count threshold, found from a histogram of a few hundred rows.
    level = F.floor(F.log2("n") * 8)
    histogram = sorted(((r["level"], r["v"]) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("v")).collect()), reverse=True)
    least, room = None, MOST_CARRIED
    for value, v in histogram:
        if v > room:
            break
        least, room = value, room - v
    carried = counts.where(level >= least).select("token", "n").toArrow() if least is not None else None
    all_tokens, all_counts = [hashes, tokens], [word_counts.astype(np.int64), n]
    if carried:
        all_tokens.append(carried.column("token").to_numpy().view(np.uint64))
        all_counts.append(carried.column("n").to_numpy())
    known, at = np.unique(np.concatenate(all_tokens), return_index=True)
    return Vocabulary(
        hashes, frequency / frequency.sum(), tokens[by_hash], len(frequency) + by_hash, classes, starts, inner,
        np.log10(rest[0] + SMOOTH * (rest[1] + 1)), known, np.concatenate(all_counts)[at], int(totals["n"]), int(totals["v"]))


# --- model --------------------------------------------------------------------------------------

@dataclass
class Model:
    """``R``: context vectors (the last is the text's start), ``D``: position weights, ``Q`` and ``b``: outputs.

    The first ``size`` outputs are tokens and classes; then come members and rests.
    """

    R: np.ndarray
    D: np.ndarray
    Q: np.ndarray
    b: np.ndarray
    size: int

    @staticmethod
    def new(frequency: np.ndarray, inner: np.ndarray | None = None, seed: int = 5) -> Model:
        shares = np.concatenate([frequency, inner if inner is not None else []])
        rng, n = np.random.default_rng(seed), len(shares)
        return Model(rng.normal(0, 0.3, (n + 1, WIDTH)).astype(np.float32), np.ones((2, WIDTH), np.float32),
                     rng.normal(0, 0.1, (n, WIDTH)).astype(np.float32), np.log(shares).astype(np.float32), len(frequency))

    def copy(self) -> Model:
        return Model(self.R.copy(), self.D.copy(), self.Q.copy(), self.b.copy(), self.size)

    def rows(self) -> np.ndarray:
        """One row a unit: its context vector, output vector and bias; the start has the first only."""
        out = np.zeros((len(self.R), 2 * WIDTH + 1), np.float32)
        out[:, :WIDTH], out[:-1, WIDTH:-1], out[:-1, -1] = self.R, self.Q, self.b
        return out

    def hidden(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.R.take(one, 0) * self.D[0] + self.R.take(two, 0) * self.D[1]

    def log_probabilities(self, one: np.ndarray, two: np.ndarray, units: np.ndarray | slice | None = None) -> np.ndarray:
        """Natural logs of the probabilities of ``units`` (all tokens and classes if not given), which sum to 1, after
        each context (the previous token's unit, the one before)."""
        units = slice(0, self.size) if units is None else units
        scores = self.hidden(one, two) @ self.Q[units].T + self.b[units]
        scores -= scores.max(1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(1, keepdims=True))


    def log_chosen(self, one: np.ndarray, two: np.ndarray, units: np.ndarray | slice, row: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logs of the probabilities of ``units[target]`` after contexts ``row`` (ascending), table by table."""
        weights = np.concatenate([self.Q[units], self.b[units, None]], 1).T.copy()
        step = max(16, TABLE // weights.shape[1])
        edges = np.searchsorted(row, np.arange(0, len(one) + step, step))
        out = np.zeros(len(row))
        for k, at in enumerate(range(0, len(one), step)):
            hidden = self.hidden(one[at: at + step], two[at: at + step])
            scores = np.concatenate([hidden, np.ones((len(hidden), 1), np.float32)], 1) @ weights
            scores -= scores.max(1, keepdims=True)
            mine = slice(edges[k], edges[k + 1])
            of = row[mine] - at
            chosen = scores[of, target[mine]]
            np.exp(scores, out=scores)
            out[mine] = chosen - np.log(scores.sum(1))[of]
        return out


def contexts(units: np.ndarray, tops: np.ndarray, first: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The unit before each token and the token or class before that; ``start`` stands before a row's first token."""
    one, two = np.full(len(units), start), np.full(len(units), start)
    one[1:], two[2:] = units[:-1], tops[:-2]
    begins = first[:-1]
    one[begins], two[begins] = start, start
    second = begins[np.diff(first) > 1] + 1
    two[second] = start
    return one, two


def run_sums(values: np.ndarray, edges: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Sums of the rows of each run: short ones row by row, all runs at once, long ones column by column."""
    if values.ndim == 1:
        return np.add.reduceat(values, edges)
    out = values.take(edges, 0)
    short = np.flatnonzero((runs > 1) & (runs <= SHORT_RUN))
    for k in range(1, SHORT_RUN):
        short = short[runs[short] > k]
        if not len(short):
            break
        out[short] += values.take(edges[short] + k, 0)
    long = np.flatnonzero(runs > SHORT_RUN)
    if len(long):
        of = np.repeat(np.arange(len(long)), runs[long])
        picked = values.take(flat_ranges(edges[long], runs[long]), 0).T.astype(np.float64)
        out[long] = np.stack([np.bincount(of, column, len(long)) for column in picked], 1)
    return out


class Trainer:
    """Noise-contrastive steps with Adagrad on the rows a batch touches; one set of noise units serves a batch, and
    within classes every token has its own."""

    def __init__(self, model: Model, frequency: np.ndarray, seed: int, words: Vocabulary | None = None):
        self.m, self.rng = model, np.random.default_rng(seed)
        self.cumulated, self.offset = np.cumsum(frequency), np.log(NOISE * frequency).astype(np.float32)
        self.seen = {k: np.full(getattr(model, k).shape, 1e-2, np.float32) for k in "RDQb"}
        self.uses, self.tokens = np.zeros(len(model.R)), 0
        if words is not None:
            # Members and rest of class k lie together, and their shares add up from k to k + 1.
            of = np.concatenate([words.member_class, np.arange(CLASSES)])
            order = np.argsort(of, kind="stable")
            self.columns = len(frequency) + order
            self.edges = np.searchsorted(of[order], np.arange(CLASSES + 1))
            self.shares = np.cumsum(words.inner[order])
            self.inner_offset = np.log(INNER_NOISE * words.inner).astype(np.float32)

    def learn(self, at: np.ndarray, rate: float, **grads: np.ndarray) -> None:
        """Adds up the gradients of equal rows and moves those rows."""
        if len(self.m.R) < 1 << 16:
            at = at.astype(np.uint16)  # sorted by radix
        order = np.argsort(at, kind="stable")
        ranked = at[order]
        edges = np.concatenate([[0], np.flatnonzero(ranked[1:] != ranked[:-1]) + 1])
        rows, runs = ranked[edges], np.diff(edges, append=len(order))
        for name, g in grads.items():
            g = run_sums(g.take(order, 0), edges, runs)
            seen, values = self.seen[name], getattr(self.m, name)
            now = seen.take(rows, 0) + g * g
            seen[rows] = now
            values[rows] = values.take(rows, 0) - np.float32(rate) * g / np.sqrt(now)

    def step(self, target: np.ndarray, one: np.ndarray, two: np.ndarray, inner: np.ndarray | None = None,
             classes: np.ndarray | None = None, rate: float = 0.08) -> None:
        m, scale = self.m, np.float32(50 / len(target))
        noise = np.minimum(np.searchsorted(self.cumulated, self.rng.random(NOISE)), m.size - 1)
        r_one, r_two = m.R.take(one, 0), m.R.take(two, 0)
        hidden = r_one * m.D[0] + r_two * m.D[1]
        q_target, q_noise = m.Q.take(target, 0), m.Q[noise]
        s_target = np.einsum("ij,ij->i", hidden, q_target) + m.b[target] - self.offset[target]
        s_noise = hidden @ q_noise.T + (m.b[noise] - self.offset[noise])
        g_target = scale * 0.5 * (np.tanh(0.5 * s_target) - 1)
        g_noise = scale * 0.5 * (np.tanh(0.5 * s_noise) + 1)
        d_hidden = g_target[:, None] * q_target + g_noise @ q_noise
        at, d_q, d_b = [target, noise], [g_target[:, None] * hidden, g_noise.T @ hidden], [g_target, g_noise.sum(0)]
        pick = np.flatnonzero(classes >= 0) if classes is not None else ()
        if len(pick):
            k, h, own = classes[pick], hidden.take(pick, 0), inner[pick]
            d_inner = np.zeros_like(h)
            for n in range(INNER_NOISE + 1):
                unit = own
                if n:
                    drawn = np.searchsorted(self.shares, k + self.rng.random(len(pick)))
                    unit = self.columns[np.clip(drawn, self.edges[k], self.edges[k + 1] - 1)]
                q = m.Q.take(unit, 0)
                g = np.einsum("ij,ij->i", h, q) + m.b[unit] - self.inner_offset[unit - m.size]
                g = scale * 0.5 * (np.tanh(0.5 * g) + (1 if n else -1))
                d_inner += g[:, None] * q
                at.append(unit)
                d_q.append(g[:, None] * h)
                d_b.append(g)
            d_hidden[pick] += d_inner
        d_position = np.stack([(d_hidden * r_one).sum(0), (d_hidden * r_two).sum(0)])
        self.learn(np.concatenate(at), rate, Q=np.concatenate(d_q), b=np.concatenate(d_b))
        self.learn(np.concatenate([one, two]), rate, R=np.concatenate([d_hidden * m.D[0], d_hidden * m.D[1]]))
        self.learn(np.arange(2), rate, D=d_position)
        self.tokens += len(target)

    def count(self, *units: np.ndarray) -> None:
        """Notes how often units were context or target."""
        for u in units:
            self.uses += np.bincount(u, minlength=len(self.uses))


def train(docs: DataFrame, words: Vocabulary, text_col: str) -> Model:
    """One pass over all of ``docs``: every task trains on its rows, vectors are averaged by their uses."""
    initial = Model.new(words.frequency, words.inner)

    def fit(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(initial.copy(), words.frequency, 9, words)
        start = len(initial.b)
        for part in parts:
            for _, data, offsets in text_blocks(part.column(0)):
                tokens, classes, first = tokens_of(data, offsets)
                units = words.units(tokens, classes)
                tops = words.tops(units)
                one, two = contexts(units, tops, first, start)
                within, inner = words.inner_targets(units, tops)
                trainer.count(tops, one, inner[within >= 0])
                order = trainer.rng.permutation(len(units))
                for at in range(0, len(order), BATCH):
                    pick = order[at: at + BATCH]
                    trainer.step(tops[pick], one[pick], two[pick], inner[pick], within[pick])
        if trainer.tokens:
            rows, uses = trainer.m.rows(), trainer.uses + 1e-3
            cuts = range(0, len(rows), UNITS_A_ROW)
            blocks = [-1, *range(len(cuts))]
            weights = [np.array([trainer.tokens], float).tobytes(), *(uses[c: c + UNITS_A_ROW].tobytes() for c in cuts)]
            values = [trainer.m.D.ravel().tobytes(), *(rows[c: c + UNITS_A_ROW].tobytes() for c in cuts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(weights, pa.binary()), pa.array(values, pa.binary())], names=["block", "uses", "rows"])

    def average(parts: pa.Table) -> pa.Table:
        total = weight = 0.0
        for uses, rows in zip(parts.column("uses"), parts.column("rows")):
            uses = np.frombuffer(uses.as_py())[:, None]
            total = total + uses * np.frombuffer(rows.as_py(), np.float32).reshape(len(uses), -1)
            weight = weight + uses
        rows = (total / weight).astype(np.float32).tobytes()
        return pa.table({"block": parts.column("block")[:1], "rows": pa.array([rows], pa.binary())})

    trained = docs.select(text_col).coalesce(MOST_TRAINERS).mapInArrow(released(fit), "block long, uses binary, rows binary")
    means = {r["block"]: r["rows"] for r in trained.groupBy("block").applyInArrow(average, "block long, rows binary").collect()}
    if not means:
        return initial
    rows = np.frombuffer(b"".join(means[k] for k in range(len(means) - 1)), np.float32).reshape(-1, 2 * WIDTH + 1)
    return Model(rows[:, :WIDTH].copy(), np.frombuffer(means[-1], np.float32).reshape(2, WIDTH),
                 rows[:-1, WIDTH:-1].copy(), rows[:-1, -1].copy(), initial.size)


# --- the operator ---------------------------------------------------------------------------------

def score_rows(docs: DataFrame, words: Vocabulary, model: Model, id_col: str, text_col: str) -> DataFrame:
    """``id, n_tokens, n_known, base, score, rare``: sums over units and carried tokens; ``rare`` lists
    the other tokens, whose log10(count + SMOOTH) both sums still lack."""

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, start = len(words.frequency), len(model.b)
        logs = np.log10(words.carried_counts + SMOOTH)
        for part in parts:
            for row, data, offsets in text_blocks(part.column(1), BLOCK):
                tokens, classes, first = tokens_of(data, offsets)
                units = words.units(tokens, classes)
                tops = words.tops(units)
                one, two = contexts(units, tops, first, start)
                pairs, back = np.unique(one * (size + 1) + np.minimum(two, size), return_inverse=True)
                chance, order = np.zeros(len(units)), np.argsort(back, kind="stable")
                before = pairs % (size + 1)
                before = np.where(before == size, start, before)
                chance[order] = model.log_chosen(pairs // (size + 1), before, slice(0, size), back[order], tops[order])
                within, inner = words.inner_targets(units, tops)
                order = np.argsort(within, kind="stable")
                edges = np.searchsorted(within[order], np.arange(CLASSES + 1))
                for k in np.flatnonzero(np.diff(edges)):
                    own = slice(size + words.starts[k], size + words.starts[k + 1])
                    columns = np.append(np.arange(own.start, own.stop), size + len(words.members) + k)
                    pick = order[edges[k]: edges[k + 1]]
                    place = np.where(inner[pick] >= size + len(words.members), len(columns) - 1, inner[pick] - own.start)
                    chance[pick] += model.log_chosen(one[pick], two[pick], columns, np.arange(len(pick)), place)
                chance /= math.log(10)
                place = np.minimum(np.searchsorted(words.carried, tokens), max(len(words.carried) - 1, 0))
                known = words.carried[place] == tokens if len(words.carried) else np.zeros(len(tokens), bool)
                log_count = np.where(known, logs[place], 0.0) if len(logs) else np.zeros(len(tokens))
                shared = (units >= len(words.words)) & (units < size)
                chance += np.where(shared, log_count - words.rest_log[np.clip(units - len(words.words), 0, CLASSES - 1)], 0.0)
                base = log_count - math.log10(words.total + SMOOTH * (words.distinct + 1))
                n = np.diff(first)
                rare = ~known
                met = known & (words.carried_counts[place] > 0)
                sums = [np.add.reduceat(v, first[:-1]) for v in (base, chance, met.astype(np.int64))]
                ends = np.concatenate([[0], np.cumsum(np.add.reduceat(rare.astype(np.int64), first[:-1]))])
                rows = slice(row, row + len(n))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)[rows], pa.array(n), pa.array(sums[2]), pa.array(sums[0]), pa.array(sums[1]),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(tokens[rare].view(np.int64)))],
                    names=["id", "n_tokens", "n_known", "base", "score", "rare"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(
        released(score), "id long, n_tokens long, n_known long, base double, score double, rare array<long>")


def score_documents(docs: DataFrame, folds: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Learns from rows outside fold 0 only. Scores are log10 probabilities of the whole text, its end token
    included; a null text is an empty one. ``base_score`` is the smoothed unigram score. Repeated
    rows score alike. Without training rows all counts are 0.
    """
    docs = docs.select(id_col, text_col)
    training = docs.where(~held_out(id_col, folds))
    counts = materialize(count_tokens(training, text_col), "counts")
    words = build_vocabulary(counts)
    model = train(training, words, text_col)
    scored = materialize(score_rows(docs, words, model, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.where(F.size("rare") > 0).select("row", F.explode("rare").alias("token"))
    log_count = F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH))
    added = (rare.join(counts.select("token", "n"), "token", "left").groupBy("row")
             .agg(F.sum(log_count).alias("more"), F.count("n").alias("found")))
    more = F.coalesce("more", F.lit(0.0))
    return scored.drop("rare").join(added, "row", "left").select(
        F.col("id").alias(id_col), held_out("id", folds).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"))
