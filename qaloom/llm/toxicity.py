"""Toxicity by weak supervision.

Many weak voters look at a text: word lexicons, word-beginning lexicons and style patterns. A generative
label model estimates from the voters' agreement over all training documents how accurate each is and
which are correlated, and turns votes into posterior labels. A linear classifier over words and word
beginnings learns those posteriors and scores every text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.llm.common import held_out, released
from qaloom.session import materialize

# Labelled rows (smallest id hashes first) that lexicons and the classifier are fitted on.
SAMPLE_ROWS = 12_000
# Word and word-beginning lexicons; a term goes to the next one in turn, so each spans all languages.
LEXICONS = 10
STEMS = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+")
SHOUT = re.compile(r"!{2,}|[A-ZÀ-Þ]{4,} [A-ZÀ-Þ]{4,}")


def terms_of(text: str) -> set[str]:
    """Distinct lower-case words, and word beginnings marked with a leading '^'."""
    words = set(WORD.findall(text.lower()))
    return words.union(*({"^" + w[:n] for w in words} for n in STEMS))


# --- voters -------------------------------------------------------------------------------------

@dataclass
class Voters:
    """Each voter says yes or no to a text. ``masks`` maps a term to the bits of voters it triggers."""

    masks: dict[str, int] = field(default_factory=dict)
    count: int = 2 * LEXICONS + 3

    def votes(self, text: str, terms: set[str]) -> int:
        hits = 0
        found = terms & self.masks.keys()
        for term in found:
            hits |= self.masks[term]
        if len(found) > 3:
            hits |= 1 << 2 * LEXICONS
        if SHOUT.search(text):
            hits |= 1 << 2 * LEXICONS + 1
        if text.count("!") * 40 > len(terms):
            hits |= 1 << 2 * LEXICONS + 2
        return hits


def build_voters(counts: dict[str, tuple[int, int]], bad: int, good: int, odds: float = 3.0) -> Voters:
    """Lexicons: terms whose log odds of the toxic class exceed ``odds``. ``counts``: (texts, toxic texts) of a term."""
    chosen = [(t, toxic) for t, (n, toxic) in counts.items()
              if toxic and math.log((toxic + 0.5) / (bad + 1)) - math.log((n - toxic + 0.5) / (good + 1)) > odds]
    voters = Voters()
    for kind in (0, 1):
        ranked = sorted(((t, n) for t, n in chosen if t.startswith("^") == bool(kind)), key=lambda x: (-x[1], x[0]))
        for k, (term, _) in enumerate(ranked):
            voters.masks[term] = 1 << (k % LEXICONS + kind * LEXICONS)
    return voters


# --- label model ----------------------------------------------------------------------------------

@dataclass
class LabelModel:
    """Class-conditional hit rates and, for correlated voters, discounts."""

    prior: float
    yes: np.ndarray  # log odds a hit adds
    no: np.ndarray  # log odds a miss adds
    correlated: list[tuple[int, int]]

    def posterior(self, votes: int) -> float:
        bits = np.array([votes >> i & 1 for i in range(len(self.yes))], bool)
        z = math.log(self.prior / (1 - self.prior)) + float(np.where(bits, self.yes, self.no).sum())
        return 1 / (1 + math.exp(-max(min(z, 30.0), -30.0)))


def fit_label_model(n: float, hits: np.ndarray, both: np.ndarray, prior: float) -> LabelModel:
    """Accuracies and correlations from counts of hits and of joint hits over ``n`` texts.

    Voters independent given the label have covariances prior (1 - prior) d_i d_j with d the
    difference of the class-conditional hit rates: one factor. It is first read off triples of voters
    (the median of c_ij c_ik / c_jk is robust against correlated pairs); pairs far off it are
    correlated beyond the label, are left out, and the factor is fitted again to the others.
    """
    v = len(hits)
    mean = hits / max(n, 1)
    covariance = both / max(n, 1) - np.outer(mean, mean)
    spread = prior * (1 - prior)
    scale = np.sqrt(np.outer(mean * (1 - mean), mean * (1 - mean))) + 1e-12
    others = ~np.eye(v, dtype=bool)
    factor = np.zeros(v)
    for i in range(v):
        c = covariance[i]
        j, k = np.triu_indices(v, 1)
        fit = (j != i) & (k != i) & (covariance[j, k] > 1e-3 * scale[j, k])
        j, k = j[fit], k[fit]
        factor[i] = math.sqrt(max(float(np.median(c[j] * c[k] / covariance[j, k])), 0.0)) if len(j) else 0.0
    off = np.abs(covariance - np.outer(factor, factor)) / scale
    limit = max(0.1, 3 * float(np.median(off[others]))) if v > 1 else 0.1
    use = (off <= limit) & others
    # Every voter keeps at least two partners to be judged by.
    use |= others & (use.sum(1) < 2)[:, None]
    for _ in range(200):
        weight = use * factor[None, :]
        factor = np.maximum((weight * covariance).sum(1) / np.maximum((weight * factor[None, :]).sum(1), 1e-12), 0)
    correlated = [(i, j) for i in range(v) for j in range(i) if not use[i, j]]
    difference = factor / math.sqrt(spread)
    one = np.clip(mean + (1 - prior) * difference, 1e-3, 1 - 1e-3)
    zero = np.clip(mean - prior * difference, 1e-4, 1 - 1e-3)
    one = np.maximum(one, zero)
    # Correlated voters repeat one another: their evidence is shared out.
    share = 1 / (1 + 0.5 * (~use & ~np.eye(v, dtype=bool)).sum(1))
    return LabelModel(prior, share * np.log(one / zero), share * np.log((1 - one) / (1 - zero)), correlated)


# --- linear classifier ------------------------------------------------------------------------------

def fit_linear(rows: np.ndarray, columns: np.ndarray, width: int, targets: np.ndarray, steps: int = 200,
               decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and intercept: logistic regression of soft targets on the terms (columns) of texts (rows),
    full-batch Adam."""
    n = len(targets)
    w, b = np.zeros(width), math.log((targets.mean() + 1e-3) / (1 - targets.mean() + 1e-3)) if n else 0.0
    m, s = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        z = np.bincount(rows, w[columns], n) + b
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - targets) / max(n, 1)
        gradient = np.append(np.bincount(columns, error[rows], width) + decay * w, error.sum())
        m, s = 0.9 * m + 0.1 * gradient, 0.999 * s + 0.001 * gradient**2
        move = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-10)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


# --- the operator -------------------------------------------------------------------------------------

@dataclass
class Classifier:
    weights: dict[str, float]
    bias: float
    label_model: LabelModel

    def score(self, text: str) -> float:
        terms = terms_of(text)
        z = self.bias + sum(map(self.weights.__getitem__, sorted(terms & self.weights.keys())))
        return 1 / (1 + math.exp(-max(min(z, 500.0), -500.0)))


def labelled_sample(docs: DataFrame, labels: DataFrame, folds: int, rows: int, id_col: str, text_col: str, label: str) -> DataFrame:
    """``id, text, label`` of at most ``rows`` labelled documents outside fold 0, smallest id hashes first.

    Conflicting labels of one id count as toxic; of a repeated id one text is taken. Only ids travel
    to find the sample; they are a bounded table, so the documents are not shuffled.
    """
    ids = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(id_col, folds))
           .groupBy(id_col).agg((F.max(label) == 1).cast("int").alias("_label"))
           .orderBy(F.xxhash64(id_col), id_col).limit(rows))
    found = docs.select(id_col, text_col).join(F.broadcast(ids), id_col)
    return materialize(found.groupBy(F.col(id_col).alias("id")).agg(
        F.min(F.coalesce(text_col, F.lit(""))).alias("text"), F.max("_label").alias("label")), "labelled")


def telling_terms(sample: DataFrame, bad: int, total: int, least: int = 4, chi_square: float = 15.0) -> dict[str, tuple[int, int]]:
    """(texts, toxic texts) of the terms whose presence depends on the label.

    Rare terms and those unrelated to the label are left out by Spark, so what comes back is a
    part of a bounded sample's words: with more terms than texts the fit would remember texts.
    """

    def terms(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for text, label in zip(part.column(0), part.column(1).to_pylist()):
                found = list(terms_of(text.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([label] * len(found), pa.int64())], names=["term", "toxic"])

    rate = min(max(bad / max(total, 1), 1e-6), 1 - 1e-6)
    counts = (sample.select("text", F.col("label").cast("long")).mapInArrow(released(terms), "term string, toxic long")
              .groupBy("term").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"))
              .where(F.col("n") >= least)
              .where(F.pow(F.col("toxic") - F.col("n") * rate, 2) > F.col("n") * (chi_square * rate * (1 - rate))))
    return {r["term"]: (r["n"], r["toxic"]) for r in counts.collect()}


def sample_features(sample: DataFrame, voters: Voters, index: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(votes of each text, rows, columns): the sample's known terms as sparse coordinates."""

    def features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            votes, columns = [], []
            for text in part.column(1):
                terms = terms_of(text.as_py())
                votes.append(voters.votes(text.as_py(), terms))
                columns.append(sorted(index[t] for t in terms & index.keys()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(votes, pa.int64()), pa.array(columns, pa.list_(pa.int32()))],
                                             names=["id", "votes", "columns"])

    found = sample.select("id", "text").mapInArrow(released(features), "id long, votes long, columns array<int>").orderBy("id").toArrow()
    columns = found.column("columns").combine_chunks()
    sizes = pa.compute.list_value_length(columns).to_numpy(zero_copy_only=False)
    return (found.column("votes").to_numpy(), np.repeat(np.arange(len(sizes)), sizes),
            columns.flatten().to_numpy(zero_copy_only=False))


def count_votes(docs: DataFrame, voters: Voters, text_col: str) -> tuple[float, np.ndarray, np.ndarray]:
    """Texts, hits and joint hits over all of ``docs``, summed by Spark to a fixed number of rows."""
    v = voters.count

    def partial(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joint, n = np.zeros((v, v), np.int64), 0
        for part in parts:
            bits = np.zeros((part.num_rows, v), np.int32)
            for row, text in enumerate(part.column(0)):
                text = text.as_py() or ""
                hits = voters.votes(text, terms_of(text))
                if hits:
                    bits[row] = [hits >> i & 1 for i in range(v)]
            joint += bits.T @ bits
            n += part.num_rows
        cells = np.append(joint.ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"])

    sums = docs.select(text_col).mapInArrow(released(partial), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(v * v + 1)
    for r in sums:
        cells[r["cell"]] = r["n"]
    joint = cells[:-1].reshape(v, v)
    return cells[-1], joint.diagonal().copy(), joint


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, sample_rows: int = SAMPLE_ROWS,
        id_col: str = "doc_id", text_col: str = "text", label: str = "toxic") -> Classifier:
    """Voters from a bounded labelled sample, label model from all training texts, classifier on its posteriors.

    Rows of fold 0 are never learnt from. Without labelled rows, or without toxic ones, there are no
    lexicons and every score is near the (smoothed) share of toxic labels.
    """
    sample = labelled_sample(docs, labels, folds, sample_rows, id_col, text_col, label)
    size = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad")).first()
    prior = (size["bad"] + 0.5) / (size["n"] + 2)
    counts = telling_terms(sample, size["bad"], size["n"])
    voters = build_voters(counts, max(size["bad"], 1), max(size["n"] - size["bad"], 1))
    n, hits, joint = count_votes(docs.where(~held_out(id_col, folds)), voters, text_col)
    model = fit_label_model(n, hits, joint, prior)
    if not size["n"]:
        return Classifier({}, math.log(prior / (1 - prior)), model)
    index = {t: k for k, t in enumerate(sorted(counts))}
    votes, rows, columns = sample_features(sample, voters, index)
    posterior = {v: model.posterior(v) for v in set(votes.tolist())}
    weights, bias = fit_linear(rows, columns, len(index), np.array([posterior[v] for v in votes.tolist()]))
    return Classifier({t: float(weights[k]) for t, k in index.items() if abs(weights[k]) > 1e-3}, bias, model)


def score_texts(docs: DataFrame, classifier: Classifier, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` plus ``name``: 0 to 1, higher is likelier toxic. Null texts score as empty ones."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([classifier.score(t.as_py() or "") for t in texts], pa.float64())

    return docs.withColumn(name, score(F.col(text_col)))
