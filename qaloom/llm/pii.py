"""Personal data: pattern spans plus those of a character-level bidirectional LSTM with CRF transitions.

The model is trained in numpy on windows whose labels are the pattern spans of the corpus itself.
It reads overlapping windows, decodes each with Viterbi, and the decodings are reconciled over the whole
text: every character takes its tag from the window in which it stands furthest from an edge.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.llm.common import free_name, release_memory, released
from qaloom.session import materialize

KINDS = ("email", "ip", "card", "phone")
# Every kind holds a digit or an "@": windows without either hold no span and are not decoded.
CUE = re.compile(r"[0-9@]")
WINDOW, STRIDE = 64, 32
# Training windows, smallest hashes first: with spans, and without.
MOST_POSITIVE, MOST_NEGATIVE = 2400, 1200
# Windows decoded together: some 10 MB of arrays.
DECODED = 256

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TWICE = str.maketrans("0123456789", "".join(str(sum(divmod(2 * d, 10))) for d in range(10)))


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(map(int, digits[-2::-2].translate(_TWICE)))
    return total % 10 == 0


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by pattern, by kind as listed in KINDS, then by start. Linear in the text's length.

    The e-mail pattern is searched from each "@", and the address pattern only where a run of
    digits begins: the matches are those of a plain left-to-right search.
    """
    found: list[tuple[str, int, int]] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            end = match.end()
            found.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    if re.search("[0-9]", text):
        found += [("ip", m.start(), m.end()) for m in IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        for m in CARD.finditer(text):
            digits = digits_of(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return found


# --- windows ------------------------------------------------------------------------------------

def code_points(text: str) -> np.ndarray:
    """Characters as small ids: ASCII as they are, all others 127."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 127).astype(np.int16)


def cue_windows(codes: np.ndarray) -> np.ndarray:
    """Numbers of the windows [STRIDE k, STRIDE k + WINDOW) that hold a cue, ascending."""
    cues = np.flatnonzero(((codes >= 48) & (codes <= 57)) | (codes == 64)) // STRIDE
    found = np.unique(np.concatenate([cues, cues - 1]))
    return found[found >= 0] if len(codes) > STRIDE else found[found == 0]


def window_codes(codes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    padded = np.concatenate([codes, np.zeros(WINDOW, np.int16)])
    return padded[np.minimum(numbers[:, None] * STRIDE + np.arange(WINDOW), len(padded) - 1)]


def tag_codes(size: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    """0 outside, 1 + 2k where a span of kind k begins, 2 + 2k inside it; earlier kinds win overlaps."""
    tags = np.zeros(size, np.int8)
    for kind, start, end in spans:
        if not tags[start:end].any():
            k = KINDS.index(kind)
            tags[start], tags[start + 1: end] = 1 + 2 * k, 2 + 2 * k
    return tags


# --- model ----------------------------------------------------------------------------------------

TAGS = 1 + 2 * len(KINDS)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


@dataclass
class Tagger:
    """Parameters by name; ``f``/``b`` are the forward and the backward reader."""

    p: dict[str, np.ndarray]
    hidden: int

    @staticmethod
    def new(seed: int = 1, embed: int = 12, hidden: int = 16) -> Tagger:
        rng = np.random.default_rng(seed)
        p = {"E": rng.normal(0, 0.5, (128, embed)), "O": rng.normal(0, 0.2, (2 * hidden, TAGS)), "o": np.zeros(TAGS), "T": np.zeros((TAGS, TAGS))}
        for side in "fb":
            p["W" + side] = rng.normal(0, 1 / np.sqrt(embed), (embed, 4 * hidden))
            p["U" + side] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden)) * 0.7
            p["c" + side] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
        return Tagger({k: v.astype(np.float32) for k, v in p.items()}, hidden)

    def read(self, x: np.ndarray, side: str, keep: bool = True) -> dict:
        """LSTM over time-major embeddings ``x`` (steps, rows, embed); keeps what training needs, or the outputs only."""
        h, steps, rows = self.hidden, *x.shape[:2]
        pre = x @ self.p["W" + side] + self.p["c" + side]
        state, cell = np.zeros((rows, h), np.float32), np.zeros((rows, h), np.float32)
        kept = {k: np.zeros((steps, rows, w), np.float32) for k, w in (("gates", 4 * h), ("cell", h), ("tanh", h), ("out", h)) if keep or k == "out"}
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = pre[t] + state @ self.p["U" + side]
            z[:, : 3 * h] = _sigmoid(z[:, : 3 * h])
            z[:, 3 * h:] = np.tanh(z[:, 3 * h:])
            cell = z[:, h: 2 * h] * cell + z[:, :h] * z[:, 3 * h:]
            squashed = np.tanh(cell)
            state = z[:, 2 * h: 3 * h] * squashed
            kept["out"][t] = state
            if keep:
                kept["gates"][t], kept["cell"][t], kept["tanh"][t] = z, cell, squashed
        return kept

    def emissions(self, codes: np.ndarray, keep: bool = True) -> tuple[np.ndarray, dict]:
        x = self.p["E"][codes.T]
        sides = {s: self.read(x, s, keep) for s in "fb"}
        both = np.concatenate([sides["f"]["out"], sides["b"]["out"]], -1)
        return both @ self.p["O"] + self.p["o"], {"x": x, "both": both, **sides}

    def back(self, kept: dict, x: np.ndarray, d_out: np.ndarray, side: str, grads: dict) -> np.ndarray:
        h, steps = self.hidden, len(x)
        order = range(steps - 1, -1, -1) if side == "f" else range(steps)
        prior = -1 if side == "f" else 1
        d_pre = np.zeros_like(kept["gates"])
        d_state, d_cell = 0.0, 0.0
        for t in order:
            z, before = kept["gates"][t], t + prior
            inside = 0 <= before < steps
            d_h = d_out[t] + d_state
            d_c = d_cell + d_h * z[:, 2 * h: 3 * h] * (1 - kept["tanh"][t] ** 2)
            old = kept["cell"][before] if inside else 0.0
            d = d_pre[t]
            d[:, :h] = d_c * z[:, 3 * h:] * z[:, :h] * (1 - z[:, :h])
            d[:, h: 2 * h] = d_c * old * z[:, h: 2 * h] * (1 - z[:, h: 2 * h])
            d[:, 2 * h: 3 * h] = d_h * kept["tanh"][t] * z[:, 2 * h: 3 * h] * (1 - z[:, 2 * h: 3 * h])
            d[:, 3 * h:] = d_c * z[:, :h] * (1 - z[:, 3 * h:] ** 2)
            if inside:
                grads["U" + side] += kept["out"][before].T @ d
            d_state, d_cell = d @ self.p["U" + side].T, d_c * z[:, h: 2 * h]
        flat = d_pre.reshape(-1, 4 * h)
        grads["W" + side] += x.reshape(-1, x.shape[-1]).T @ flat
        grads["c" + side] += flat.sum(0)
        return d_pre @ self.p["W" + side].T

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the tag sequences under the CRF, and its gradients."""
        scores, kept = self.emissions(codes)
        scores, t_matrix = scores.astype(np.float64), self.p["T"].astype(np.float64)
        steps, rows = scores.shape[:2]
        alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
        alpha[0] = scores[0]
        for t in range(1, steps):
            alpha[t] = scores[t] + _lse(alpha[t - 1][:, :, None] + t_matrix, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _lse(t_matrix + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _lse(alpha[-1], 1)
        gold, r = tags.T.astype(int), np.arange(rows)
        path = scores[np.arange(steps)[:, None], r, gold].sum(0) + t_matrix[gold[:-1], gold[1:]].sum(0)
        d_scores = np.exp(alpha + beta - total[None, :, None])
        d_scores[np.arange(steps)[:, None], r, gold] -= 1
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        pair = np.zeros_like(t_matrix)
        for t in range(1, steps):
            pair += np.exp(alpha[t - 1][:, :, None] + t_matrix + (scores[t] + beta[t])[:, None, :] - total[:, None, None]).sum(0)
        np.subtract.at(pair, (gold[:-1].ravel(), gold[1:].ravel()), 1)
        grads["T"] = (pair / rows).astype(np.float32)
        d = (d_scores / rows).astype(np.float32)
        grads["O"] = kept["both"].reshape(-1, 2 * self.hidden).T @ d.reshape(-1, TAGS)
        grads["o"] = d.sum((0, 1))
        d_both = d @ self.p["O"].T
        d_x = self.back(kept["f"], kept["x"], d_both[..., : self.hidden], "f", grads)
        d_x += self.back(kept["b"], kept["x"], d_both[..., self.hidden:], "b", grads)
        np.add.at(grads["E"], codes.T, d_x)
        return float((total - path).mean()), grads

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Best tag sequence of each window (Viterbi)."""
        scores, _ = self.emissions(codes, keep=False)
        steps, rows = scores.shape[:2]
        back, best = np.zeros(scores.shape, np.int8), scores[0]
        for t in range(1, steps):
            ways = best[:, :, None] + self.p["T"]
            back[t] = ways.argmax(1)
            best = scores[t] + ways.max(1)
        out = np.zeros((rows, steps), np.int8)
        out[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            out[:, t - 1] = back[t, np.arange(rows), out[:, t]]
        return out


def train(codes: np.ndarray, tags: np.ndarray, steps: int = 200, batch: int = 64, rate: float = 0.02, seed: int = 2) -> Tagger:
    """Adam on random batches of labelled windows, the rate falling to a tenth."""
    model, rng = Tagger.new(), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    s = {k: np.zeros_like(v) for k, v in model.p.items()}
    for t in range(1, steps + 1):
        pick = rng.integers(0, len(codes), min(batch, len(codes)))
        _, grads = model.gradients(codes[pick], tags[pick])
        now = rate * (1 - 0.9 * t / steps)
        for k, g in grads.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.99 * s[k] + 0.01 * g * g
            model.p[k] = model.p[k] - (now * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-6)).astype(np.float32)
    return model


# --- reconciliation -----------------------------------------------------------------------------------

def reconcile(size: int, numbers: np.ndarray, decoded: np.ndarray) -> np.ndarray:
    """One tag per character from overlapping windows: the window wins in which it is most central."""
    tags, depth = np.zeros(size, np.int8), np.full(size, -1, np.int16)
    central = np.minimum(np.arange(WINDOW), WINDOW - 1 - np.arange(WINDOW)).astype(np.int16)
    for number, row in zip(numbers, decoded):
        at = int(number) * STRIDE
        stop = min(at + WINDOW, size)
        own = central[: stop - at].copy()
        if at == 0:
            own[:STRIDE] = WINDOW
        better = own > depth[at:stop]
        tags[at:stop][better] = row[: stop - at][better]
        depth[at:stop][better] = own[better]
    return tags


def model_spans(text: str, tags: np.ndarray) -> list[tuple[str, int, int]]:
    """Runs of one kind that hold what the kind cannot do without; white space at the ends is cut."""
    kinds = (tags + 1) // 2
    begins = np.flatnonzero((kinds > 0) & (np.concatenate([[True], (kinds[1:] != kinds[:-1]) | (tags[1:] % 2 == 1)])))
    spans = []
    for start in begins:
        end = start + 1
        while end < len(tags) and kinds[end] == kinds[start] and tags[end] % 2 == 0:
            end += 1
        piece = text[start:end]
        lead = len(piece) - len(piece.lstrip())
        piece, kind, first = piece.strip(), KINDS[kinds[start] - 1], int(start) + lead
        digits = digits_of(piece)
        whole = {"email": "@" in piece[1:-1] and "." in piece, "ip": piece.count(".") >= 3 and len(digits) >= 4,
                 "card": 12 <= len(digits) <= 19, "phone": 7 <= len(digits) <= 15}[kind]
        if whole:
            spans.append((kind, first, first + len(piece)))
    return spans


def all_spans(text: str, base: list[tuple[str, int, int]], added: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Pattern spans, and model spans that touch none of them, by kind as listed, then by start."""
    covered = np.zeros(len(text), bool)
    for _, start, end in base:
        covered[start:end] = True
    more = [s for s in added if not covered[s[1]: s[2]].any()]
    return sorted({*base, *more}, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


# --- the operator -----------------------------------------------------------------------------------------

def labelled_windows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``codes, tags, spans``: every cue window of every text, labelled by pattern."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("codes", pa.binary()), ("tags", pa.binary())])
        for part in parts:
            codes, tags = [], []
            for text in part.column(0):
                text = text.as_py()
                if not text or not CUE.search(text):
                    continue
                points = code_points(text)
                labels = tag_codes(len(points), pattern_spans(text))
                numbers = cue_windows(points)
                codes += [row.astype(np.uint8).tobytes() for row in window_codes(points, numbers)]
                tags += [row.astype(np.uint8).tobytes() for row in window_codes(labels.astype(np.int16), numbers)]
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.binary()), pa.array(tags, pa.binary())], schema=schema)

    return docs.select(text_col).mapInArrow(released(cut), "codes binary, tags binary")


def fit(docs: DataFrame, text_col: str = "text", positive: int = MOST_POSITIVE, negative: int = MOST_NEGATIVE) -> Tagger | None:
    """A tagger trained on at most ``positive`` windows with spans and ``negative`` without.

    The sample is the distinct windows with the smallest hashes, a bounded table. None where the
    corpus holds no span to learn from.
    """
    windows = labelled_windows(docs, text_col).dropDuplicates(["codes", "tags"])
    windows = windows.withColumn("_spans", F.hex("tags").rlike("[1-9A-F]")).withColumn("_key", F.xxhash64("codes", "tags"))
    windows = materialize(windows, "windows")
    sample = [windows.where(F.col("_spans") == with_spans).orderBy("_key", "codes", "tags").limit(most).toArrow()
              for with_spans, most in ((True, positive), (False, negative))]
    if not sample[0].num_rows:
        return None
    codes, tags = (np.concatenate([np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint8) for t in sample]).reshape(-1, WINDOW)
                   for c in ("codes", "tags"))
    return train(codes.astype(np.int16), tags.astype(np.int8))


def find_spans(docs: DataFrame, model: Tagger | None, text_col: str = "text", name: str = "spans") -> DataFrame:
    """``docs`` plus ``name``: array of (kind, start, end, base), code points, end exclusive.

    ``base`` marks pattern spans; the others are the model's. Null and empty texts have none.
    """

    @F.arrow_udf("array<struct<kind: string, start: long, end: long, base: boolean>>")
    def spans(texts: pa.Array) -> pa.Array:
        held, queue = [], []
        for text in texts:
            text = text.as_py() or ""
            points = numbers = None
            if CUE.search(text) and model is not None:
                points = code_points(text)
                numbers = cue_windows(points)
                queue.append(window_codes(points, numbers))
            held.append((text, numbers))
        every = np.concatenate(queue) if queue else np.zeros((0, WINDOW), np.int16)
        decoded = [model.decode(every[k: k + DECODED]) for k in range(0, len(every), DECODED)]
        decoded = np.concatenate(decoded) if decoded else np.zeros((0, WINDOW), np.int8)
        rows, at = [], 0
        for text, numbers in held:
            base = pattern_spans(text) if CUE.search(text) else []
            added = []
            if numbers is not None:
                tags = reconcile(len(text), numbers, decoded[at: at + len(numbers)])
                added, at = model_spans(text, tags), at + len(numbers)
            known = set(base)
            rows.append([{"kind": k, "start": s, "end": e, "base": (k, s, e) in known} for k, s, e in all_spans(text, base, added)])
        release_memory()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        return pa.array(rows, kind)

    return docs.withColumn(name, spans(F.col(text_col)))


def redact(docs: DataFrame, model: Tagger | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets. Null texts stay null; clean texts stay as they are."""
    name = free_name(docs, "found_spans")
    marked = find_spans(docs, model, text_col, name)

    @F.arrow_udf("string")
    def cover(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts.to_pylist(), spans.to_pylist()):
            pieces, end = [], 0
            for s in sorted(found or [], key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= end:
                    pieces += [text[end: s["start"]], f"[{s['kind'].upper()}]"]
                end = max(end, s["end"])
            out.append(text if not pieces else "".join(pieces) + text[end:])
        return pa.array(out, pa.string())

    return marked.withColumn(text_col, cover(F.col(text_col), F.col(name))).drop(name)
