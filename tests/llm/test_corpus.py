"""Every operator against brute force on small documents with odd rows, and on empty tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from qaloom.llm import decontamination, fmindex, jaccard, lm, packing, pii, repeats, sharding, suffixes, topk, toxicity
from qaloom.llm import queries as corpus_queries
from rows import WORDS, documents, frame

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
ROWS = documents()
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, ROWS).where("false")


def same(got, want):
    assert collections.Counter(got) == collections.Counter(want)


# --- packing ---

def test_encoders_agree():
    quick, slow = packing.encoder(JSON, RANKS), packing.encoder(JSON)
    for text in [t or "" for _, t in ROWS] + ["<|endoftext|> a", "a" * 25000, " " * 25000, "it's 'LL 1234 ½ \r\n\t x"]:
        assert quick(text) == slow(text)


def test_pack_round_trip(docs):
    packed = packing.pack_documents(docs, JSON, RANKS, max_tokens=256, keep_ids=True).cache()
    rows, encode = packed.collect(), packing.encoder(JSON)
    found = collections.defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length <= 256
        found[r.sequence_id].append(r)
    for pieces in found.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    want = collections.Counter()
    for key, text in ROWS:
        ids = tuple(encode(text or "")) + (0,)
        want[key, len(ids)] += 1
    whole = collections.Counter()
    for r in rows:
        whole[r.doc_id] += r.length
    assert sum(whole.values()) == sum(n * k for (_, n), k in want.items())
    assert len(found) <= -(-sum(whole.values()) // 256) * 1.05 + 1
    tokens = {r.sequence_id: r.tokens for r in packing.assemble(packed).collect()}
    for key, pieces in found.items():
        assert tokens[key] == [i for r in sorted(pieces, key=lambda r: r.offset) for i in r.ids]


@pytest.mark.parametrize("seed", range(4))
def test_plan_covers_every_piece(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.choice([rng.integers(1, 65, 500), np.full(500, 40), rng.integers(30, 65, 500)][seed % 3], 400)
    counts = np.bincount(lengths, minlength=65)
    plan = packing.plan_packing(counts, 64)
    used = np.zeros(plan.sequences, int)
    for v in np.flatnonzero(counts):
        rank = np.arange(counts[v])
        k = np.searchsorted(plan.keys, (int(v) << 44) + rank, "right") - 1
        np.add.at(used, plan.first[k] + (rank - plan.starts[k]) // plan.copies[k], v)
    assert used.max() <= 64 and used.sum() == (counts * np.arange(65)).sum()
    assert plan.sequences <= packing_first_fit(lengths, 64)


def packing_first_fit(lengths, room):
    free = []
    for v in sorted(lengths, reverse=True):
        k = next((k for k, f in enumerate(free) if f >= v), None)
        if k is None:
            free.append(room - v)
        else:
            free[k] -= v
    return len(free)


# --- top-k ---

def vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(k, [float(x) for x in rng.normal(0, 0.2, 20)]) for k in range(300)]
    rows += [(k, rows[7][1]) for k in range(300, 340)]  # ties
    rows += [(400, None), (500, []), (600, [1.0, None]), (700, [float("nan")] * 20), (800, [float("inf")] * 20), (900, rows[7][1][:3])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).repartition(4)


def test_top_k_is_exact(spark):
    rows, frame_ = vectors(spark)
    usable = topk.usable_vectors(frame_, 1024)
    clean = {}
    for k, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            clean[k] = np.array([math.floor(1024 * float(np.float32(x))) for x in v] + [0] * (20 - len(v)))
    want = []
    for q in clean:
        if q % 100 == 0:
            best = sorted((-int(clean[q] @ v), k) for k, v in clean.items() if k != q)[:10]
            want += [(q, rank + 1, k, -s) for rank, (s, k) in enumerate(best)]
    for block in (4096, 2):
        same([tuple(r) for r in topk.top_k(usable, usable.where("vec_id % 100 = 0"), 10, block).collect()], want)
    assert topk.top_k(usable.where("false"), usable.where("false")).collect() == []


# --- sharding ---

def test_interleaving(spark, docs, empty):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 > 0, (F.col("id") % 5).cast("string")).alias("source"))
    rows = rows.union(rows.limit(5))
    got = sharding.interleave(rows, 16).collect()
    assert len(got) == 1005
    sizes = collections.Counter(r.shard for r in got)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    same([(r.shard, r.slot) for r in got], [(s, k) for s, n in sizes.items() for k in range(n)])
    share = collections.Counter(r.source for r in got)
    for (shard, source), n in collections.Counter((r.shard, r.source) for r in got).items():
        assert abs(n - share[source] / 16) <= 2
    assert sharding.interleave(docs, 4, stratum="key").count() == len(ROWS)
    assert sharding.interleave(empty, 4, stratum="key").collect() == []


# --- personal data ---

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


@pytest.mark.parametrize("text", ["a@b.c@d.e x@y", "@@a@b-.c..d", "1.2.3.4.5.6.7.8", "0001.255.0.256", "9" * 5000 + ".1.1.1", "é a@b.cc", "%%@a.b" * 3])
def test_patterns_as_plain_search(text):
    found = pii.pattern_spans(text)
    assert [s[1:] for s in found if s[0] == "email"] == [m.span() for m in EMAIL.finditer(text)]
    ok = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m.group().split("."))]
    assert [s[1:] for s in found if s[0] == "ip"] == ok


def test_card_and_phone():
    text = ROWS[39][1] if "card" in (ROWS[39][1] or "") else next(t for _, t in ROWS if t and "card" in t)
    assert [(k, text[a:b]) for k, a, b in pii.pattern_spans(text)] == [
        ("email", "a.b@c.de"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 123-4567")]


def private_texts(n, seed):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        w = list(rng.choice(WORDS, 30))
        w[5] = f"{w[1]}.{rng.integers(99)}@mail{rng.integers(9)}.example.com"
        w[12] = ".".join(str(x) for x in rng.integers(1, 255, 4))
        w[20] = f"+1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}"
        w[26] = str(rng.integers(1900, 2030))
        out.append(" ".join(w))
    return out


def test_tagger_learns_and_base_stays(spark, docs, empty):
    train = spark.createDataFrame([(t,) for t in private_texts(250, 1)], "text string")
    model = pii.fit(train)
    found = right = total = 0
    for text in private_texts(40, 2):
        points = pii.code_points(text)
        numbers = pii.cue_windows(points)
        got = set(pii.model_spans(text, pii.reconcile(len(text), numbers, model.decode(pii.window_codes(points, numbers)))))
        want = set(pii.pattern_spans(text))
        found, right, total = found + len(got), right + len(got & want), total + len(want)
    assert right / total > 0.85 and right / found > 0.85
    rows = pii.find_spans(docs.drop("spans"), model).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert [(s.kind, s.start, s.end) for s in r.spans if s.base] == pii.pattern_spans(r.text or "")
    clean = {r.doc_id: r.text for r in pii.redact(docs, model).collect()}
    assert "[EMAIL]" in str(clean) and "@" not in str(clean) and clean[0] is None
    assert pii.redact(docs, model).columns == docs.columns
    assert pii.fit(empty) is None and pii.redact(empty, None).collect() == []


def test_tagger_gradients():
    model = pii.Tagger.new(3, embed=3, hidden=2)
    rng = np.random.default_rng(0)
    codes, tags = rng.integers(0, 128, (2, 6)).astype(np.int16), rng.integers(0, 9, (2, 6)).astype(np.int8)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    _, grads = model.gradients(codes, tags)
    for name in ("Wf", "Ub", "O", "T", "cf"):
        at = tuple(0 for _ in model.p[name].shape)
        old, step = model.p[name][at], 1e-2
        losses = []
        for v in (old + step, old - step):
            model.p[name][at] = v
            losses.append(model.gradients(codes, tags)[0])
        model.p[name][at] = old
        assert abs((losses[0] - losses[1]) / (2 * step) - grads[name][at]) < 5e-3


# --- repeated substrings ---

def covered(units, window, seen):
    cover = [False] * len(units)
    for k in range(len(units) - window + 1):
        if seen[tuple(units[k: k + window])] > 1:
            cover[k: k + window] = [True] * window
    return cover


def runs_of(cover):
    return sum(c and (k == 0 or not cover[k - 1]) for k, c in enumerate(cover))


@pytest.mark.parametrize("most", [20_000, 2])
def test_suffix_dedup(docs, empty, monkeypatch, most):
    monkeypatch.setattr(suffixes, "MOST_TOGETHER", most)
    shape = repeats.Shape(window=60, gram=12, grid=20)
    texts = [(key, (t or "").encode()) for key, t in ROWS]
    seen = collections.Counter(tuple(b[k: k + 60]) for _, b in texts for k in range(len(b) - 59))
    want = []
    for key, b in texts:
        cover = covered(b, 60, seen)
        want.append((key, len(b), sum(cover), runs_of(cover), bytes(c for c, x in zip(b, cover) if not x)))
    got = suffixes.remove_repeats(docs, shape).collect()
    same([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got], want)
    assert suffixes.remove_repeats(empty, shape).collect() == []


@pytest.mark.parametrize("most", [20_000, 2])
def test_fm_dedup(docs, empty, monkeypatch, most):
    monkeypatch.setattr(fmindex, "MOST_TOGETHER", most)
    shape = repeats.Shape(window=9, gram=3, grid=4)
    texts = [(key, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for key, t in ROWS]
    seen = collections.Counter(tuple(w[k: k + 9]) for _, w in texts for k in range(len(w) - 8))
    want = []
    for key, w in texts:
        cover = covered(w, 9, seen)
        want.append((key, len(w), sum(cover), " ".join(x for x, c in zip(w, cover) if not c).encode()))
    got = fmindex.remove_repeats(docs, shape).collect()
    same([(r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in got], want)
    assert fmindex.remove_repeats(empty, shape).collect() == []


@pytest.mark.parametrize("most", [50, 10_000])
def test_chunks_of_a_common_core_stay_where_they_are(spark, most):
    rows = [(1, k % 3, k, 0, 0, 5) for k in range(400)] + [(2, 7, k, 9, 0, 5) for k in range(2)] + [(3, 8, 1, 30, 0, 5)]
    found = spark.createDataFrame(rows, "core long, context long, key long, start long, lead short, count short").repartition(8)
    setting = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(setting)
    spark.conf.set(setting, "-1")  # as for tables too large to broadcast
    try:
        kept, contexts = repeats.repeated_chunks(found, most)
    finally:
        spark.conf.set(setting, usual)
    same([tuple(r) for r in kept.select(*repeats.CHUNK_COLUMNS).collect()], [r for r in rows if r[0] != 3])
    same([(r.core, r.context, r.times) for r in contexts.collect()], [(1, 0, 134), (1, 1, 133), (1, 2, 133), (2, 7, 2)])
    files = kept.where("core = 1").select(F.input_file_name().alias("f")).distinct().count()
    assert files == (8 if most == 50 else 1)  # a file is a task


def test_common_cores_change_no_result(docs, monkeypatch):
    shape = repeats.Shape(window=60, gram=12, grid=20)
    before = [str(r) for r in suffixes.remove_repeats(docs, shape).collect()]
    monkeypatch.setattr(suffixes, "MOST_OF_A_CORE", 2)
    same([str(r) for r in suffixes.remove_repeats(docs, shape).collect()], before)


def test_planted_passages_by_op5s_contract(spark, tmp_path):
    # Of passages with 51 words or more, those of 400 bytes go and those of 399 stay, and clean texts stay whole.
    rng = np.random.default_rng(5)
    fresh = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(n))
    short, long = fresh(57), fresh(57) + "."
    assert len(short) == 398 and len(long) == 399
    rows = []
    for k, passage in enumerate([short + "!", long + "!"] * 2):
        rows.append((k, f"{fresh(80)}{'<>[]'[k]}{passage}{'{}()'[k]}{fresh(40)}"))
    rows += [(k, fresh(150)) for k in range(4, 8)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in corpus_queries.QUERIES["op5_columnwise_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert {k: r.n_removed for k, r in got.items()} == {0: 0, 1: 400, 2: 0, 3: 400, 4: 0, 5: 0, 6: 0, 7: 0}
    for k, text in rows:
        assert got[k].n_bytes == len(text)
        assert got[k].kept_sha256 == hashlib.sha256(text.replace(long + "!", "").encode()).hexdigest()


def test_long_rows_are_cut_without_loss(monkeypatch):
    values = np.random.default_rng(0).integers(0, 4, 5000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    shape = repeats.Shape(window=30, gram=6, grid=10)
    whole = repeats.chunks(values, np.array([0, 5000]), shape)
    monkeypatch.setattr(repeats, "_PLACE", 1023)
    monkeypatch.setattr(repeats, "_MOST", 500)
    cut = repeats.chunks(values, np.array([0, 5000]), shape)
    assert whole[3].sum() == cut[3].sum() == 5000 - 29
    starts = lambda c: sorted(s + k for s, n in zip(c[1], c[3]) for k in range(n))
    assert starts(whole) == starts(cut)


def test_wavelet_rank():
    symbols = np.random.default_rng(1).integers(0, 37, 1000)
    tree = fmindex.WaveletTree(symbols, 37)
    for c in (0, 5, 36):
        at = np.arange(0, 1001, 50)
        assert (tree.rank(np.full(len(at), c), at) == [(symbols[:k] == c).sum() for k in at]).all()


# --- toxicity ---

def test_toxicity_held_out(spark, docs, empty):
    rng = np.random.default_rng(4)
    bad = ["vileone", "grubby", "rotten", "vileish", "grubbing", "rottenest"]
    rows, labels = [], []
    for k in range(1500):
        words, toxic = list(rng.choice(WORDS, 40)), k % 8 == 0
        if toxic:
            for at in rng.choice(40, 4, replace=False):
                words[at] = str(rng.choice(bad))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    rows += [(None, None), (5000, ""), rows[3]]
    labels += [(None, 1, 1), (6000, None, None), labels[3]]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    classifier = toxicity.fit(texts, marks)
    got = {r.doc_id: r.score for r in toxicity.score_texts(texts, classifier).collect()}
    held = [k for k in range(1500) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([(got[k] >= 0.5) == (k % 8 == 0) for k in held]) > 0.97
    assert got[None] < 0.5 and got[5000] < 0.5
    assert toxicity.score_texts(docs.drop("score"), classifier).count() == len(ROWS)
    blank = toxicity.fit(empty, marks.where("false"))
    assert all(0 <= r.score < 0.5 for r in toxicity.score_texts(docs.drop("score"), blank).collect())


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    y = rng.random(40000) < 0.2
    votes = np.stack([np.where(y, rng.random(40000) < p, rng.random(40000) < 0.02) for p in (0.9, 0.7, 0.6, 0.8, 0.5)] , 1)
    votes = np.concatenate([votes, (votes[:, :1] | (rng.random((40000, 1)) < 0.01))], 1).astype(int)
    model = toxicity.fit_label_model(40000, votes.sum(0), votes.T @ votes, 0.2)
    assert (5, 0) in model.correlated
    assert model.yes[0] > 0 > model.no[0] and model.posterior(0b011111) > 0.95 and model.posterior(0) < 0.05


# --- language model ---

def test_language_model(docs, empty):
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + [None]
    training = [t for k, t in ROWS if k is None or zlib.crc32(str(k).encode()) % 10]
    c = collections.Counter(w for t in training for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = [(k, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + .1) / (n + .1 * (v + 1))) for w in tokens(t)), 5)) for k, t in ROWS]
    for carried in (1_000_000, 10):
        old, lm.MOST_CARRIED = lm.MOST_CARRIED, carried
        got = lm.score_documents(docs).collect()
        lm.MOST_CARRIED = old
        same([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got], want)
    assert all(r.score < 0 for r in got)
    assert lm.score_documents(empty).collect() == []


def test_language_model_is_normalised():
    rng = np.random.default_rng(0)
    model = lm.Model.new(np.full(40, 1 / 40))
    trainer = lm.Trainer(model, np.full(40, 1 / 40), 1)
    one = rng.integers(0, 40, 4000)
    for _ in range(60):
        trainer.step((one * 7 + 1) % 40, one, np.zeros(4000, int))
    table = model.log_probabilities(np.arange(40), np.zeros(40, int))
    assert np.allclose(np.exp(table).sum(1), 1, atol=1e-4)
    assert np.exp(table[np.arange(40), (np.arange(40) * 7 + 1) % 40]).mean() > 0.2


def test_members_of_classes_are_normalised_and_learnt(spark, monkeypatch):
    """Two tokens of one class, each always after one word: the member step must tell them apart."""
    monkeypatch.setattr(lm, "WORDS", 2)
    rows = [(k, " ".join(["xx aab xx yy aac yy"] * 60)) for k in range(999)] + [(1000, "aax qr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    words = lm.build_vocabulary(lm.count_tokens(docs, "text").cache())
    members = {int(h): int(u) for h, u in zip(words.members, words.member_units)}
    assert len(words.words) == 3 and len(members) == 2 and words.starts[-1] == 2
    model = lm.train(docs, words, "text")
    data = np.frombuffer(b"xx aab yy aac aax", np.uint8)
    tokens, classes, first = lm.tokens_of(data, np.array([0, len(data)]))
    units = words.units(tokens, classes)
    tops = words.tops(units)
    assert [int(t) in members for t in tokens] == [False, True, False, True, False, False]
    assert tops[1] == tops[3] == tops[4] == units[4] and units[1] != units[3]
    within, inner = words.inner_targets(units, tops)
    assert list(within >= 0) == [False, True, False, True, True, False]
    k = within[1]
    columns = np.append(np.arange(words.starts[k], words.starts[k + 1]) + len(words.frequency), len(words.frequency) + 2 + k)
    assert inner[4] == columns[-1]
    one, two = lm.contexts(units, tops, first, len(model.b))
    inside = np.exp(model.log_probabilities(one, two, columns))
    assert np.allclose(inside.sum(1), 1, atol=1e-4) and np.allclose(np.exp(model.log_probabilities(one, two)).sum(1), 1, atol=1e-4)
    assert inside[1, list(columns).index(units[1])] > 0.8 and inside[3, list(columns).index(units[3])] > 0.8
    # A text's score is the sum over its tokens of both steps and, in a rest, the token's share.
    got = {r.doc_id: r for r in lm.score_rows(docs, words, model, "doc_id", "text").withColumnRenamed("id", "doc_id").collect()}[1000]
    tokens, classes, first = lm.tokens_of(np.frombuffer(b"aax qr", np.uint8), np.array([0, 6]))
    units = words.units(tokens, classes)
    tops = words.tops(units)
    one, two = lm.contexts(units, tops, first, len(model.b))
    want = model.log_probabilities(one, two)[np.arange(3), tops].sum() + model.log_probabilities(one[:1], two[:1], columns)[0, -1]
    want = want / np.log(10) + sum(np.log10(1 + lm.SMOOTH) - words.rest_log[k] for k in tops[:2] - len(words.words))
    assert got.rare == [] and got.score == pytest.approx(want, abs=1e-4)


def test_more_text_gives_more_members(spark):
    def members(size):
        """Words of frequencies size, size / 2, size / 3, ..."""
        texts = [(f"w{k:04} " * (size // k),) for k in range(1, size + 1)]
        return len(lm.build_vocabulary(lm.count_tokens(spark.createDataFrame(texts, "text string"), "text")).members)

    old, lm.WORDS = lm.WORDS, 5
    found = [members(size) for size in (100, 1000, 4000)]
    lm.WORDS = old
    assert 0 < found[0] < found[1] < found[2]


# --- decontamination ---

def bench_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def test_decontamination(spark, docs, empty):
    items = [(1, " ".join(bench_words(ROWS[12][1])[:25])), (2, "Two, words"), (3, None), (4, ""), (10, ROWS[33][1]), (None, "one"), (5, "absent words here"), (2, "two words")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1))
    windows = collections.defaultdict(set)
    for key, t in items:
        w = bench_words(t)
        for k in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[k: k + 10])].add(key)
    want = []
    for key, t in ROWS:
        w, hit, found = bench_words(t), set(), set()
        for g, owners in windows.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k: k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    found |= owners
        want.append((key, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    got = decontamination.contamination(docs, bench).collect()
    same([(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got], want)
    clean = decontamination.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    same([(r.doc_id, r.text) for r in clean.collect()], [(k, t) for (k, t), w in zip(ROWS, want) if not w[2]])
    assert decontamination.contamination(empty, bench).collect() == []
    assert decontamination.contamination(docs, bench.where("false")).where("n_hit > 0").collect() == []


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "aa bb cc dd ee ff gg hh ii jj"), (2, "aa bb x cc dd ee y ff gg hh ii jj"), (3, "jj aa")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "aa bb cc dd ee ff gg hh ii jj")], "item_id long, text string")
    windows, _ = decontamination.windows_of(items)
    index = decontamination.build_index(docs, windows.select(F.explode("words").alias("word")))
    ids = index.documents.select("key", "doc_id")
    near = decontamination.proximity_matches(index, windows, slop=2, share=0.8).join(ids, "key")
    assert {r.doc_id for r in near.collect()} == {1, 2}
    assert {r.doc_id for r in decontamination.phrases(index, windows).join(ids, "key").collect()} == {1}


def test_proximity_without_the_rarest_terms(spark):
    phrase = "aa bb cc dd ee ff gg hh ii jj".split()
    texts = ["k aa bb cc dd XX ee ff gg hh ii", "aa bb qq dd ee ff gg hh ii jj", "aa bb qq dd ee rr gg hh ii jj", "aa qq cc rr ee ss gg hh ii jj",
             "bb qq dd ee ff gg hh ii jj", "n aa bb cc x dd ee ff gg y y y hh ii jj", "aa bb dd cc ee ff gg ii hh jj", "jj ii hh gg", "aa aa aa"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for lacks in ("zz", "cc"):  # a word the corpus lacks, and a rare one
        items = [phrase[:2] + [lacks] + phrase[3:], ["aa", "bb"], ["jj"]]
        windows, _ = decontamination.windows_of(spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string"))
        index = decontamination.build_index(docs, windows.select(F.explode("words").alias("word")))
        want = []
        for key, t in enumerate(texts):
            w = bench_words(t)
            for g in items:
                for start in range(-12, len(w) + 3):
                    shifts = [min([abs(s) for s in (-2, -1, 0, 1, 2) if 0 <= start + o + s < len(w) and w[start + o + s] == x], default=None) for o, x in enumerate(g)]
                    held = [s for s in shifts if s is not None]
                    if len(held) >= math.ceil(len(g) * 0.8) and 0 in held:
                        want.append((key, " ".join(g), start, len(held)))
        assert {1, 2, 4} <= {w[0] for w in want if len(w[1]) > 9}
        near = decontamination.proximity_matches(index, windows).join(index.documents, "key").join(windows, "window")
        same([(r.doc_id, " ".join(r.words), r.start, r.matched) for r in near.collect()], want)


# --- Jaccard ---

@pytest.mark.parametrize("frequent,block,family", [(64, 512, 8192), (2, 3, 8192), (2, 3, 4)])
def test_jaccard_components(docs, empty, monkeypatch, frequent, block, family):
    for name, value in (("FREQUENT", frequent), ("BLOCK_ROWS", block), ("MOST_FAMILY", family)):
        monkeypatch.setattr(jaccard, name, value)
    sets = []
    for _, t in ROWS:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets.append({tuple(w[k: k + 4]) for k in range(max(len(w) - 3, 1))} if w else set())
    root = list(range(len(ROWS)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(sets)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= 85 * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = collections.defaultdict(list)
    for k in range(len(ROWS)):
        groups[find(k)].append(k)
    want = []
    for members in groups.values():
        ids = [ROWS[k][0] for k in members if ROWS[k][0] is not None]
        want += [(ROWS[k][0], len(sets[k]), min(ids) if ids else None) for k in members]
    got = jaccard.jaccard_components(docs).collect()
    same([(r.doc_id, r.n_shingles, r.component_id) for r in got], want)
    if frequent == 64:
        left = jaccard.one_of_each(docs)
        assert left.columns == docs.columns
        assert left.count() == sum(1 if sets[m[0]] else len(m) for m in groups.values())
        assert jaccard.jaccard_components(empty).collect() == [] and jaccard.one_of_each(empty).collect() == []


@pytest.mark.parametrize("family", [3, 8192])
def test_pair_of_short_columns_in_a_large_family(spark, monkeypatch, family):
    # One key a row never ties two, and hash order is the order of columns: only the product can find the pair.
    for name, value in (("FREQUENT", 2), ("MOST_FAMILY", family), ("KEYS", 1), ("MOST_FREQUENT_COLUMNS", 0)):
        monkeypatch.setattr(jaccard, name, value)
    words = [f"w{k}" for k in range(100)]
    text = "".join(words).encode()
    grams, _ = jaccard.sets_of(np.frombuffer(text, np.uint8), np.cumsum([0] + [len(w) for w in words]), 1)
    first = [words[k] for k in np.argsort(grams, kind="stable")]
    own, short, rest, last = first[:6], first[6:9], first[50:54], first[54:]
    # 7 of 13 words are shared; of the six prefix columns three are, and those stand in no other row.
    texts = [own[0::2] + short + rest, own[1::2] + short + rest]
    # Rows that make the first words of both long columns, and tie both rows into one family.
    texts += [[own[0], own[1]] + last[k * 8: k * 8 + 8] for k in range(5)]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = jaccard.jaccard_components(docs, size=1, percent=50).collect()
    same([(r.doc_id, r.n_shingles, r.component_id) for r in got], [(k, len(t), 0 if k == 1 else k) for k, t in enumerate(texts)])


def test_block_links_match_sets():
    rng = np.random.default_rng(0)
    sets = [np.unique(np.concatenate([np.arange(40), rng.integers(100, 112, k % 6)])) for k in range(40)]
    sizes = np.array([len(s) for s in sets])
    a, b = jaccard.block_links(np.arange(40), np.arange(40), np.concatenate(sets), sizes, np.ones(40, bool), np.ones(40, bool), 95)
    for x, y in zip(a, b):
        o = len(np.intersect1d(sets[x], sets[y]))
        assert 100 * o >= 95 * (sizes[x] + sizes[y] - o)


def test_hashes_depend_on_content_only():
    from qaloom.llm.hashing import words_in

    data = np.frombuffer(b"ab  cd\tAB\x0bcd", np.uint8)
    starts, ends, h, first = words_in(data, np.array([0, len(data)]), lower=True)
    assert list(zip(starts, ends)) == [(0, 2), (4, 6), (7, 9), (10, 12)] and h[0] == h[2] and h[1] == h[3] and list(first) == [0, 4]
