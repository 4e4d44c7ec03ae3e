"""Word-aligned id files, alignment of two tokenizations and the conversation trie, against brute force."""

import bisect
import collections
import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qaloom.llm import alignment, simple8b, zfast
from qaloom.llm.queries import QUERIES
from rows import CLASH, documents, frame

WORD_JSON = public_tokenizers.path("word_bpe_49k.json")
BYTE_JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["two  spaces", " leading", "trailing ", "a <|endoftext|> b <s> <0x41> <|startoftext|>c", "▁lower ▁block", "ﬁ ligature", "日本語 text ½ 😀é",
       "don't we'll 123,456.78", "x" * 21000, "tab\there\r\nline\n\n end", "İstanbul ΣΑΣ", "́combining é", "\x00nul", "12345678901234567890" * 8]
ROWS = documents() + [(5000 + k, t) for k, t in enumerate(ODD)]


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).cache()


def same(got, want):
    assert collections.Counter(got) == collections.Counter(want)


# --- word-aligned coding ---

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60000), st.integers(0, 2**64 - 1), st.just(0)), max_size=3000), st.integers(0, 250))
def test_coding_round_trip(values, zeros):
    ids = np.array(values + [0] * zeros + values[:5], np.uint64)
    words, word_at, escape_at, limits, escapes = simple8b.encode(ids)
    assert (simple8b.decode(words, limits, escapes) == ids).all()
    assert len(word_at) == len(limits) == -(-len(ids) // simple8b.BLOCK)


def test_ids_too_wide_for_a_word_are_escaped():
    ids = np.full(1024, 5, np.uint64)
    ids[100] = 2**60
    words, *_, escapes = simple8b.encode(ids)
    assert escapes.tolist() == [2**60] and len(words) <= 1024 // 15 + 2
    ids[100] = 2**60 - 1
    assert not len(simple8b.encode(ids)[4])


def test_segments_decode_by_range():
    ids = np.random.default_rng(2).integers(0, 49408, 5000).astype(np.uint64)
    ids[[7, 3000]] = 2**63
    data = simple8b.pack_segment([9, None], [4000, 1000], ids) + b"\n" + simple8b.pack_segment([], [], ids[:0]) + b"\n"
    first, last = simple8b.segments(data)
    assert (first.doc_ids.tolist(), first.known.tolist(), first.ends.tolist(), last.n_ids) == ([9, 0], [1, 0], [4000, 5000], 0)
    for a, b in ((0, 5000), (1023, 1025), (1024, 2048), (2999, 3001), (4999, 5000), (4, 4)):
        assert (first.ids(a, b) == ids[a:b]).all()


def test_long_documents_are_encoded_in_runs(monkeypatch):
    monkeypatch.setattr(simple8b, "SEGMENT_IDS", 2048)
    ids = np.random.default_rng(3).integers(0, 300, 9000).astype(np.uint64)
    ids[::500] = 2**61
    segment = next(simple8b.segments(simple8b.pack_segment([1], [9000], ids) + b"\n"))
    assert (segment.ids(0, 9000) == ids).all() and (segment.ids(4095, 8193) == ids[4095:8193]).all()


@pytest.mark.parametrize("small", [False, True])
def test_id_files(spark, docs, tmp_path, monkeypatch, small):
    from tokenizers import Tokenizer

    if small:
        monkeypatch.setattr(simple8b, "SEGMENT_IDS", 1024)
        monkeypatch.setattr(simple8b, "SEGMENTS_PER_FILE", 2)
        monkeypatch.setattr(simple8b, "KEPT_PIECES", 50)
    path = str(tmp_path / "ids")
    simple8b.write_ids(docs, path, WORD_JSON, 1, by_word=True, partitions=5)
    got = simple8b.read_ids(spark, path, keep_ids=True).collect()
    tokenizer = Tokenizer.from_file(WORD_JSON)
    want = [(key, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids) + (1,)) for key, text in ROWS]
    same([(r.doc_id, tuple(r.ids)) for r in got], want)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    in_order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert in_order == sorted(in_order, key=lambda k: (k is not None, k or 0))
    if small:
        assert spark.read.parquet(f"{path}/files").count() > 5


def test_id_files_of_nothing(spark, docs, tmp_path):
    simple8b.write_ids(docs.where("false"), str(tmp_path / "none"), WORD_JSON, 1)
    assert simple8b.read_ids(spark, str(tmp_path / "none")).count() == 0


# --- alignment ---

def by_hand(texts):
    """Rows of (n_a, n_b, n_groups, n_links, n_best, count_sum, sha) by sets and dictionaries."""
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(BYTE_JSON)
    slow.encode_special_tokens = True
    first, second = alignment.BytePieces(BYTE_JSON, RANKS), alignment.SentencePieces(MODEL)
    info, links = [], []
    for text in texts:
        text = text or ""
        a = slow.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text).tolist() if text else []
        whole = (" " + text).encode()
        if not text or b"".join(first.pieces[x] for x in a) != whole or b"".join(second.pieces[x] for x in b) != whole:
            info.append((0, 0, 0, ""))
            links.append(collections.Counter())
            continue
        ends = [list(itertools.accumulate(len(side.pieces[x]) for x in ids)) for side, ids in ((first, a), (second, b))]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        sides = [[[] for _ in cuts] for _ in (a, b)]
        for side, ids, at in zip(sides, (a, b), ends):
            for x, e in zip(ids, at):
                side[bisect.bisect_left(cuts, e)].append(x)
        links.append(collections.Counter((x, y) for g in range(len(cuts)) for x in sides[0][g] for y in sides[1][g]))
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in zip(*sides))
        info.append((len(a), len(b), len(cuts), hashlib.sha256(shown.encode()).hexdigest()))
    count = collections.Counter(p for c in links for p in c)
    best = collections.Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [(*i[:3], sum(c.values()), sum(n for p, n in c.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in c.items()), i[3])
            for i, c in zip(info, links)]


@pytest.mark.parametrize("small", [False, True])
def test_alignment(docs, monkeypatch, small):
    if small:
        for name, value in (("BLOCK_BYTES", 500), ("WIDE_GROUP", 2), ("HELD_PAIRS", 64)):
            monkeypatch.setattr(alignment, name, value)
    got = alignment.align_documents(docs, BYTE_JSON, RANKS, MODEL)
    want = by_hand([t for _, t in ROWS])
    same([tuple(r) for r in got.collect()], [(key, *w) for (key, _), w in zip(ROWS, want)])
    assert sum(w[0] == 0 for w in want) >= 5  # nulls, empty texts and texts that a vocabulary does not give back


def test_alignment_of_nothing(docs):
    assert alignment.align_documents(docs.where("false"), BYTE_JSON, RANKS, MODEL).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60), max_size=40), st.sets(st.integers(1, 60), max_size=40), st.booleans())
def test_group_ends(a, b, long):
    a, b = sorted(a | {61}), sorted(b | {61})
    if long:  # a stretch of one-to-one ends on a shifted diagonal
        a, b = a + list(range(62, 200)), b + list(range(62, 200))
    ends_a, ends_b = alignment.group_ends(np.array(a), np.array(b))
    both = sorted(set(a) & set(b))
    assert ends_a.tolist() == [a.index(x) + 1 for x in both] and ends_b.tolist() == [b.index(x) + 1 for x in both]


# --- conversation trie ---

def trie_by_hand(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), text))
    turns = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(turns.get(c - c % 5, [])[:h] + turns[c][h:])
    members = collections.defaultdict(list)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += children[k] == 0
    return [(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
             hashlib.sha256(",".join(map(str, sorted(c for c in m if rebuilt[c] == k))).encode()).hexdigest()) for k, m in members.items()]


def conversations(seed=5):
    rng = random.Random(seed)
    rows = []
    for c in range(0, 400):
        if c % 5 == 0 and rng.random() < 0.3:
            continue  # nothing to lend
        kind = rng.random()
        length = rng.randrange(1, 30) if kind < 0.9 else 120
        # Few distinct turns, so paths branch deep; a third of all are one conversation.
        texts = ["hello é"] * 20 if kind < 0.35 else [rng.choice(["a", "bb", "", "ccc"]) for _ in range(length)]
        rows += [(c, t, "user" if t % 2 else None, x) for t, x in enumerate(texts)]
    rows += [(None, 1, "user", "x"), (7, None, "user", None), (8, None, None, None), (8, None, None, None), (9, 3, "user", "tie"), (9, 3, "user", "eit"),
             (100001, 0, None, None), (2**40, 1, "assistant", "far")]
    return rows


def as_frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    return df.select("*", *[F.lit(v).alias(k) for k, v in {**CLASH, "node": 1, "path": "p", "depth": 3, "digest": "d", "at": 5, "place": 6}.items()])


@pytest.mark.parametrize("small", [False, True])
def test_conversation_trie(spark, monkeypatch, small):
    if small:  # many tries, many pieces of one node's ids
        monkeypatch.setattr(zfast, "TRIE_TURNS", 40)
        monkeypatch.setattr(zfast, "PIECE_CHARS", 30)
    rows = conversations()
    same([tuple(r) for r in zfast.conversation_trie(as_frame(spark, rows)).collect()], trie_by_hand(rows))


def test_trie_of_nothing(spark):
    assert zfast.conversation_trie(as_frame(spark, conversations()).where("false")).count() == 0


def test_trie_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same([tuple(r) for r in QUERIES["op13_zfast_conversation_trie"](spark, sf_dir).collect()], trie_by_hand(rows))


def chained(turns):
    last, steps = zfast.ROOT, []
    for t in turns:
        last = hashlib.md5(last + bytes([t])).digest()
        steps.append(last)
    return b"".join(steps)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), min_size=1, max_size=40), st.integers(1, 7))
def test_fat_search_finds_the_exit(paths, batch):
    trie = zfast.ZFastTrie()
    distinct = sorted({tuple(p) for p in paths}, key=lambda p: hashlib.md5(bytes(p)).digest())
    for at in range(0, len(distinct), batch):
        trie.insert_batch([(chained(p), np.ones(len(p), "<i8"), 1, at + k, at + k) for k, p in enumerate(distinct[at: at + batch])])
    assert all(trie.handles[n.digest(zfast.two_fattest(n.low, n.depth))] is n for n in set(map(id, trie.handles.values())) and trie.handles.values())
    for p in distinct:
        node = trie.exit_node(chained(p))
        assert node.low < len(p) <= node.depth or not p
    prefixes = {p[:d] for p in distinct for d in range(len(p) + 1)}
    rows = list(trie.expanded())
    assert len(rows) == len(prefixes)
    count = {r[0]: (r[4], r[9]) for r in rows}
    for p in prefixes:
        want = (sum(q[: len(p)] == p for q in distinct), sum(len(q) == len(p) + 1 and q[: len(p)] == p for q in prefixes))
        assert count[chained(p)[-16:] if p else zfast.ROOT] == want


@pytest.mark.parametrize("low,high,want", [(0, 1, 1), (0, 7, 4), (4, 7, 6), (6, 7, 7), (2, 4, 4), (8, 11, 10)])
def test_two_fattest(low, high, want):
    assert zfast.two_fattest(low, high) == want
