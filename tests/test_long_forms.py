"""Long forms: places of pieces in merged texts, windows of pages, slices by one automaton; hot groups among them."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qaloom.operators import layout, merge
from qaloom.session import positions


def test_positions_over_many_ranges(spark):
    rng = random.Random(1)
    rows = [("hot", i, rng.randrange(50)) for i in range(4000)] + [(f"s{i % 300}", i, rng.randrange(50)) for i in range(2000)] + [(None, i, 1) for i in range(50)]
    want, total = {}, {}
    for segment, i, w in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        want[segment, i] = (total.get(segment, 0), total.get((segment, "n"), 0))
        total[segment] = total.get(segment, 0) + w
        total[segment, "n"] = total.get((segment, "n"), 0) + 1
    df = spark.createDataFrame(rows, "segment string, i int, w int").repartition(5)
    got = positions(df, "segment", "i", at=F.col("w"), rank=F.lit(1))
    assert got.columns == ["segment", "i", "w", "at", "rank"]
    assert {(r.segment, r.i): (r.at, r["rank"]) for r in got.collect()} == want
    assert positions(df.where("false"), "segment", "i", at=F.col("w")).count() == 0


def test_pieces_stand_where_the_merged_texts_have_them(spark):
    rng = random.Random(2)
    rows = [(f"s{i % 3}" if i < 900 else f"t{i}", i, "c" * rng.randrange(5) + str(i), None if i % 7 == 0 else "é" * rng.randrange(4)) for i in range(1000)]
    df = spark.createDataFrame(rows, "source_file string, chunk_index int, content string, text_content string").repartition(4)
    whole = {r.source_file: r for r in merge.merge_chunk_text(df).collect()}
    pieces = merge.chunk_texts(df).collect()
    assert len(pieces) == 1000
    for p in pieces:
        merged = whole[p.source_file]
        assert merged.content[p.content_at: p.content_at + len(p.content)] == p.content
        assert merged.full_text[p.text_at: p.text_at + len(p.text_content)] == p.text_content


def test_pages_stand_where_the_markdown_has_them(spark):
    rows = [("big" if k < 500 else f"d{k}", k, f"text {k}" if k % 3 else None, [f"i/{k}.png"] if k % 5 == 0 else None) for k in range(600)]
    pages = spark.createDataFrame(rows, "doc string, page_num int, text string, images array<string>").repartition(4)
    whole = {r.doc: r.markdown for r in layout.pages_to_markdown(pages).collect()}
    for r in layout.page_markdown(pages).collect():
        assert whole[r.doc][r["at"]: r["at"] + len(r.text)] == r.text


def test_merged_rows_gather_no_records(spark):
    schema = ("source_file string, chunk_index int, total_chunks int, qa_pairs array<struct<question string>>, key_concepts array<string>, "
              "technical_details struct<materials array<string>, parameters array<string>, methods array<string>>, main_findings array<string>")
    rows = [(None, i, 9, [(f"q{i}",)], ["k"] * 50, (["m"], [], None), None) for i in range(9)] + [("none", 0, 3, None, None, None, None)]
    got = {r.source_file: r for r in merge.merge_chunk_knowledge(spark.createDataFrame(rows, schema)).collect()}
    assert [p.question for p in got[None].qa_pairs] == [f"q{i}" for i in range(9)] and got[None].key_concepts == ["k"]
    assert got["none"].qa_pairs == [] and got["none"].technical_details.methods == []


BLOCKS = "doc string, ord int, type string, text string, img_path string, img_caption array<string>, page_idx int"


def test_a_page_with_most_blocks_is_spread(spark):
    rows = [("d", k, "text", f"t{k}", None, None, 7) for k in range(6000)] + [("d", 6000, "image", None, "i.png", ["cap", None], 7), ("d", 6001, "text", "after", None, None, 8)]
    rows += [("e", k, "text", "x", None, None, k) for k in range(1500)]  # no image: in no window
    pieces = layout.window_pieces(spark.createDataFrame(rows, BLOCKS).repartition(4))
    got = pieces.orderBy("ord", "sub").collect()
    assert [r.text for r in got] == [f"t{k}" for k in range(6000)] + ["![](i.png)", "cap", None, "after"] and {(r.doc, r.page) for r in got} == {("d", 7)}
    assert len({(r.ord // layout.STRETCH) % layout.WINDOW_SALTS for r in got}) == layout.WINDOW_SALTS


def slices_by_hand(markdown, pieces, pages):
    out = []
    for page in pages:
        window = [t for p, t in pieces if max(page - 1, 0) <= p <= page + 1 and t]
        start = next((markdown.find(t) for t in window if t in markdown), -1)
        rest = markdown[start:] if start >= 0 else ""
        out.append(rest[: max([rest.find(t) + len(t) for t in window if t in rest], default=0)])
    return out


@settings(max_examples=300, deadline=None)
@given(st.text("ab", max_size=40), st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.text("ab", max_size=4))), max_size=14), st.integers(1, 3))
def test_slices_by_one_automaton(markdown, pieces, key):
    kept, layout.KEY_CHARS = layout.KEY_CHARS, key
    try:
        assert layout.page_slices(markdown, pieces, [0, 1, 2, 3, 4]) == slices_by_hand(markdown, pieces, [0, 1, 2, 3, 4])
    finally:
        layout.KEY_CHARS = kept


@pytest.mark.parametrize("images", [5000])
def test_many_images_take_linear_time(images):
    rng = random.Random(3)

    def run(n):
        pieces = [(k // 3, f"{'paragraph' if k % 2 else '![](img)'} {k} " + "".join(rng.choice("abcd ") for _ in range(120))) for k in range(3 * n)]
        markdown = "\n\n".join(t for k, (_, t) in enumerate(pieces) if k % 11)
        begin = time.process_time()
        found = layout.page_slices(markdown, pieces, list(range(n)))
        assert all(found)
        return time.process_time() - begin

    run(200)
    few, many = run(images // 5), run(images)
    assert many < 15 * few + 0.5
