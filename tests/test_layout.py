import pytest

from qaloom.operators import export, layout, parse

SCHEMA = "doc string, ord int, type string, text string, img_path string, img_caption array<string>, page_idx int"


def text(doc, ord, page, words):
    return (doc, ord, "text", words, None, None, page)


def image(doc, ord, page, path, captions=()):
    return (doc, ord, "image", None, path, list(captions), page)


@pytest.fixture(scope="module")
def blocks(spark):
    rows = [
        image("d", 0, 0, "i/first.png", ["cap A", "cap B"]), text("d", 1, 0, "alpha"), text("d", 2, 1, "beta"), text("d", 3, 2, "gamma"),
        image("d", 4, 3, "i/last.png"), text("d", 5, 3, "alpha"), text("e", 0, 0, "only"), image("e", 1, 5, "i/e.png"),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def windows(blocks):
    return {r.img_path: r.blocks for r in layout.page_window(blocks).collect()}


def test_windows_at_both_ends(blocks):
    got = windows(blocks)
    assert got["i/first.png"] == ["![](i/first.png)", "cap A", "cap B", "alpha", "beta"]
    assert got["i/last.png"] == ["gamma", "![](i/last.png)", "alpha"]
    assert got["i/e.png"] == ["![](i/e.png)"]


def test_figure_span(blocks):
    assert [tuple(r) for r in layout.figure_span(blocks).collect()] == [("d", 0, 3)]


def test_ranges_overlap_and_do_not_leak(spark, blocks):
    ranges = spark.createDataFrame([("d", [(0, 0), (1, 1)]), ("e", [(90, 200)])], "doc string, pages array<struct<start int, end int>>")
    kept = layout.page_range_filter(blocks, ranges)
    assert sorted((r.doc, r.ord) for r in kept.collect()) == [("d", 0), ("d", 1), ("d", 2), ("d", 3)]
    far = spark.createDataFrame([("e", [(6, 6)]), ("d", [(-9, -5)])], ranges.schema)
    assert [(r.doc, r.ord) for r in layout.page_range_filter(blocks, far).collect()] == [("e", 1)]


def slices(spark, blocks, markdown):
    md = spark.createDataFrame(list(markdown.items()), "doc string, markdown string")
    return {r.img_path: r.md_content for r in layout.markdown_slice(blocks, md).collect()}


def test_slices(spark, blocks, monkeypatch):
    md = "intro alpha beta gamma ![x](i/last.png) alpha outro ![](i/first.png)"
    got = slices(spark, blocks, {"d": md})
    # The first window's first block comes late, so only it is left to span.
    assert got["i/first.png"] == "![](i/first.png)"
    # Its own link is written with a label and so is not found; its text is.
    assert got["i/last.png"] == "gamma ![x](i/last.png) alpha"
    assert got["i/e.png"] == ""
    monkeypatch.setattr(layout, "KEY_CHARS", 2)
    assert slices(spark, blocks, {"d": md}) == got


def test_mark_images(spark):
    md = "a ![x](i/a+b(1).png) ![own](i/me.png) ![](i/other.png)"
    df = spark.createDataFrame([(md, "i/me.png"), ("none", "i/me.png"), ("![t](i\\E.png)", "i\\E.png")], "md_content string, img_path string")
    got = [r.md_content for r in layout.mark_images(df).collect()]
    assert got[1:] == ["none", "<image>"]
    assert got[0].endswith("<image> <irrelevant>") and got[0].startswith("a <irrelevant>")


def test_pages_to_markdown(spark):
    pages = spark.createDataFrame([("d", 1, "one", ["i/a.png"]), ("d", 2, " ", []), ("d", 3, None, None)], "doc string, page_num int, text string, images array<string>")
    want = "# d\n\n## Page 1\n\none\n\n\n![Image](< image >) <!-- i/a.png -->\n\n## Page 2\n\n## Page 3\n"
    assert layout.pages_to_markdown(pages).first().markdown == want
    many = spark.range(1, 5001).selectExpr("'m' AS doc", "CAST(id AS INT) AS page_num", "'t' AS text", "CAST(NULL AS array<string>) AS images")
    assert layout.pages_to_markdown(many).count() == 1


def test_markdown_of_pages_feeds_slices_once(spark):
    pages = spark.createDataFrame([("d", k, f"text {k}", []) for k in range(1, 7)], "doc string, page_num int, text string, images array<string>")
    blocks = spark.createDataFrame(
        [("d", 0, "text", "text 2", None, [], 1), ("d", 1, "image", None, "i/a.png", [], 1), ("d", 2, "text", "text 3", None, [], 2)],
        "doc string, ord int, type string, text string, img_path string, img_caption array<string>, page_idx int",
    )
    got = layout.markdown_slice(blocks, layout.pages_to_markdown(pages)).collect()
    assert len(got) == 1 and got[0].md_content.startswith("text 2") and got[0].md_content.endswith("text 3")


def test_image_listing(spark):
    pages = spark.createDataFrame([("d", 1, ["i/a.png", "i/b.png"]), ("d", 2, [])], "doc string, page_num int, images array<string>")
    got = [(r.page_num, r.image_count, r.img_index, r.img_name) for r in layout.image_listing(pages).collect()]
    assert got == [(1, 2, 0, "a.png"), (1, 2, 1, "b.png")]


def test_refusals_in_any_field(spark):
    df = spark.createDataFrame([("ok", ["x"], None), ("无法设计出问题", ["x"], None), ("ok", ["抱歉，无法设计出问题。"], "r")], "q string, choices array<string>, r string")
    assert parse.sentinel_reject(df).count() == 1


def test_clean_mixed(spark):
    fenced = '```json\n{"question": "new", "content": "over"}\n```'
    schema = "content string, image_path string, source_file string, text_content string, qa_pairs array<struct<question: string>>"
    df = spark.createDataFrame(
        [(fenced, "/x/a/b/c.png", None, None, None), ("no json", "/x/i.png", None, None, None), (fenced, None, "f", "t", None),
         (fenced, None, "g", None, [("old",)]), (None, None, None, None, None)],
        schema,
    )
    rows = parse.clean_mixed(df, "question string", "question string, content string").collect()
    got = sorted((r.image_path or "", r.source_file or "", r.question or "", (r.content or "")[:4], len(r.qa_pairs or [])) for r in rows)
    assert got == [("", "", "", "", 0), ("", "f", "new", "over", 0), ("", "g", "", "```j", 1), ("./a/b/c.png", "", "new", "", 0)]


def test_vlm_export(spark):
    df = spark.createDataFrame(
        [(1, "q", "1", "because", ["x", "y"], "./p/i.png"), (2, "q", "free", None, None, "/p/j.png")],
        "id int, question string, answer string, reasoning string, choices array<string>, image_path string",
    )
    rows = {r.id: r for r in export.export_vlm_chat(df).collect()}
    assert rows[1].images == "data/pdfs/p/i.png" and rows[2].images == "data/pdfs/p/j.png"
    assert rows[1].completions[0].content[0].text == "<thinking>\nbecause\n</thinking>\n<answer>\ny\n</answer>\n"
    assert rows[2].completions[0].content[0].text.endswith("<answer>\nfree\n</answer>\n")
    assert rows[1].prompt[0].role == "user" and rows[1].prompt[0].content[1].type == "image"
