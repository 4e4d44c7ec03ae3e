"""Page layout: blocks around figures, figure spans, page markdown.

Block frames hold ``doc, ord, type, text, img_path, img_caption, page_idx``, one row per
block in reading order ``ord``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.functions.text import has_text
from qaloom.session import positions

PAGE_BUCKET = 64
# Blocks that stand together when a page is spread, and over how many parts it is.
STRETCH, WINDOW_SALTS = 256, 16
# Characters of a text that the automaton holds; the rest is compared where they occur.
KEY_CHARS = 64

# Characters that cannot occur in markdown stand in for image links while they are replaced.
_OPEN, _CLOSE = "\u0001", "\u0002"


def page_range_filter(blocks: DataFrame, ranges: DataFrame) -> DataFrame:
    """Blocks within one page of any of their document's ranges.

    ``ranges`` holds ``doc`` and ``pages ARRAY<STRUCT<start, end>>``. Both sides meet on
    (doc, run of pages), so a document that dominates the data is spread over its pages.
    """
    reach = (
        ranges.select("doc", F.explode("pages").alias("r"))
        .select("doc", (F.col("r.start") - 1).alias("_from"), (F.col("r.end") + 1).alias("_to"))
        .filter("_to >= greatest(_from, 0)")
        .select(
            F.col("doc").alias("_doc"),
            "_from",
            "_to",
            F.explode(
                F.sequence(
                    F.expr(f"cast(greatest(_from, 0) div {PAGE_BUCKET} as int)"),
                    F.expr(f"cast(_to div {PAGE_BUCKET} as int)"),
                )
            ).alias("_bucket"),
        )
    )
    placed = blocks.withColumn("_page_bucket", F.expr(f"cast(page_idx div {PAGE_BUCKET} as int)"))
    inside = (
        (F.col("doc") == F.col("_doc"))
        & (F.col("_page_bucket") == F.col("_bucket"))
        & F.col("page_idx").between(F.col("_from"), F.col("_to"))
    )
    return placed.join(reach, inside, "left_semi").drop("_page_bucket")


def block_texts() -> Column:
    """What a block contributes to a window: its text, or its link and captions."""
    link = F.concat(F.lit("![]("), F.col("img_path"), F.lit(")"))
    captions = F.coalesce(F.col("img_caption"), F.array().cast("array<string>"))
    return F.when(F.col("type") == "image", F.concat(F.array(link), captions)).otherwise(
        F.array(F.col("text"))
    )


def window_pieces(blocks: DataFrame) -> DataFrame:
    """``doc, page, ord, sub, text``: what stands on each page that has an image and on the pages beside it.

    The window of an image is that of its page: the rows of (doc, page) by (ord, sub). A block is copied to
    the at most three windows it is in, and nothing is gathered. Rows meet the pages with images on (doc, page, salt),
    so a page with a third of all blocks is spread.
    """
    salt = F.expr(f"cast(pmod(ord div {STRETCH}, {WINDOW_SALTS}) as int)")
    pieces = (
        blocks.filter((F.col("type") == "image") | F.col("text").isNotNull())
        .filter("page_idx >= 0")
        .select("doc", "ord", "page_idx", salt.alias("_salt"), F.posexplode(block_texts()).alias("sub", "text"))
        .withColumn("page", F.explode(F.sequence(F.col("page_idx") - 1, F.col("page_idx") + 1)))
    )
    pages = blocks.filter("type = 'image'").select("doc", F.col("page_idx").alias("page")).distinct()
    salted = pages.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(WINDOW_SALTS - 1))))
    return pieces.join(salted, ["doc", "page", "_salt"], "left_semi").select("doc", "page", "ord", "sub", "text")


def page_window(blocks: DataFrame) -> DataFrame:
    """Per image, the texts of the blocks on its page and the two beside it, in reading order.

    The view with one row an image on ``window_pieces``: a window is put together once per page, and all images of
    the page take it from there.
    """
    in_order = F.sort_array(F.collect_list(F.struct("ord", "sub", "text")))
    windows = window_pieces(blocks).groupBy("doc", "page").agg(F.transform(in_order, lambda p: p["text"]).alias("blocks"))
    images = blocks.filter("type = 'image'").select("doc", "ord", "img_path", "img_caption", "page_idx")
    return images.join(windows.withColumnRenamed("page", "page_idx"), ["doc", "page_idx"]).select(
        "doc", "ord", "img_path", "img_caption", "page_idx", "blocks")


def page_slices(markdown: str, pieces: list[tuple[int, str]], pages: list[int]) -> list[str]:
    """For each page, the stretch of ``markdown`` that the pieces (page, text) in its window span.

    All places are found in two passes over the markdown with one automaton, whatever the number of pages: first
    places, which fix where windows start, then the places at or behind a start that the first one precedes.
    """
    import ahocorasick

    texts: dict[str, int] = {}
    by_page: dict[int, list[int]] = {}
    for n, (page, _) in enumerate(pieces):
        by_page.setdefault(page, []).append(n)
    number = [texts.setdefault(t, len(texts)) if t else -1 for _, t in pieces]
    names = list(texts)

    def places(wanted: list[int]):
        """(text, place) of every occurrence of the texts, by the end of their first KEY_CHARS characters."""
        keys: dict[str, list[int]] = {}
        for k in wanted:
            keys.setdefault(names[k][:KEY_CHARS], []).append(k)
        automaton = ahocorasick.Automaton()
        for key, found in keys.items():
            automaton.add_word(key, (len(key), found))
        if keys and markdown:
            automaton.make_automaton()
            for end, (size, found) in automaton.iter(markdown):
                place = end + 1 - size
                for k in found:
                    if len(names[k]) <= size or markdown.startswith(names[k], place):
                        yield k, place

    first = [-1] * len(names)
    for k, place in places(list(range(len(names)))):
        if first[k] < 0 or place < first[k]:
            first[k] = place
    starts, ends, waiting = [], [], {}
    for n, page in enumerate(pages):
        window = sorted(x for p in range(max(page - 1, 0), page + 2) for x in by_page.get(p, ()))
        used = list(dict.fromkeys(number[x] for x in window if number[x] >= 0 and first[number[x]] >= 0))
        starts.append(first[used[0]] if used else 0)
        ends.append(0)
        for k in used:
            if first[k] >= starts[n]:
                ends[n] = max(ends[n], first[k] + len(names[k]))
            else:
                waiting.setdefault(k, []).append((starts[n], n))
    for asked in waiting.values():
        asked.sort(reverse=True)
    for k, place in places(list(waiting)):
        asked = waiting[k]
        while asked and asked[-1][0] <= place:
            n = asked.pop()[1]
            ends[n] = max(ends[n], place + len(names[k]))
    return [markdown[a:b] for a, b in zip(starts, ends)]


def markdown_slice(blocks: DataFrame, markdown: DataFrame) -> DataFrame:
    """Per image, the stretch of the document's markdown that the blocks in its window span, as ``md_content``.

    It runs from the first window block found in ``markdown`` (``doc, markdown``) to the
    furthest end of any block found from there on; '' when none is found. Windows are those of ``page_window``,
    one a page. A document's blocks come together once, beside its markdown, which is one cell already and as
    large; the work is linear in its length and does not grow with the number of images.
    """
    held = blocks.filter((F.col("type") == "image") | F.col("text").isNotNull()).select(
        "doc", F.struct("ord", "page_idx", block_texts().alias("texts"), (F.col("type") == "image").alias("image")).alias("_block"))
    gathered = held.groupBy("doc").agg(F.sort_array(F.collect_list("_block")).alias("blocks")).filter(
        F.exists("blocks", lambda b: b["image"])).join(markdown.select("doc", "markdown"), "doc")
    kind = blocks.schema["doc"].dataType.simpleString()

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in range(part.num_rows):
                one = part.slice(row, 1)
                found = one.column("blocks")[0].as_py()
                pieces = [(b["page_idx"], t) for b in found if b["page_idx"] is not None for t in b["texts"] or ()]
                pages = sorted({b["page_idx"] for b in found if b["image"] and b["page_idx"] is not None})
                slices = page_slices(one.column("markdown")[0].as_py() or "", pieces, pages)
                docs = one.column("doc").take(pa.array([0] * len(pages)))
                yield pa.RecordBatch.from_arrays([docs, pa.array(pages, pa.int32()), pa.array(slices, pa.string())], names=["doc", "page_idx", "md_content"])

    slices = gathered.select("doc", "blocks", "markdown").mapInArrow(cut, f"doc {kind}, page_idx int, md_content string")
    images = blocks.filter("type = 'image' AND page_idx IS NOT NULL").select("doc", "ord", "img_path", "img_caption", "page_idx")
    return images.join(slices, ["doc", "page_idx"], "left").select(
        "doc", "ord", "img_path", "img_caption", "page_idx", F.coalesce("md_content", F.lit("")).alias("md_content"))


def mark_images(df: DataFrame, col: str = "md_content", path: str = "img_path") -> DataFrame:
    """Replace the link to the row's own image by <image>, every other image link by <irrelevant>."""
    links = F.regexp_replace(col, r"!\[.*?\]\((.*?)\)", f"{_OPEN}$1{_CLOSE}")
    own = F.concat(F.lit(_OPEN), F.col(path), F.lit(_CLOSE))
    marked = F.replace(links, own, F.lit("<image>"))
    return df.withColumn(col, F.regexp_replace(marked, f"{_OPEN}[^{_CLOSE}]*{_CLOSE}", "<irrelevant>"))


def figure_span(blocks: DataFrame) -> DataFrame:
    """Per document, from the page of its first captioned image to the page of its last image."""
    image = "type = 'image'"
    return (
        blocks.groupBy("doc")
        .agg(
            F.expr(f"min_by(page_idx, ord) FILTER (WHERE {image} AND size(img_caption) > 0)").alias("start_page"),
            F.expr(f"max_by(page_idx, ord) FILTER (WHERE {image})").alias("end_page"),
        )
        .filter("start_page IS NOT NULL AND end_page IS NOT NULL")
    )


def _page_texts(pages: DataFrame) -> DataFrame:
    """``doc, page_num, text``: each page as markdown."""
    heading = F.concat(F.lit("## Page "), F.col("page_num").cast("string"), F.lit("\n"))
    body = F.when(has_text(F.coalesce(F.col("text"), F.lit(""))), F.array("text", F.lit("\n"))).otherwise(
        F.array().cast("array<string>")
    )
    links = F.transform(
        F.coalesce("images", F.array().cast("array<string>")),
        lambda i: F.concat(F.lit("![Image](< image >) <!-- "), i, F.lit(" -->\n")),
    )
    return pages.select("doc", "page_num", F.array_join(F.flatten(F.array(F.array(heading), body, links)), "\n").alias("text"))


def _title(doc: str = "doc") -> Column:
    return F.concat(F.lit("# "), F.col(doc).cast("string"), F.lit("\n\n"))


def page_markdown(pages: DataFrame) -> DataFrame:
    """``doc, page_num, text, at``: the pages of ``pages_to_markdown`` with the characters before each, title included.

    The long form, for documents whose markdown should not sit in one cell; rows are never gathered by document.
    """
    placed = positions(_page_texts(pages), "doc", "page_num", "text", at=F.char_length("text") + 1)
    return placed.withColumn("at", F.col("at") + F.char_length(_title()))


def pages_to_markdown(pages: DataFrame) -> DataFrame:
    """Documents as markdown, one row each, from page rows (``doc, page_num, text, images``)."""
    return (
        _page_texts(pages)
        .groupBy("doc")
        .agg(F.expr("listagg(text, '\n') WITHIN GROUP (ORDER BY page_num)").alias("_body"))
        .select("doc", F.concat(_title(), "_body").alias("markdown"))
    )


def image_listing(pages: DataFrame) -> DataFrame:
    """Per-page image inventory from page rows (``doc, page_num, images`` of relative paths)."""
    return pages.select(
        "doc",
        "page_num",
        F.size("images").alias("image_count"),
        F.posexplode("images").alias("img_index", "relative_path"),
    ).withColumn("img_name", F.substring_index("relative_path", "/", -1))
