from hypothesis import given, settings
from hypothesis import strategies as st

from qaloom.operators.chunking import SEPARATORS, chunk_label, chunk_text, split_window


def pieces(text, size=20, overlap=5):
    return split_window(text, size, overlap, SEPARATORS)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab。.\n", max_size=300), st.integers(1, 40), st.integers(0, 39))
def test_windows_cover_the_text(text, size, overlap):
    if overlap >= size:
        overlap = size - 1
    out = pieces(text, size, overlap)
    assert all(len(p) <= size for p in out)
    rebuilt = out[0]
    for before, piece in zip(out, out[1:]):
        tail = before[len(before) - overlap :] if overlap else ""
        assert piece.startswith(tail)
        rebuilt += piece[overlap:]
    assert rebuilt == text


def test_short_and_exact_texts_are_one_window():
    assert pieces("") == [""]
    assert pieces("a" * 20) == ["a" * 20]
    assert pieces("a" * 21) == ["a" * 20, "a" * 6]


def test_separator_order():
    # A blank line wins over a later full stop.
    assert pieces("aaaaaaaa\n\nbbb.cccccccccccc")[0] == "aaaaaaaa\n\n"
    assert pieces("aaaaaaaa。bbb.cccccccccccc")[0] == "aaaaaaaa。"
    assert pieces("aaaaaaaabbb.cccccccccccc\n")[0] == "aaaaaaaabbb."


def test_break_within_the_overlap_is_passed_over():
    # Taking the blank line at 1 would send the next window back to the start.
    out = pieces("a\n\nbbbbbbbbb.cccccccccccccc")
    assert out[0] == "a\n\nbbbbbbbbb."
    assert pieces("a\n\n" + "b" * 30)[0] == "a\n\n" + "b" * 17


def test_frame(spark):
    df = spark.createDataFrame([(1, "x" * 45), (2, ""), (3, None)], "id int, content string")
    rows = chunk_text(df, "content", 20, 5).withColumn("label", chunk_label()).orderBy("id", "chunk_index").collect()
    assert [(r.id, r.chunk_index, r.total_chunks, len(r.chunk), r.label) for r in rows] == [
        (1, 0, 3, 20, "(Chunk 1/3)"), (1, 1, 3, 20, "(Chunk 2/3)"), (1, 2, 3, 15, "(Chunk 3/3)"), (2, 0, 1, 0, ""),
    ]


def test_bad_overlap(spark):
    import pytest

    with pytest.raises(ValueError):
        chunk_text(spark.createDataFrame([("x",)], "content string"), overlap=2000)
