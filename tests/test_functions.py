import pytest
from pyspark.sql import functions as F

from qaloom.functions import reply as rp
from qaloom.functions import text as tx
from qaloom.sources.files import java_charsets


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, score", [("-1", -1), ("1", 1), ("0", 0), ("10", 10), ("none", 0), ("", 0), (None, 0), ("Score: -1/10", -1), ("99999999999", 0), ("得分：１", 1)]
)
def test_first_int(spark, text, score):
    assert one(spark, tx.first_int(F.lit(text).cast("string"))) == score


@pytest.mark.parametrize("text, score", [("1", 1), ("-1", -1), ("unclear", -1), (None, 0), ("10", -1)])
def test_reply_score(spark, text, score):
    assert one(spark, rp.reply_score(F.lit(text).cast("string"))) == score


BLOCK = "```json\n{}\n```"


def test_fences(spark):
    two = BLOCK.format('{"a": 1}') + " and " + BLOCK.format('{"b": {"c": 2}}')
    assert one(spark, rp.fenced_json(F.lit(two), "last")) == '{"b": {"c": 2}}'
    assert one(spark, rp.fenced_json(F.lit(two), "first")) == '{"a": 1}'
    assert one(spark, rp.fenced_json(F.lit("no fence"))) is None
    assert one(spark, rp.reply_json(F.lit('x {"a": 1} y'), "brace")) == '{"a": 1}'
    assert one(spark, rp.reply_json(F.lit("no braces"), "brace")) is None
    with pytest.raises(ValueError):
        rp.reply_json("x", "eval")


@pytest.mark.parametrize(
    "text, parsed",
    [
        ('{"a": "x", "b": 1}', ("x", 1)),
        ("{'a': 'x'}", ("x", None)),
        ('{"a": null}', (None, None)),
        ("{}", (None, None)),
        ('{"a": "x", "b": 1,}', ("x", 1)),
        ("{'a': True, 'b': None}", ("true", None)),
        ("{'a': 'is: True', 'b': 2, 'c': [False, None,], }", ("is: True", 2)),
        ('{"a": [', None),
        ("plain", None),
        ("[1]", None),
        ("null", None),
        (None, None),
    ],
)
def test_typed_json(spark, text, parsed):
    got = one(spark, rp.typed_json(F.lit(text).cast("string"), "a string, b int"))
    assert (tuple(got) if got is not None else None) == parsed


def test_resolve_choice(spark):
    options = F.array(F.lit("x"), F.lit("y"))
    for answer, want in [("0", "x"), ("1", "y"), ("2", "2"), ("y", "y"), ("-1", "-1")]:
        assert one(spark, rp.resolve_choice(F.lit(answer), options)) == want


def test_preview(spark):
    assert one(spark, tx.preview(F.lit("abc"), 3)) == "abc"
    assert one(spark, tx.preview(F.lit("半导体x"), 3)) == "半导体..."


def test_paths(spark):
    assert one(spark, tx.image_rel_path(F.lit("/a/b/c/d.png"))) == "./b/c/d.png"
    assert one(spark, tx.image_rel_path(F.lit("d.png"))) == "./d.png"
    assert one(spark, tx.path_tail(F.lit("a/b/c"), 2)) == "b/c"
    kinds = {"a.PDF": "pdf", "b.txt": "text", "x/c.md": "text", "d.text": "text", "e.docx": "unknown", "f": "unknown", ".txt": "unknown"}
    for path, kind in kinds.items():
        assert one(spark, tx.file_type(F.lit(path))) == kind


def test_data_uri_has_no_line_breaks(spark):
    uri = one(spark, tx.data_uri(F.lit("a/b.PNG"), F.lit(bytearray(b"x" * 300))))
    assert uri.startswith("data:image/png;base64,eHh4") and "\n" not in uri and "\r" not in uri


def test_figure_refs(spark):
    assert one(spark, tx.figure_refs(F.lit("见图\u30003"))) == ["图\u30003"]
    text = "Figure 1 and fig. 2, 图 3，图片4; Figure A1, Fig B, Figure 1 again"
    assert one(spark, tx.figure_refs(F.lit(text))) == ["Fig B", "Figure 1", "Figure A1", "fig. 2", "图 3", "图片4"]


def test_white_space_of_any_script(spark):
    assert one(spark, tx.has_text(F.lit("\u3000\u00a0\n"))) is False
    assert one(spark, tx.strip(F.lit("\u3000 a b\n"))) == "a b"


def test_normalize(spark):
    assert one(spark, tx.normalize_text(F.lit("  a \t b \n\n\n\n c  \n"))) == "a b\n\nc"


def test_decode(spark):
    with java_charsets(spark):
        frame = spark.createDataFrame(
            [(0, bytearray("半导体 é".encode())), (1, bytearray("半导体".encode("gbk"))), (2, bytearray(b"\xff\xfe\x80")), (3, bytearray())],
            "i int, raw binary",
        ).select("i", tx.decode_text("raw").alias("t"))
    assert [r.t for r in frame.orderBy("i").collect()] == ["半导体 é", "半导体", "", ""]
