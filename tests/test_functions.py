
from faultline.functions.text import escape_literal, preview, render_template, strip_text
from tests.conftest import rows


def test_escape_and_preview(spark):
    df = spark.createDataFrame([("it's a \\ path",), ("x" * 85,), ("short",)], "s string")
    got = rows(df.select(escape_literal("s").alias("e"), preview("s", 80).alias("p")))
    assert got[0][0] == "it''s a \\\\ path"
    assert got[1][1] == "x" * 80 + "..." and got[2][1] == "short"


def test_render_template_copies_values_verbatim(spark):
    df = spark.createDataFrame([("100% {braces} “quoted” 🙂", 3), (None, 4)], "q string, n int")
    tpl = "Query:\n{query}\nRank {rank} of {{all}}"
    got = [r[0] for r in df.select(render_template(tpl, {"query": "q", "rank": "n"})).collect()]
    assert got == ["Query:\n100% {braces} “quoted” 🙂\nRank 3 of {all}", None]


def test_strip_text_removes_newlines_and_tabs(spark):
    df = spark.createDataFrame([("\n\t  Feedback text. \r\n",)], "s string")
    assert rows(df.select(strip_text("s"))) == [("Feedback text.",)]


def test_tokens_split_like_python(spark):
    from faultline.functions.text import tokens
    text = "a\u00a0b\u2003c\x1cd\te  f\u3000g"
    got = spark.createDataFrame([(text,)], "t string").select(tokens("t").alias("w")).first().w
    assert got == text.lower().split()
