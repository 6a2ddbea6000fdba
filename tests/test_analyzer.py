"""Tokenizer cases derived by hand from the rules (FIXTURES §3)."""

import pytest
from pyspark.sql import functions as F

from spindex.functions import analyzer as A

CASES = [
    ("20 20.07 30332-0829", ["20", "20", "303320829"]),
    ("<b>jdoe</b>@site.edu www.page.host.org", ["jdoe</b>@site.edu", "page.host.org"]),
    ("http://www.Site.edu/~a/B.html HTTP://X.com", ["site.edu", "a", "bhtml", "http", "xcom"]),
    ("don't state-of-the-art U.S.A end.Next", ["dont", "stateoftheart", "usa", "endnext"]),
    ("3rd 007 0 1,234.50", ["3", "rd", "7", "1234"]),
    ("a&amp;b &#160; &copy;x", ["a", "b", "160", "x"]),
    ("foo<b>bar</b>baz</p><p>next", ["foobarbaznext"]),
    ("word</p><p>next", ["wordnext"]),
    ("p, h1 {color:red} body{margin:0}tail", ["tail"]),
    ("title</title><style>p{margin:0}</style>x", ["x"]),
    ("/* note */ école über naïve _x ^", ["note", "cole", "ber", "naïve", "_x", "^"]),
    ("Bob.Smith@Mail.COM, end", ["Bob.Smith@Mail.COM", "end"]),
    ("broken <a href=", ["broken", "a", "href"]),
    ("one\nTwo <a\nhref=\"q\">z", ["one", "two", "a", "href", "q", "z"]),
    ("wwwhat a@b x{y", ["wwwhat", "a", "b", "x", "y"]),
    ("", []),
    ("   ... 0 0 --", []),
    ("http://www. x", ["", "x"]),
    ("a\r\nb\rc", ["a", "b", "c"]),
]


def _tokens(spark, texts, analyzer="full", by_line=True):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, body string")
    rows = df.select("id", A.tokens(F.col("body"), analyzer, by_line).alias("t")).orderBy("id").collect()
    return [list(r.t) for r in rows]


def test_fixture_cases(spark):
    got = _tokens(spark, [c[0] for c in CASES])
    for (text, expected), tokens in zip(CASES, got):
        assert tokens == expected, text


def test_null_body_is_empty(spark):
    df = spark.createDataFrame([(0, None)], "id long, body string")
    assert df.select(A.tokens(F.col("body")).alias("t")).first().t == []


def test_compact_analyzer(spark):
    got = _tokens(spark, ["<b>jdoe</b>@site.edu www.page.host.org", "12a@x.com"], "compact")
    assert got == [["jdoe", "pagehostorg"], ["12a"]]
    # the full analyzer reads the same e-mail differently
    assert _tokens(spark, ["12a@x.com"]) == [["12", "a@x.com"]]


def test_comment_rule_is_unreachable(spark):
    assert _tokens(spark, ["/* note */"]) == [["note"]]


def test_query_text_is_read_whole(spark):
    # a tag broken over two lines: a document line split leaks it, a query does not
    text = "one <a\nhref> two"
    assert _tokens(spark, [text]) == [["one", "a", "href", "two"]]
    assert _tokens(spark, [text], by_line=False) == [["one", "two"]]


@pytest.mark.parametrize("text,count", [
    ("ab, " * 8000, 8000),
    ("a" * 50000, 1),
    ("a<b>" * 60000, 1),
    ("ab=c;" * 20000, 40000),
])
def test_long_lines_finish(spark, text, count):
    df = spark.createDataFrame([(0, text)], "id long, body string")
    assert df.select(F.size(A.tokens(F.col("body"))).alias("n")).first().n == count


@pytest.mark.parametrize("text,count", [
    ("ab, " * 8000 + "{x}", 0),          # the whole chain is one CSS lexeme
    ("ab, " * 8000 + "{", 8000),         # no closing brace: no CSS match anywhere
    ("ab, " * 8000 + "{}", 8000),        # an empty body is no CSS match
    ("x " + "ab, " * 300 + "{y} z", 2),  # chain starts after a break: x and z stay
])
def test_long_selector_chains_exact(spark, text, count):
    df = spark.createDataFrame([(0, text)], "id long, body string")
    assert df.select(F.size(A.tokens(F.col("body"))).alias("n")).first().n == count


def test_lexeme_kinds(spark):
    df = spark.createDataFrame([(0, "a&amp; <b>x</b> p{q:1} 12 www.x.y z@y.com")], "id long, body string")
    kinds = [r.k.kind for r in df.select(F.explode(A.kinded_lexemes(F.col("body"))).alias("k")).collect()]
    assert [k for k in kinds if k != "ignore"] == ["word", "entity", "tag", "word", "css", "number", "url", "email"]
