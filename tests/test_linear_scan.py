"""The marked, backtracking-free scan equals the plain patterns (run by DuckDB)
on random lines, takes linear time on hostile ones and stays in the JVM."""

import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE
from spindex import oracle as O
from spindex.functions import analyzer as A
from spindex.functions import rules as R
from spindex.operators import tokens as T
from spindex.plans.build import build_index
from spindex.sources import collection as C

PARTS = ["a", "b", ",", " ", "{", "}", "<", ">", "&", "@", ".", "1", "0", "http://", "www.", "www", "é", "\t", "-", "'",
         ";", "x", "/", ":", " , ", "{x}", "a@b.c", "T", "_", "(", '"', " ", "&amp", "<b>", "p {", "}x", ", ", "?",
         "!", "=", "\n", "https://", " "]


@pytest.fixture(scope="module")
def lines(spark):
    rng = random.Random(21)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randrange(32)))) for i in range(12_000)]
    df = spark.createDataFrame(rows, "id long, body string").repartition(8).cache()
    con = duckdb.connect()
    con.register("frame", df.toPandas())
    con.execute("CREATE TABLE t AS SELECT * FROM frame")
    return rows, df, con


@pytest.mark.parametrize("analyzer", ["full", "compact"])
@pytest.mark.parametrize("by_line", [True, False])
def test_tokens_equal_the_plain_patterns(lines, analyzer, by_line):
    rows, df, con = lines
    got = {r.id: list(r.t) for r in df.select("id", A.tokens(F.col("body"), analyzer, by_line).alias("t")).collect()}
    want = dict(con.sql(f"SELECT id, {O.tokens_sql('body', analyzer, by_line)} FROM t").fetchall())
    assert [(b, got[i], want[i]) for i, b in rows if got[i] != list(want[i])] == []


@pytest.mark.parametrize("analyzer", ["full", "compact"])
def test_kinds_equal_the_plain_patterns(lines, analyzer):
    rows, df, con = lines
    got = {r.id: [(k.kind, k.lexeme.replace(R.M_MAIL, "")) for k in r.k]
           for r in df.select("id", A.kinded_lexemes(F.col("body"), analyzer).alias("k")).collect()}
    sql = (f"SELECT id, list_transform(l, lambda x: {O.kind_case('x', analyzer)}), l "
           f"FROM (SELECT id, {O.lexemes_sql('body', analyzer, group=0)} AS l FROM t)")
    want = {i: list(zip(k, x, strict=True)) for i, k, x in con.sql(sql).fetchall()}
    assert [(b, got[i], want[i]) for i, b in rows if got[i] != want[i]] == []


HOSTILE = {"a{": "", "a={};": "", "x<y;": "", "if(a){": "", "ab, ": "", "ab, ​": "{x}", "AbCd0+/9": " p {x:1}",
           "AbCd+/90": "; x@y.z", "@": "", "a@": "b.", "{a}": "", "<": "", "a<b>": "", ".a@": "", "&a": "", "www ": "{x}"}


@pytest.mark.parametrize("unit", HOSTILE)
def test_hostile_lines_take_linear_time(spark, unit):
    def seconds(n):
        df = spark.createDataFrame([(unit * (n // len(unit)) + HOSTILE[unit],)], "body string")
        t = time.time()
        df.select(F.size(A.lexemes(F.col("body")))).collect()
        return time.time() - t

    seconds(1000)
    half, whole = seconds(500_000), seconds(1_000_000)
    assert whole < 10 and whole < 2 * half + 2


def test_chain_of_any_length(spark):
    df = spark.createDataFrame([("ab, " * 8000 + "{x}",), ("ab, " * 8000 + "cd",)], "body string")
    assert [len(r.t) for r in df.select(A.tokens(F.col("body")).alias("t")).collect()] == [0, 8001]


def test_marks_in_a_text(spark):
    df = spark.createDataFrame([(f"a{R.M_CSS}b{R.M_BRACE}c}} {R.M_MAIL}x@y.z{R.M_DOT}w",)], "body string")
    assert df.select(A.tokens(F.col("body")).alias("t")).first().t == ["a", "b", "c", f"{R.NO_MARK}x@y.z{R.NO_MARK}w"]


def test_no_python_in_the_plans(spark):
    pages = C.pages_collection(spark, SF_SMOKE)
    frames = [T.document_lexemes(pages), T.token_rows(pages, "compact")]
    frames += [build_index(pages, p).postings for p in ("raw", "weighted", "stemmed")]
    for df in frames:
        assert "Python" not in df._jdf.queryExecution().toString()
