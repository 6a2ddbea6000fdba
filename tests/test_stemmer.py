"""Porter's published examples; Spark and DuckDB renderings agree."""

import duckdb
from pyspark.sql import functions as F

from spindex.functions.stemmer import stem, stem_sql

EXAMPLES = dict(
    caresses="caress", ponies="poni", ties="ti", caress="caress", cats="cat", feed="feed", agreed="agre",
    plastered="plaster", bled="bled", motoring="motor", sing="sing", conflated="conflat", troubled="troubl",
    sized="size", hopping="hop", tanned="tan", falling="fall", hissing="hiss", fizzed="fizz", failing="fail",
    filing="file", happy="happi", sky="sky", generalizations="gener", oscillators="oscil", relational="relat",
    controlling="control", roll="roll", rate="rate", cease="ceas", effective="effect", adoption="adopt",
    be="be", is_="is_", yes="ye", youth="youth", syzygy="syzygi",
)


# where the extended mode differs from the published algorithm
EXTENDED = dict(enjoy="enjoy", possibly="possibl", biology="biolog", skies="sky", dies="die", died="die", news="news",
                ties="tie", dying="die", cried="cri", say="say", innings="inning", using="use", succeed="succeed",
                hopefully="hope", rationally="ration", by="by", tied="tie", spied="spi", use="use")


def test_examples(spark):
    df = spark.createDataFrame([(w,) for w in EXAMPLES], "w string")
    got = {r.w: r.s for r in df.select("w", stem(F.col("w"), "original").alias("s")).collect()}
    assert got == EXAMPLES


def test_extended_examples(spark):
    want = EXAMPLES | EXTENDED
    df = spark.createDataFrame([(w,) for w in want], "w string")
    got = {r.w: r.s for r in df.select("w", stem(F.col("w")).alias("s")).collect()}
    assert got == want


def test_lower_cases_input(spark):
    df = spark.createDataFrame([("Running",), ("Y",)], "w string")
    assert [r.s for r in df.select(stem(F.col("w")).alias("s")).collect()] == ["run", "y"]


def test_duckdb_rendering_agrees(spark):
    words = [*EXAMPLES, *EXTENDED, "yelling", "abyss", "agreement", "hopeful", "nationalization", "yyy", "bbb",
             "nationally", "ied", "logy", "ally", "fully", "eying", "radically", "conformabli", "analogies", "ies"]
    con = duckdb.connect()
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for mode in ("extended", "original"):
        dd = dict(con.sql(f"SELECT w, {stem_sql('w', mode)} FROM (SELECT unnest(?) AS w)", params=[words]).fetchall())
        assert {r.w: r.s for r in df.select("w", stem(F.col("w"), mode).alias("s")).collect()} == dd
