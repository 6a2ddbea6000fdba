"""Scalar text helpers."""

from pyspark.sql import functions as F

from spindex.functions.text import fixed_decimal, score_text


def test_fixed_decimal_rounds_like_python(spark):
    vals = [1 / 128, 1 / 640, 3 / 128, 0.8055, 2.5e-7, 1234.56789012, 0.1234565, 12.0000005, 0.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [(r.a, r.b) for r in df.select(fixed_decimal(F.col("v"), 6).alias("a"), score_text(F.col("v")).alias("b")).collect()]
    assert got == [("{:.6f}".format(v), "{:.4f}".format(v)) for v in vals]
