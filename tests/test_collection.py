"""Collection operators: directory scan, natural order, dense ids, limit."""

import os

from pyspark.sql import functions as F

from spindex.functions.text import natural_key
from spindex.sources import collection as C


def test_scan_documents_directory(spark, scratch):
    for name, text in [("10.html", "ten"), ("2.html", "two\nlines"), ("a.txt", "skip")]:
        with open(os.path.join(scratch, name), "w") as f:
            f.write(text)
    df = C.scan_documents(spark, scratch)
    got = {r.name: r.body for r in df.collect()}
    assert got == {"10.html": "ten", "2.html": "two\nlines"}
    coll = C.from_table(df, "body", "name")
    assert [(r.doc_id, r.name) for r in coll.orderBy("doc_id").collect()] == [(0, "2.html"), (1, "10.html")]


def test_natural_order_like_version_sort(spark):
    names = ["simple.html", "10.html", "1813.html", "hard.html", "2.html", "medium.html", "0.html", "15.html",
             "src10", "src2", "src1", "007.html"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    ids = C.assign_doc_ids(df)
    order = [r.name for r in ids.orderBy("doc_id").collect()]
    assert order == ["0.html", "2.html", "007.html", "10.html", "15.html", "1813.html", "hard.html", "medium.html",
                     "simple.html", "src1", "src2", "src10"]
    assert sorted(r.doc_id for r in ids.collect()) == list(range(len(names)))


def test_natural_key_digits_before_letters(spark):
    df = spark.createDataFrame([("a1",), ("a-b",), ("ab",)], "name string")
    keys = {r.name: r.k for r in df.select("name", natural_key(F.col("name")).alias("k")).collect()}
    assert keys["a1"] < keys["ab"] < keys["a-b"]


def test_dense_ids_many_partitions(spark):
    df = spark.range(0, 5000).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("name")).repartition(13)
    ids = C.assign_doc_ids(df)
    rows = ids.collect()
    assert sorted(r.doc_id for r in rows) == list(range(5000))
    by_id = {r.doc_id: r.name for r in rows}
    assert by_id[0] == "f0" and by_id[9] == "f9" and by_id[10] == "f10" and by_id[4999] == "f4999"


def test_limit_collection(spark):
    df = spark.createDataFrame([(f"{i}.html", "x") for i in range(20)], "name string, body string")
    coll = C.from_table(df, "body", "name")
    assert sorted(r.name for r in C.limit_collection(coll, 5).collect()) == [f"{i}.html" for i in range(5)]


def test_names_null_repeated_and_encoded(spark, scratch):
    df = spark.createDataFrame([("index.html", "a"), ("index.html", "b"), (None, "c"), ("b.html", "d")], "name string, body string")
    rows = C.from_table(df, "body", "name").collect()
    assert sorted(r.doc_id for r in rows) == [0, 1, 2, 3]
    assert sorted(((r.name or "", r.body) for r in rows)) == [("", "c"), ("b.html", "d"), ("index.html", "a"), ("index.html", "b")]
    for folder in ("x", "y"):
        os.makedirs(os.path.join(scratch, folder))
        for name in ("a b.html", "index.html"):
            with open(os.path.join(scratch, folder, name), "w") as f:
                f.write(f"{folder} {name}")
    scan = C.scan_documents(spark, scratch)
    assert sorted(r.name for r in scan.collect()) == ["a b.html", "a b.html", "index.html", "index.html"]
    rows = sorted((r.doc_id, r.name, r.body) for r in C.from_table(scan, "body", "name", key="path").collect())
    assert [r[0] for r in rows] == [0, 1, 2, 3] and len({r[2] for r in rows}) == 4


def test_tilde_sorts_before_the_end(spark):
    df = spark.createDataFrame([("ab",), ("a",), ("a~",), ("a~1",), ("a1",), ("9" * 12_000,)], "name string")
    order = [r.name for r in C.assign_doc_ids(df).orderBy("doc_id").collect()]
    assert order == ["9" * 12_000, "a~", "a~1", "a", "a1", "ab"]


def test_limited_numbers_only_what_it_keeps(spark):
    df = spark.createDataFrame([(f"{i}.html", "x") for i in range(20)], "name string, body string").repartition(7)
    coll = C.limited(df, "body", "name", 5)
    assert "TakeOrderedAndProject" in coll._jdf.queryExecution().executedPlan().toString()
    assert [(r.doc_id, r.name) for r in coll.orderBy("doc_id").collect()] == [(i, f"{i}.html") for i in range(5)]


def test_undecodable_bytes_are_replaced(spark, tmp_path):
    (tmp_path / "a.html").write_bytes(b"caf\xe9 noir\n\xff\xfe")
    (tmp_path / "b.html").write_bytes("café".encode())
    rows = {r.name: r for r in C.scan_documents(spark, str(tmp_path)).selectExpr("*", "is_valid_utf8(body) AS ok").collect()}
    assert rows["a.html"].ok and rows["a.html"].body == "caf\ufffd noir\n\ufffd\ufffd"
    assert rows["b.html"].ok and rows["b.html"].body == "café"
