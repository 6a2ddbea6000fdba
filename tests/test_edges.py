"""Empty and degenerate inputs."""

from conftest import collection
from spindex.plans.build import build_index
from spindex.plans.search import search, search_many
from spindex.sources import index_store as S


def test_empty_collection(spark, scratch):
    coll = spark.createDataFrame([], "doc_id long, name string, body string")
    idx = build_index(coll, "weighted")
    assert idx.postings.count() == 0
    assert idx.dictionary("start").count() == 0
    S.write_index(idx, f"{scratch}/empty")
    back = S.read_index(spark, f"{scratch}/empty")
    assert search(back, "anything here").count() == 0


def test_null_and_empty_texts(spark):
    coll = spark.createDataFrame([(0, "0.html", None), (1, "1.html", ""), (2, "2.html", "kiwi pear")],
                                 "doc_id long, name string, body string")
    idx = build_index(coll, "weighted", prune=None)
    assert idx.n_docs.first().n_docs == 3
    assert [r.doc_id for r in search(idx, "kiwi").collect()] == [2]
    qs = spark.createDataFrame([(0, None), (1, "the a of"), (2, "pear")], "query_id long, text string")
    assert [(r.query_id, r.doc_id) for r in search_many(idx, qs).collect()] == [(2, 2)]


def test_empty_query_table(spark):
    idx = build_index(collection(spark, ["kiwi pear"]), "weighted", prune=None)
    qs = spark.createDataFrame([], "query_id long, text string")
    assert search_many(idx, qs).count() == 0
