"""The ranking case worked by hand (FIXTURES §4)."""

import pytest

from conftest import collection
from spindex.operators import query as Q
from spindex.plans.build import build_index
from spindex.plans.search import query_plan, search

DOCS = ["apple banana apple", "banana cherry the", ""]


@pytest.fixture(scope="module")
def index(spark):
    return build_index(collection(spark, DOCS), "weighted", prune=None)


def test_dictionary(index):
    d = {r.term: (r.num_docs, r.start) for r in index.dictionary("start").collect()}
    assert d == {"apple": (1, 0), "banana": (2, 1), "cherry": (1, 3)}
    e = {r.term: r.end for r in index.dictionary("end").collect()}
    assert e == {"apple": 1, "banana": 3, "cherry": 4}


def test_postings(index):
    p = {(r.term, r.doc_id): (r.tf, round(r.weight, 6)) for r in index.postings.collect()}
    assert p == {
        ("apple", 0): (2 / 3, 0.984748),
        ("banana", 0): (1 / 3, 0.39203),
        ("banana", 1): (1 / 3, 0.39203),
        ("cherry", 1): (1 / 3, 0.492374),
    }


def test_collection_size_counts_empty_document(index):
    assert index.n_docs.first().n_docs == 3
    assert index.mapping.count() == 3


def _ranked(df):
    return [(r.doc_id, round(r.score, 6)) for r in df.orderBy("rank").collect()]


def test_repeated_term_counts_twice(index):
    assert _ranked(search(index, "banana cherry zebra banana")) == [(1, 1.276435), (0, 0.784061)]


def test_missing_term_reported(index, spark):
    qs = spark.createDataFrame([(0, "banana cherry zebra banana")], "query_id long, text string")
    plan = query_plan(index, qs)
    assert [r.term for r in Q.missing_terms(plan["terms"], index.terms).collect()] == ["zebra"]


def test_tie_higher_id_first(index):
    assert _ranked(search(index, "banana")) == [(1, 0.39203), (0, 0.39203)]


def test_lenient_drops_stopword(index, spark):
    assert _ranked(search(index, "the banana")) == [(1, 0.39203), (0, 0.39203)]
    qs = spark.createDataFrame([(0, "the banana x")], "query_id long, text string")
    rej = {(r.token, r.reason) for r in Q.query_rejects(Q.query_tokens(qs)).collect()}
    assert rej == {("the", "stopword"), ("x", "one_char")}


def test_strict_drops_query(index):
    assert search(index, "the banana", mode="strict").count() == 0
    assert _ranked(search(index, "banana", mode="strict")) == [(1, 0.39203), (0, 0.39203)]


def test_one_character_query(index):
    assert search(index, "x").count() == 0


def test_pruning_modes(spark):
    coll = collection(spark, DOCS)
    once = {r.term for r in build_index(coll, "weighted", prune="once").terms.collect()}
    tf_one = {r.term for r in build_index(coll, "weighted", prune="tf_one").terms.collect()}
    assert once == {"apple", "banana"}
    assert tf_one == {"apple", "banana", "cherry"}
    # a document made of a single term: relative tf 1.0, dropped by tf_one only
    coll2 = collection(spark, DOCS + ["kiwi"])
    assert "kiwi" not in {r.term for r in build_index(coll2, "weighted", prune="tf_one").terms.collect()}
    assert "kiwi" not in {r.term for r in build_index(coll2, "weighted", prune="once").terms.collect()}


def test_raw_profile_keeps_everything(spark):
    idx = build_index(collection(spark, DOCS), "raw")
    terms = {r.term: r.num_docs for r in idx.terms.collect()}
    assert terms == {"apple": 1, "banana": 2, "cherry": 1, "the": 1}
    raw = {(r.term, r.doc_id): r.raw_freq for r in idx.postings.collect()}
    assert raw[("apple", 0)] == 2


def test_stemmed_profile(spark):
    idx = build_index(collection(spark, ["running runs", "runner ran"]), "stemmed", prune=None)
    got = {(r.term, r.doc_id): r.raw_freq for r in idx.postings.collect()}
    assert got == {("run", 0): 2, ("runner", 1): 1, ("ran", 1): 1}
    # strict by default for the stemmed profile; 1 + log10(2/1) = 1.30103
    assert _ranked(search(idx, "runs")) == [(0, 1.30103)]


def test_posting_lists_in_blocks(spark):
    from spindex.operators.weighting import posting_lists
    idx = build_index(collection(spark, ["a1 b2", "a1", "a1 b2 b2"]), "raw")
    rows = posting_lists(idx.postings, "raw_freq", block_docs=2).orderBy("term", "block").collect()
    got = [(r.term, r.block, [(p.doc_id, p.freq) for p in r.postings]) for r in rows]
    assert got == [("a1", 0, [(0, 1.0), (1, 1.0)]), ("a1", 1, [(2, 1.0)]),
                   ("b2", 0, [(0, 1.0)]), ("b2", 1, [(2, 2.0)])]
