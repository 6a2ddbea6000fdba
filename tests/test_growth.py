"""Work that must not be done twice, or in one place, as a collection grows."""

import pytest
from conftest import collection
from pyspark.sql import functions as F

from spindex.operators import query as Q
from spindex.operators import weighting as Wt
from spindex.plans.build import build_index
from spindex.plans.search import query_plan

WORDS = ["apple banana", "banana cherry kiwi", "kiwi pear pear plum", "plum", "", "apple plum fig"]


@pytest.fixture()
def stored(spark, scratch):
    """(collection, queries), both read from files as on a cluster."""
    collection(spark, [f"{w} item{i // 2}" for i, w in enumerate(WORDS * 8)]).write.parquet(f"{scratch}/docs")
    spark.createDataFrame([(0, "apple pear"), (1, "the kiwi kiwi"), (2, None)], "query_id long, text string") \
        .write.parquet(f"{scratch}/queries")
    return spark.read.parquet(f"{scratch}/docs"), spark.read.parquet(f"{scratch}/queries")


def counted(spark, coll):
    """(the collection, the number of bodies that were read once a job has run)."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(body):
        read.add(1)
        return body

    return coll.withColumn("body", seen("body")), read


@pytest.mark.parametrize("use", ["scores", "matches", "top", "stats", "once"])
def test_a_text_is_tokenized_once(spark, stored, use):
    (coll, read), queries = counted(spark, stored[0]), stored[1]
    idx = build_index(coll, "weighted", prune="once" if use != "once" else None)
    if use in ("stats", "once"):
        df = Wt.index_stats(idx.postings)
    else:
        df = query_plan(idx, queries)[use].select("query_id", "doc_id")
    assert df.collect()
    assert read.value == coll.count()


def test_a_lexeme_is_normalized_once(spark, stored):
    coll, queries = stored
    df = query_plan(build_index(coll, "weighted"), queries)["matches"].where(F.length("term") > 2)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "StartsWith(lexeme" in plan
    assert not [x for x in plan.splitlines() if "Filter" in x and "StartsWith(lexeme" in x]


@pytest.mark.parametrize("profile", ["weighted", "stemmed"])
def test_the_part_of_some_terms_is_that_of_the_whole(spark, stored, profile):
    coll, _ = stored
    idx = build_index(coll, profile)
    wanted = idx.terms.select("term").where(F.length("term") < 5)
    part = idx.of(wanted)
    for a, b in ((part.terms, idx.terms), (part.postings, idx.postings)):
        want = sorted(map(tuple, b.join(wanted, "term", "left_semi").select(*a.columns).collect()))
        assert want and sorted(map(tuple, a.collect())) == want


def test_sums_of_parts_are_the_decimal_sums(spark):
    rows = [(q, d, ((q * 7919 + d * 104729 + i * 31) % 99991) / 7e4 * 10.0 ** -(i % 9), 1 + i % 3)
            for q in range(3) for d in range(40) for i in range(30)]
    m = spark.createDataFrame(rows, "query_id long, doc_id long, weight double, mult long")
    split = m.select("*", *(c.alias(p) for p, c in zip(Q.PARTS, Q.parts(F.col("weight")))))
    assert sorted(map(tuple, Q.accumulate(split).collect())) == sorted(map(tuple, Q.accumulate(m).collect()))


def test_no_match_is_shuffled(spark, stored):
    coll, queries = stored
    plan = query_plan(build_index(coll, "weighted"), queries)["scores"]._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan and "hashpartitioning(query_id#" in plan
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(query_id" in x and "doc_id" in x]


def test_a_saved_index_is_sorted_by_its_counts(spark, stored, scratch):
    from spindex.sources import index_store as S
    idx = build_index(stored[0], "weighted")
    S.write_index(idx, f"{scratch}/i", buckets=3)
    cols = ["term", "doc_id", "raw_freq", "tf", "weight"]
    back = S.read_index(spark, f"{scratch}/i").postings.select(*cols)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, idx.postings.select(*cols).collect()))
    assert idx.counts.columns and "weight" not in idx.counts.columns


def test_kinds_by_row_are_those_by_array(spark):
    from spindex.functions import analyzer as A
    from spindex.operators import tokens as T
    coll = collection(spark, ["mail a.b@c.org, <b>bold</b> &amp; 12,5 http://x.y/z", "p { x: y } word's", "", None])
    want = [tuple(r) for r in coll.select("doc_id", F.explode(A.kinded_lexemes(F.col("body"))).alias("k"))
            .select("doc_id", "k.kind", "k.lexeme").collect()]
    got = T.kinded_rows(coll)
    assert sorted(map(tuple, got.collect())) == sorted(want) and {"email", "css", "url"} <= {k for _, k, _ in want}
    plan = got.where("kind = 'email'")._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Filter" in x and "CASE" in x]


def test_a_scanned_directory_has_one_file_a_page_and_few_folders(spark, scratch):
    import os

    from spindex import catalog
    from spindex.session import ensure_checkpoint_dir
    from spindex.sources import collection as C
    rows = [(i, None if i % 50 == 7 else f"<p>page {i}\nend") for i in range(1200)] + [(3, "again")]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(1).write.parquet(f"{scratch}/pages.parquet")
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(top))
    got = sorted((int(r.name), r.body) for r in catalog.QUERIES["scan_directory"](spark, scratch).collect())
    want = {i: (b or "") + "\n" for i, b in rows[:1200]}
    want[3] += "again\n"
    assert got == sorted(want.items())
    made = [(d, f) for x in set(os.listdir(top)) - before for d, _, f in os.walk(f"{top}/{x}")]
    assert sum(len(f) for _, f in made) == 1200 and len(made) <= 4
    C.write_files(spark.createDataFrame([], "name string, body string"), f"{scratch}/none")
    assert C.scan_documents(spark, f"{scratch}/none", "*.txt").count() == 0


def test_a_task_of_a_search_has_a_bounded_number_of_documents(spark, stored, scratch, monkeypatch):
    from spindex.sources import index_store as S
    coll, queries = stored
    S.write_index(build_index(coll, "weighted"), f"{scratch}/i", buckets=3)
    want = sorted(map(tuple, query_plan(S.read_index(spark, f"{scratch}/i"), queries)["top"].collect()))
    monkeypatch.setattr(Q, "TASK_DOCS", 3)
    top = query_plan(S.read_index(spark, f"{scratch}/i"), queries)["top"]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert [x for x in plan.splitlines() if "hashpartitioning(doc_id" in x and f", {coll.count() // 3})" in x]
    assert sorted(map(tuple, top.collect())) == want


@pytest.mark.parametrize("profile", ["raw", "weighted", "stemmed"])
def test_an_index_with_its_dictionary_is_counted_once(spark, stored, scratch, profile):
    coll, read = counted(spark, stored[0])
    idx = build_index(coll, profile, keep=f"{scratch}/counts")
    got = idx.entries("start")
    rows = sorted(map(tuple, got.collect()))
    assert read.value == coll.count()
    plain = build_index(stored[0], profile)
    want = plain.postings.join(plain.dictionary("start"), "term").select(*got.columns)
    assert rows and rows == sorted(map(tuple, want.collect()))


def test_postings_are_not_sorted_to_be_counted(spark, stored, scratch):
    from spindex import catalog
    stored[0].select(F.col("doc_id").alias("page_id"), F.col("body").alias("html")).write.parquet(f"{scratch}/pages.parquet")
    stats = catalog.QUERIES["index_stats"](spark, scratch)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [term" in plan and "SortMergeJoin" not in plan
    p = build_index(stored[0], "weighted").postings
    assert tuple(stats.first()) == (p.count(), p.select("term").distinct().count())


def test_a_line_is_taken_apart_only_before_its_last_block(spark):
    from spindex.functions import analyzer as A
    line = "a, b {c} d{e f, {g}h{} " + "word, " * 50 + "x@y.z"
    df = spark.createDataFrame([(line,)], "line string").select(A._mark_css(F.col("line")).alias("m"))
    assert "regexp_extract_all(substring(" in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.first().m.endswith("g}h{} " + "word, " * 50 + "x@y.z") and A.R.M_CSS in df.first().m
