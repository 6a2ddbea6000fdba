"""Persisted index: write, reopen, search; text layouts."""

from pyspark.sql import functions as F

from conftest import SF_SMOKE, collection
from spindex.plans.build import build_index
from spindex.operators import query as Q
from spindex.plans.search import query_plan, search, search_many
from spindex.sources import collection as C
from spindex.sources import index_store as S


def test_round_trip_and_search(spark, scratch):
    pages = C.pages_collection(spark, SF_SMOKE)
    idx = build_index(pages, "weighted")
    S.write_index(idx, f"{scratch}/idx")
    back = S.read_index(spark, f"{scratch}/idx")
    assert back.profile == "weighted" and back.n_docs.first().n_docs == pages.count()
    assert back.postings.count() == idx.postings.count()
    d1 = sorted(tuple(r) for r in idx.dictionary("start").collect())
    d2 = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/idx/dictionary").select("term", "num_docs", "start").collect())
    assert d1 == d2
    qs = C.read_table(spark, SF_SMOKE, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    a = sorted(tuple(r) for r in search_many(idx, qs).collect())
    b = sorted(tuple(r) for r in search_many(back, qs).collect())
    assert a == b and len(a) > 0


def test_postings_sorted_by_term(spark, scratch):
    idx = build_index(collection(spark, ["b a c", "a d", "c c e"]), "raw")
    S.write_index(idx, f"{scratch}/raw", buckets=3)
    rows = [(r.bucket, r.term, r.doc_id) for r in spark.read.parquet(f"{scratch}/raw/postings").collect()]
    assert {x[0] for x in rows} <= {0, 1, 2}
    for bucket in range(3):
        own = [r[1:] for r in rows if r[0] == bucket]
        assert own == sorted(own)


def scan_of(df, column):
    """(its partitions are pruned at run time, number of files read) of the one scan that reads ``column`` in the plan that ran."""
    found, waiting = [], [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            waiting.append(node.plan())
        elif name == "FileSourceScanExec" and f"{column}:" in node.requiredSchema().catalogString():
            found.append(("dynamicpruning" in node.toString().lower(), node.metrics().apply("numFiles").value()))
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    assert len(found) == 1
    return found[0]


def test_search_reads_the_buckets_of_its_terms(spark, scratch):
    bodies = [" ".join(f"term{(i * 7 + j) % 150}" for j in range(40)) for i in range(30)]
    idx = build_index(collection(spark, bodies), "weighted", prune=None)
    S.write_index(idx, f"{scratch}/w", buckets=16)
    back = S.read_index(spark, f"{scratch}/w")
    assert back.buckets == 16
    every = spark.read.parquet(f"{scratch}/w/postings").inputFiles()
    df = search(back, "term3 term77")
    assert [tuple(r) for r in df.collect()] == [tuple(r) for r in search(idx, "term3 term77").collect()]
    pruned, read = scan_of(df, "weight")
    assert pruned and 1 <= read <= len(every) / 4
    # a whole table of queries, without a known number of them
    spark.createDataFrame([(0, "term3"), (1, "term77 term3")], "query_id long, text string").write.parquet(f"{scratch}/q")
    many = query_plan(back, spark.read.parquet(f"{scratch}/q"))["top"]
    assert many.count() and "dynamicpruning" in many._jdf.queryExecution().executedPlan().toString().lower()


def test_preview_reads_the_results_documents(spark, scratch):
    coll = collection(spark, [f"apple pear{i} " + "filler " * i for i in range(80)])
    S.write_documents(coll, f"{scratch}/store", buckets=32)
    store = S.read_documents(spark, f"{scratch}/store")
    assert store.buckets == 32 and store.documents.count() == 80
    S.write_index(build_index(coll, "weighted", prune=None), f"{scratch}/i", buckets=4)
    res = search(S.read_index(spark, f"{scratch}/i"), "pear5", k=3)
    df = Q.result_preview(res, store.documents, chars=11, bound_rows=3, buckets=store.buckets)
    assert [(r.doc_id, r.preview) for r in df.collect()] == [(5, "apple pear5")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    pruned, read = scan_of(df, "body")
    assert pruned and read == 1 and "BuildLeft" in plan  # the results are what is broadcast
    whole = Q.result_preview(res, coll)
    assert sorted(whole.columns) == sorted(df.columns)


def test_records_are_found_by_position(spark, scratch):
    bodies = ["apple école apple", "banana naïveté the日本", "", "apple banana"]
    idx = build_index(collection(spark, bodies), "weighted", prune=None)
    idx.mapping = spark.createDataFrame([(i, f"{i}.html") for i in range(12_340, 12_350)] + [(7, None), (8, "ü.html")],
                                        "doc_id long, name string")
    S.write_text_layout(idx, f"{scratch}/fix")
    import glob
    terms = idx.dictionary("start").orderBy("term").collect()
    ids = [r.doc_id for r in idx.mapping.orderBy("doc_id").collect()]
    posts = idx.postings.orderBy("term", "doc_id").collect()
    for name, want in (("mapping_text", [str(i) for i in ids]), ("dictionary_text", [r.term for r in terms]),
                       ("postings_text", [str(r.doc_id) for r in posts])):
        size = spark.read.parquet(f"{scratch}/fix/{name}_widths").first().record
        raw = b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{scratch}/fix/{name}/part-*")))
        assert len(raw) == size * len(want)
        for n, value in enumerate(want):  # the n-th record, by its offset
            record = raw[n * size:(n + 1) * size]
            assert record.endswith(b"\n") and record.decode().split("\t")[0].rstrip(" ") == value
    assert any(not r.term.isascii() for r in terms)
    empty = S.mapping_text(spark.createDataFrame([(1, None)], "doc_id long, name string"))
    assert [r.line for r in empty.collect()] == ["1   \t      ."]
    assert [r.line for r in S.raw_mapping_text(idx.mapping.where("doc_id = 7")).collect()] == ["7 \t "]


def test_text_layouts(spark):
    idx = build_index(collection(spark, ["apple banana apple", "banana cherry the", ""]), "weighted", prune=None)
    m = [r.line for r in S.mapping_text(idx.mapping).orderBy("doc_id").collect()]
    assert m == ["0   \t     0.html", "1   \t     1.html", "2   \t     2.html"]
    d = {r.term: r.line for r in S.dictionary_text(idx.dictionary("start")).collect()}
    assert d["banana"] == "banana\t2   \t1       " and d["apple"] == "apple \t1   \t0       "
    p = {(r.term, r.doc_id): r.line for r in S.postings_text(idx.postings).collect()}
    assert p[("apple", 0)] == "0   \t0.984748"


def test_text_sinks_write(spark, scratch):
    idx = build_index(collection(spark, ["apple banana apple", "banana cherry the", ""]), "weighted", prune=None)
    S.write_text_layout(idx, f"{scratch}/txt")
    assert [r.value for r in spark.read.text(f"{scratch}/txt/mapping_text").collect()] == \
        ["0   \t     0.html", "1   \t     1.html", "2   \t     2.html"]
    lines = [r.value for r in spark.read.text(f"{scratch}/txt/dictionary_text").collect()]
    assert lines == ["apple \t1   \t0       ", "banana\t2   \t1       ", "cherry\t1   \t3       "]
    posts = [r.value for r in spark.read.text(f"{scratch}/txt/postings_text").collect()]
    assert posts == ["0   \t0.984748", "0   \t0.392030", "1   \t0.392030", "1   \t0.492374"]
    raw = build_index(collection(spark, ["apple banana apple", "banana cherry the", ""]), "raw")
    S.write_raw_text(raw, f"{scratch}/raw")
    d, p = plain_lines(f"{scratch}/raw/dictionary_raw"), plain_lines(f"{scratch}/raw/postings_raw")
    assert d == ["apple\t1\t1", "banana\t2\t3", "cherry\t1\t4", "the\t1\t5"]
    assert p == ["0 \t 2", "0 \t 1", "1 \t 1", "1 \t 1", "1 \t 1"]


def plain_lines(folder):
    """Lines of a folder's files in name order, without their headers."""
    import glob
    out = []
    for name in sorted(glob.glob(f"{folder}/part-*")):
        with open(name, encoding="utf-8", newline="\n") as f:
            out += f.read().split("\n")[1:-1]
    return out


def test_raw_offsets_point_at_postings(spark, scratch):
    pages = C.pages_collection(spark, SF_SMOKE)
    idx = build_index(pages, "raw")
    S.write_raw_text(idx, f"{scratch}/raw")
    lines = plain_lines(f"{scratch}/raw/postings_raw")
    want = {}
    for r in idx.postings.collect():
        want.setdefault(r.term, []).append((r.doc_id, r.raw_freq))
    rows = [x.rsplit("\t", 2) for x in plain_lines(f"{scratch}/raw/dictionary_raw")]
    assert len(rows) == len(want) and len(lines) == sum(map(len, want.values()))
    for term, n, end in rows:
        got = [tuple(map(int, x.split(" \t "))) for x in lines[int(end) - int(n):int(end)]]
        assert got == sorted(want[term])


def test_exports_keep_long_values(spark):
    ids = spark.createDataFrame([(12345, "12345678.html")], "doc_id long, name string")
    assert S.mapping_text(ids).first().line.split("\t") == ["12345", "12345678.html"]
    d = spark.createDataFrame([("inform", 12345, 123456789), ("infora", 1, 0)], "term string, num_docs long, start long")
    lines = [r.line.split("\t") for r in S.dictionary_text(d).collect()]
    assert [[x.strip() for x in y] for y in lines] == [["inform", "12345", "123456789"], ["infora", "1", "0"]]
    p = spark.createDataFrame([("t", 12345, 12.5)], "term string, doc_id long, weight double")
    assert S.postings_text(p).first().line == "12345\t12.500000"
