"""Headline timings: index builds per profile and a whole query table.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line. Each build is what a user runs: build the index
and write it (postings, dictionary with offsets, mapping) to a scratch
folder; the searches run against the persisted indexes: ``search_many`` with
all ``benchmark`` rows against ``documents``, one query against ``pages``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from spindex.operators import tokens as T  # noqa: E402
from spindex.plans.build import build_index  # noqa: E402
from spindex.plans.search import search, search_many  # noqa: E402
from spindex.session import local_session  # noqa: E402
from spindex.sources import collection as C  # noqa: E402
from spindex.sources.index_store import read_index, write_index  # noqa: E402


def _run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    scratch = tempfile.mkdtemp(prefix="spindex-bench-", dir=os.environ.get("SPINDEX_SCRATCH", "/tmp"))
    pages = C.pages_collection(spark, sf_dir)
    documents = C.documents_collection(spark, sf_dir)
    bench = C.read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")

    # warm-up, not timed: JIT, Python workers and every code path once, on the
    # smallest tables next to the bench directory when present
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for profile in ("raw", "weighted", "stemmed"):
        write_index(build_index(C.pages_collection(spark, warm_dir), profile), f"{scratch}/warm_{profile}")
    warm_q = C.read_table(spark, warm_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    _run(search_many(read_index(spark, f"{scratch}/warm_weighted"), warm_q))
    search(read_index(spark, f"{scratch}/warm_weighted"), "the edon tion").collect()

    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        return out

    def build(coll, profile, name):
        idx = build_index(coll, profile, prune=None if profile == "raw" else "once")
        write_index(idx, f"{scratch}/{name}")

    n_tokens = timed("tokenize_documents", lambda: T.document_lexemes(documents).agg(F.sum("doc_len")).first()[0])
    timed("index_raw_pages", lambda: build(pages, "raw", "pages_raw"))
    timed("index_weighted_pages", lambda: build(pages, "weighted", "pages_weighted"))
    timed("index_stemmed_pages", lambda: build(pages, "stemmed", "pages_stemmed"))
    timed("index_weighted_documents", lambda: build(documents, "weighted", "documents_weighted"))
    timed("index_stemmed_documents", lambda: build(documents, "stemmed", "documents_stemmed"))
    idx = read_index(spark, f"{scratch}/documents_weighted")
    timed("search_many_documents", lambda: _run(search_many(idx, bench)))
    sidx = read_index(spark, f"{scratch}/documents_stemmed")
    timed("search_many_documents_stemmed", lambda: _run(search_many(sidx, bench)))
    pidx = read_index(spark, f"{scratch}/pages_weighted")
    timed("search_one_pages", lambda: search(pidx, "the edon tion").collect())

    total = round(sum(timings.values()), 3)
    print(json.dumps({
        "metric": "total_sec",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "tokens_per_sec_documents": round(n_tokens / timings["tokenize_documents"], 1) if n_tokens else None,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
