"""spindex: inverted-file text indexing and ranked retrieval on Spark.

    from spindex import build_index, search, search_many, write_index, read_index
    from spindex.sources.collection import from_table

    docs = from_table(spark.read.parquet(".../pages.parquet"), body="html",
                      name=F.concat("page_id", F.lit(".html")), doc_id="page_id")
    index = build_index(docs, profile="weighted", prune="once")   # raw | weighted | stemmed
    write_index(index, "/data/index")                        # postings, dictionary, mapping
    results = search_many(read_index(spark, "/data/index"), queries_df)  # (query_id, text)
"""

from .plans.build import Index, build_index
from .plans.search import search, search_many
from .sources.collection import assign_doc_ids, from_table, scan_documents
from .sources.index_store import read_index, write_index

__all__ = ["Index", "build_index", "search", "search_many", "from_table", "scan_documents", "assign_doc_ids",
           "read_index", "write_index"]
