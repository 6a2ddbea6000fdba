"""Ranked retrieval (Q7-Q9): one plan for one query or a whole query table.

    queries -> analyzer (whole text) -> filters (lenient | strict) [-> stems]
      -> (query_id, term, mult)
      ⋈ postings (of a saved index only the folders of the terms; of one that is not, only the terms)
        [a table of queries: the postings dealt out by document first]
      -> sum(weight * mult) per (query_id, doc_id)
      -> top k per query (WindowGroupLimit both sides of the shuffle)
      -> names (mapping joined after the cut)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import fixed_decimal, score_text
from ..operators import query as Q
from .build import Index


def default_mode(index: Index) -> str:
    """The weighted query tool is lenient; the stemmed one is strict."""
    return "strict" if index.profile == "stemmed" else "lenient"


def query_plan(index: Index, queries: DataFrame, k: int = R.TOP_K, mode: str | None = None, few: bool = False) -> dict:
    """All intermediate tables of a search, keyed by operator name."""
    if index.profile == "raw":
        raise ValueError("the raw profile stores counts, not weights; build a weighted or stemmed index")
    mode = mode or default_mode(index)
    qtok = Q.query_tokens(queries, index.analyzer)
    found = Q.query_terms(qtok, mode, stemmed=index.profile == "stemmed")
    postings = index.of(found.select("term").distinct()).postings
    matches = Q.lookup(found, postings, index.buckets, few)
    scores = Q.accumulate(matches if few else Q.lookup(found, Q.by_document(found, postings, index.buckets, index.size)))
    top = Q.top_k(scores, k)
    return {"tokens": qtok, "terms": found, "matches": matches, "scores": scores, "top": top}


def search_many(index: Index, queries: DataFrame, k: int = R.TOP_K, mode: str | None = None,
                n_queries: int | None = None, few: bool = False) -> DataFrame:
    """(query_id, rank, doc_id, name, score) for a table (query_id, text).

    ``n_queries`` is a known bound on the number of queries; ``few`` says that
    all their words fit a broadcast. Nothing runs until the result is used.
    """
    plan = query_plan(index, queries, k, mode, few)
    return Q.resolve_names(plan["top"], index.mapping, bound_rows=None if n_queries is None else n_queries * k)


def search(index: Index, text: str, k: int = R.TOP_K, mode: str | None = None) -> DataFrame:
    """One query string -> (query_id=0, rank, doc_id, name, score)."""
    spark = index.postings.sparkSession
    queries = spark.createDataFrame([(0, text)], "query_id long, text string")
    return search_many(index, queries, k, mode, n_queries=1, few=True)


def result_lines(results: DataFrame, decimals: int | None = None) -> DataFrame:
    """(query_id, rank, line): the result line of the weighted stage's query
    tool, with the whole score or so many decimals."""
    score = F.col("score").cast("string") if decimals is None else fixed_decimal(F.col("score"), decimals)
    return results.select("query_id", "rank", F.concat(
        F.lit("docid: "), F.col("doc_id").cast("string"), F.lit(", document name: "), F.col("name"),
        F.lit(", weight: "), score).alias("line"))


def formatted(results: DataFrame) -> DataFrame:
    """(query_id, rank, line): ``<name> <score, 4 decimals>`` as the result list shows it."""
    return results.select("query_id", "rank",
                          F.concat_ws(" ", F.col("name"), score_text(F.col("score"))).alias("line"))
