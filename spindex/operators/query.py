"""Query-side operators.

Every operator carries ``query_id``, so one plan answers a whole table of
queries. All of them are lazy: no job runs before the result is used, and
Spark picks the joins by the bytes it estimates or, at run time, measures. A
side is broadcast by hint only where its size is proven (``bound_rows``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import analyzer as A
from ..functions import rules as R
from ..session import ensure_checkpoint_dir

# Results of at most this many rows (fixed width: four numbers) are broadcast.
RESULT_ROWS = 1_000_000
# Documents whose postings meet a table of queries in one task, on an index that knows how many it has.
TASK_DOCS = 4096


def query_tokens(queries: DataFrame, analyzer: str = "full") -> DataFrame:
    """(query_id, pos, token): the document analyzer on each query text, read whole."""
    toks = A.tokens(F.col("text"), analyzer, by_line=False)
    return (queries.select("query_id", F.posexplode_outer(toks).alias("pos", "token"))
            .where(F.col("token").isNotNull())
            .withColumn("pos", F.col("pos").cast("long")))


def classify(qtokens: DataFrame) -> DataFrame:
    """Adds ``reason``: NULL for a usable token, else 'one_char' or 'stopword'
    (an empty token is reported as a stopword, as the original query tool does)."""
    reason = (F.when(A.is_valid_term(F.col("token")), F.lit(None).cast("string"))
              .when(F.length("token") == 1, F.lit("one_char"))
              .otherwise(F.lit("stopword")))
    return qtokens.withColumn("reason", reason)


def query_rejects(qtokens: DataFrame) -> DataFrame:
    """(query_id, pos, token, reason) of the tokens a lenient query drops."""
    return classify(qtokens).where(F.col("reason").isNotNull())


def query_terms(qtokens: DataFrame, mode: str = "lenient", stemmed: bool = False) -> DataFrame:
    """(query_id, term, mult): usable terms with their multiplicity.

    ``lenient`` drops bad tokens; ``strict`` drops the whole query when any
    token is bad. ``stemmed`` stems the kept terms.
    """
    c = classify(qtokens)
    if mode == "strict":
        bad = c.groupBy("query_id").agg(F.max(F.col("reason").isNotNull().cast("int")).alias("_bad"))
        c = c.join(bad.where(F.col("_bad") == 0).select("query_id"), "query_id", "left_semi")
    elif mode != "lenient":
        raise ValueError(f"unknown query mode {mode!r}")
    kept = c.where(F.col("reason").isNull())
    term = F.col("token")
    if stemmed:
        from ..functions.stemmer import stem
        term = stem(term)
    # an expression, not the column: otherwise what holds for the tokens is inferred for the terms of the
    # postings they meet, whose tokenizing stage then differs from that of the term statistics and runs twice
    return kept.groupBy("query_id", F.coalesce(term, F.lit("")).alias("term")).agg(F.count(F.lit(1)).alias("mult"))


def bucket_of(key: str, buckets: int) -> Column:
    """The folder of a saved index or document store in which a key lies."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def lookup(qterms: DataFrame, postings: DataFrame, buckets: int | None = None, few: bool = False) -> DataFrame:
    """(query_id, term, mult, doc_id, weight): postings of each query term.

    On a saved index (``buckets`` folders) the terms' folders are part of the
    join key: Spark prunes the others when the terms are known, at run time, if
    it broadcasts them: where it estimates them to be small, or if the caller
    knows that they are ``few``, such as the words of one text. A query table
    too large for that reads most folders anyway."""
    if buckets is None:
        return qterms.join(postings.select("term", "doc_id", "weight", *(p for p in PARTS if p in postings.columns)), "term")
    # the comparison is always true: Spark prunes by a side only if it sees a selective condition on it
    placed = qterms.withColumn("bucket", bucket_of("term", buckets)).where(F.col("bucket") >= 0)
    return (F.broadcast(placed) if few else placed).join(postings.select("bucket", "term", "doc_id", "weight"), ["bucket", "term"]).drop("bucket")


def by_document(qterms: DataFrame, postings: DataFrame, buckets: int | None = None, n_docs: int | None = None) -> DataFrame:
    """The postings of all query terms, dealt out by document.

    A posting meets many queries. Dealt out before that, all matches of a
    document arise in one task and are summed there: none is shuffled, and a
    task's sums are those of its documents. The number of partitions is given,
    as the postings' size does not tell that of the matches; with ``n_docs``,
    the number of documents of a saved index, a task has about ``TASK_DOCS`` of
    them at most, however large the index is."""
    wanted = qterms.select("term").distinct()
    if buckets is None:
        own = postings.select("term", "doc_id", "weight")
    else:
        placed = wanted.withColumn("bucket", bucket_of("term", buckets)).where(F.col("bucket") >= 0)
        own = postings.select("bucket", "term", "doc_id", "weight").join(placed, ["bucket", "term"], "left_semi").drop("bucket")
    tasks = max(int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(n_docs or 0) // TASK_DOCS))
    dealt = own.repartition(tasks, "doc_id")
    return dealt.select("*", *(c.alias(p) for p, c in zip(PARTS, parts(F.col("weight")))))


def missing_terms(qterms: DataFrame, terms: DataFrame) -> DataFrame:
    """(query_id, term): query terms no document contains.

    The dictionary meets the distinct query terms first; only those present are
    anti-joined."""
    wanted = qterms.select("term").distinct()
    present = terms.select("term").join(wanted, "term", "left_semi")
    return qterms.select("query_id", "term").join(present, "term", "left_anti")


def accumulate(matches: DataFrame) -> DataFrame:
    """(query_id, doc_id, score): summed weights; a repeated query word counts
    each time. The sum is taken in decimals, where the order of the terms
    doesn't matter, so equal documents get equal scores; matches that bring the
    ``PARTS`` of their weights (``by_document``) get the same sums from longs."""
    term = F.col("weight") * F.col("mult")
    if not set(PARTS) <= set(matches.columns):
        return matches.groupBy("query_id", "doc_id").agg(F.sum(term.cast("decimal(38,18)")).cast("double").alias("score"))
    each = [F.sum(F.when(F.col("mult") == 1, F.col(p)).otherwise(c)).alias(p) for p, c in zip(PARTS, parts(term))]
    return matches.groupBy("query_id", "doc_id").agg(*each).select("query_id", "doc_id", joined_parts().alias("score"))


# A decimal(38,18) as three longs: what stands before the point, and the first and the last nine digits behind it.
PARTS = ["_whole", "_high", "_low"]
_NINE = 10**9


def parts(value: Column) -> list[Column]:
    """The three parts of a number below 10**12, rounded to 18 decimals."""
    d = value.cast("decimal(38,18)").cast("decimal(30,18)")
    whole = d.cast("long")
    behind = (d - whole.cast("decimal(12,0)")).cast("decimal(18,18)") * F.lit(_NINE)
    high = behind.cast("long")
    low = ((behind - high.cast("decimal(10,0)")).cast("decimal(9,9)") * F.lit(_NINE)).cast("long")
    return [whole, high, low]


def joined_parts() -> Column:
    """The number that sums of ``PARTS`` make, as a double."""
    whole, high, low = PARTS
    digits = F.expr(f"({high} + {low} div {_NINE}) % {_NINE} * {_NINE} + {low} % {_NINE}")
    before = F.expr(f"{whole} + ({high} + {low} div {_NINE}) div {_NINE}")
    behind = (digits.cast("decimal(18,0)") * F.lit(Decimal("1e-18"))).cast("decimal(18,18)")
    return (before.cast("decimal(12,0)") + behind).cast("double")


def top_k(scores: DataFrame, k: int = R.TOP_K) -> DataFrame:
    """(query_id, rank, doc_id, score): best k per query, by the full score,
    then doc id descending.

    ``row_number() <= k`` becomes a WindowGroupLimit on both sides of the
    shuffle, so a query with many candidates sends only k rows per task.
    """
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").desc())
    return (scores.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score"))


def _with_rows(results: DataFrame, table: DataFrame, bound_rows: int | None, on: str | list[str] = "doc_id") -> DataFrame:
    """Join ``table`` (keyed by doc_id) to ``results`` after the top-k cut."""
    small = bound_rows is not None and bound_rows <= RESULT_ROWS
    return (F.broadcast(results) if small else results).join(table, on)


def resolve_names(top: DataFrame, mapping: DataFrame, bound_rows: int | None = None) -> DataFrame:
    """Adds ``name`` after the top-k cut; ``bound_rows`` is a proven bound on ``top``."""
    return _with_rows(top, mapping.select("doc_id", "name"), bound_rows).select(
        "query_id", "rank", "doc_id", "name", "score")


def result_preview(results: DataFrame, collection: DataFrame, chars: int | None = None,
                   bound_rows: int | None = None, buckets: int | None = None) -> DataFrame:
    """Adds ``preview``: the text of each result document (first ``chars``
    characters if given), fetched after the top-k cut.

    The documents of a store (``buckets`` folders, see ``sources.index_store``)
    are read from the folders of the results only. For that the results, some
    numbers a row, are computed first and written to the checkpoint folder (the
    one job that runs here); with ``bound_rows``, a proven bound such as k *
    queries, they are broadcast and no text moves."""
    body = F.col("body") if chars is None else F.substring("body", 1, chars)
    if buckets is None:
        return _with_rows(results, collection.select("doc_id", body.alias("preview")), bound_rows)
    ensure_checkpoint_dir(results.sparkSession)
    placed = results.checkpoint().withColumn("bucket", bucket_of("doc_id", buckets)).where(F.col("bucket") >= 0)
    return _with_rows(placed, collection.select("bucket", "doc_id", body.alias("preview")), bound_rows,
                      ["bucket", "doc_id"]).drop("bucket")


def queries_without_results(queries: DataFrame, results: DataFrame) -> DataFrame:
    """(query_id, text) of the queries with no result row."""
    return queries.select("query_id", "text").join(results.select("query_id"), "query_id", "left_anti")
