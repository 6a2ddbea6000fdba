"""Dictionary statistics, rare-term pruning and TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRUNE_MODES = (None, "once", "tf_one")


def document_frequency(tf: DataFrame) -> DataFrame:
    """(term, num_docs, coll_freq, whole_doc) per term of (doc_id, doc_len, term, raw_freq).

    ``whole_doc`` is 1 when some posting covers its whole document
    (raw_freq = doc_len, i.e. relative tf 1.0). Partial aggregation keeps a
    frequent term to one row per map task before the shuffle.
    """
    return tf.groupBy("term").agg(
        F.count(F.lit(1)).alias("num_docs"),
        F.sum("raw_freq").cast("long").alias("coll_freq"),
        F.max((F.col("raw_freq") == F.col("doc_len")).cast("int")).alias("whole_doc"),
    )


def rare_condition(mode: str | None):
    """Condition of a term the pruning mode drops."""
    if mode is None:
        # never true (every term occurs); written on coll_freq so the term
        # statistics keep reading raw_freq and share the (doc, term) exchange
        # with the postings branch instead of re-tokenizing
        return F.col("coll_freq") < 1
    if mode == "once":          # one occurrence in the whole collection
        return (F.col("num_docs") == 1) & (F.col("coll_freq") == 1)
    if mode == "tf_one":        # one document, which consists of this term only
        return (F.col("num_docs") == 1) & (F.col("whole_doc") == 1)
    raise ValueError(f"unknown pruning mode {mode!r}")


def prune(dfs: DataFrame, mode: str | None) -> DataFrame:
    return dfs.where(~rare_condition(mode))


def collection_size(collection: DataFrame) -> DataFrame:
    """One row ``n_docs``: every document counts, also one without tokens."""
    return collection.agg(F.count(F.lit(1)).alias("n_docs"))


def idf_col(n_docs, num_docs="num_docs"):
    """1 + log10(N / num_docs); ``n_docs`` is a column or a scalar subquery."""
    return F.lit(1.0) + F.log10(n_docs.cast("double") / F.col(num_docs).cast("double"))


def n_docs_scalar(n_docs: DataFrame):
    """N as a scalar subquery of the one-row ``collection_size`` table."""
    return n_docs.select("n_docs").scalar()


def relative_tf_col():
    return F.col("raw_freq").cast("double") / F.col("doc_len").cast("double")


#: A common term is in more documents than both of these: a number, and a share of the collection.
COMMON_DOCS, COMMON_SHARE = 1000, 0.005


def join_terms(tf: DataFrame, table: DataFrame, n_docs: DataFrame, by_hash: bool = False) -> DataFrame:
    """``tf`` joined on term with a table of one row a term that has its
    ``num_docs``; ``by_hash``: without sorting ``tf`` for it, a task's share of
    the table (much less than that of ``tf``) being held in memory.

    A common term has a posting in a large share of the documents. The common
    terms are broadcast, and their postings go through the join on the rest by
    a hash of the document, so that they meet in no task. There are at most
    (mean distinct terms of a document) / COMMON_SHARE common terms, however
    large the collection is. One pass over ``tf``.
    """
    common = F.col("num_docs") > F.greatest(F.lit(float(COMMON_DOCS)), n_docs_scalar(n_docs) * COMMON_SHARE)
    facts = [c for c in table.columns if c != "term"]
    hot = table.where(common).select("term", *(F.col(c).alias(f"_hot_{c}") for c in facts))
    rest = table.where(~common).select("term", F.lit(-1).cast("long").alias("_turn"), *facts)
    turn = F.when(F.col("_hot_num_docs").isNull(), F.lit(-1).cast("long")).otherwise(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)))
    rest = rest.hint("shuffle_hash") if by_hash else rest
    joined = tf.join(F.broadcast(hot), "term", "left").withColumn("_turn", turn).join(rest, ["term", "_turn"], "left")
    joined = joined.where(F.coalesce("_hot_num_docs", "num_docs").isNotNull())
    return joined.select(*tf.columns, *(F.coalesce(f"_hot_{c}", c).alias(c) for c in facts))


def weigh(tf: DataFrame, dfs: DataFrame, n_docs: DataFrame, relative: bool = True,
          idf: bool = True) -> DataFrame:
    """Postings (term, doc_id, raw_freq, tf, weight) of the terms kept in ``dfs``.

    Common terms are joined by broadcast (``join_terms``). N enters as a scalar
    subquery of the one-row ``n_docs`` table.
    """
    return weights(counts(tf, dfs, n_docs), n_docs, relative, idf)


def counts(tf: DataFrame, dfs: DataFrame, n_docs: DataFrame, by_hash: bool = False) -> DataFrame:
    """What the weights of the postings are made of: (doc_id, doc_len, term, raw_freq, num_docs)."""
    # always true; with it each use of the postings reads raw_freq, as the term
    # statistics do, and shares their (doc, term) exchange
    return join_terms(tf.where(F.col("raw_freq") > 0), dfs.select("term", "num_docs"), n_docs, by_hash)


def weights(joined: DataFrame, n_docs: DataFrame, relative: bool = True, idf: bool = True) -> DataFrame:
    """Postings from ``counts``; further columns stay behind them."""
    tf_c = relative_tf_col() if relative else F.col("raw_freq").cast("double")
    weight = tf_c * idf_col(n_docs_scalar(n_docs)) if idf else tf_c
    more = [c for c in joined.columns if c not in ("doc_id", "doc_len", "term", "raw_freq", "num_docs")]
    return joined.select("term", "doc_id", "raw_freq", tf_c.alias("tf"), weight.alias("weight"), *more)


# Posting lists are cut into segments of this many document ids.
BLOCK_DOCS = 65536


def posting_lists(postings: DataFrame, value: str = "raw_freq", block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(term, block, postings): a term's ordered list of (doc_id, value), in
    segments by doc-id block (doc_id // block_docs); the segments in block
    order concatenate to the whole list. A row holds at most ``block_docs``
    postings, so a term found in most documents is never one unbounded row,
    and its segments are spread over tasks by the (term, block) grouping."""
    block = F.floor(F.col("doc_id") / F.lit(block_docs)).cast("long")
    return postings.groupBy("term", block.alias("block")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("doc_id"), F.col(value).alias("freq")))).alias("postings"))


def index_stats(postings: DataFrame) -> DataFrame:
    """One row: postings stored and distinct terms."""
    return postings.agg(F.count(F.lit(1)).alias("postings"), F.countDistinct("term").alias("terms"))
