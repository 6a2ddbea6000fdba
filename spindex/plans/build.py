"""Index build (R4-R6): one DataFrame plan per profile.

    collection -> raw lexemes (array per doc, its size = doc length) -> explode
      -> normalize + filters (row level, codegen)
      -> (doc, term) counts [shuffle 1, map-side combined]
      -> [stemmed: stem the distinct vocabulary, join back, re-sum]
      -> per-term counts [partial agg] -> pruning
      -> postings ⋈ kept terms [common terms broadcast, the rest shuffled on term; one pass] × N (one row)

The dictionary's ``start`` offsets are a running sum over terms in binary
order, computed range-partitioned (see operators.sequence).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import tokens as T
from ..operators import weighting as Wt
from ..operators.sequence import exclusive_prefix_sum
from ..sources.collection import mapping


@dataclass
class Index:
    """An inverted index: postings, per-term statistics, mapping, collection size."""

    postings: DataFrame          # term, doc_id, raw_freq, tf, weight
    terms: DataFrame             # term, num_docs, coll_freq
    mapping: DataFrame           # doc_id, name
    n_docs: DataFrame            # one row: n_docs
    profile: str = "weighted"
    analyzer: str = "full"
    buckets: int | None = None   # folders of the postings of a saved index
    size: int | None = None      # n_docs of a saved index
    # of an index that is not saved: the same index of the terms in a table (term) only
    part: Callable[[DataFrame], Index] | None = None

    # the counts the postings are weighed from (term, doc_id and others), and how
    counts: DataFrame | None = None
    weigh: Callable[[DataFrame], DataFrame] | None = None
    tf: DataFrame | None = None  # what they are counted in, before pruning: doc_id, doc_len, term, raw_freq

    def of(self, wanted: DataFrame) -> Index:
        """The index as far as the terms of ``wanted`` need it. An index that is
        not saved is a plan; a search that reads off it lets the words of the
        queries through before anything is counted, shuffled or joined. N and
        the lengths of the documents are those of the whole collection."""
        return self if self.part is None else self.part(wanted)

    def dictionary(self, offset: str = "start") -> DataFrame:
        """(term, num_docs, start): ``start`` = position of the term's first
        posting in term-ordered postings. ``offset='end'`` stores the position
        after its last posting instead (the raw stage's form)."""
        out = exclusive_prefix_sum(self.terms.select("term", "num_docs"), ["term"], "num_docs",
                                   out_col=offset, inclusive=(offset == "end"))
        return out.select("term", "num_docs", offset)

    def entries(self, offset: str = "start") -> DataFrame:
        """The postings with ``num_docs`` and ``start`` (or ``end``) of their terms,
        of an index that is not saved: the dictionary is the table that the
        counts are joined with for their weights, so they are joined once."""
        joined = Wt.join_terms(self.tf, self.dictionary(offset), self.n_docs, by_hash=True)
        return self.weigh(joined.withColumn("_docs", F.col("num_docs"))).withColumnRenamed("_docs", "num_docs")


def stemmed_frequency(tf: DataFrame, n_docs: DataFrame, wanted: DataFrame | None = None,
                      by_hash: bool = False) -> DataFrame:
    """Stem the distinct vocabulary once, join it back, re-sum per (doc, stem);
    of the stems in ``wanted`` if given."""
    from ..functions.stemmer import stem

    # the vocabulary is read off tf through a filter on an aggregate of its
    # counts: a bare distinct lets the optimizer drop tf's aggregate in this
    # branch, and the tokenizing stage would run twice instead of being reused
    vocab = (tf.groupBy("term").agg(F.sum("raw_freq").alias("_cf"), F.count(F.lit(1)).alias("num_docs"))
             .where(F.col("_cf") > 0))
    # non-nullable stem: otherwise the optimizer infers isnotnull(stem(term))
    # from the joins downstream and pushes the stemmer down onto every token
    stems = vocab.select("term", "num_docs", F.coalesce(stem(F.col("term")), F.lit("")).alias("stem"))
    if wanted is not None:
        stems = stems.join(wanted.select(F.col("term").alias("stem")), "stem", "left_semi")
    return (Wt.join_terms(tf, stems, n_docs, by_hash)
            .groupBy("doc_id", "doc_len", F.coalesce("stem", F.lit("")).alias("term"))
            .agg(F.sum("raw_freq").cast("long").alias("raw_freq")))


def frequencies(collection: DataFrame, profile: str = "weighted", analyzer: str = "full",
                wanted: DataFrame | None = None, by_hash: bool = False) -> DataFrame:
    """(doc_id, doc_len, term, raw_freq) of a profile; of the terms in ``wanted`` if given."""
    rows = T.profile_rows(T.token_rows(collection, analyzer), profile)
    if profile == "stemmed":
        return stemmed_frequency(T.term_frequency(rows), Wt.collection_size(collection), wanted, by_hash)
    return T.term_frequency(rows if wanted is None else rows.join(wanted.select("term"), "term", "left_semi"))


def build_index(collection: DataFrame, profile: str = "weighted", prune: str | None = "once",
                analyzer: str = "full", wanted: DataFrame | None = None, keep: str | None = None,
                by_hash: bool = False) -> Index:
    """Build the index of a collection (doc_id, name, body); with ``wanted``, a
    table (term), the part of it that belongs to these terms. With ``keep``, a
    folder, the counts of the terms in the documents are written there first
    (one job) and read by all that follows: the dictionary's offsets take a job
    of their own, which otherwise tokenizes the collection once more.
    ``by_hash``: joins on the terms are hash joins (``weighting.join_terms``).

    ``raw``: every token, raw counts, no pruning, weight = count.
    ``weighted``: length/stopword filters, relative tf × idf, pruning.
    ``stemmed``: as weighted, with Porter stems as terms.
    """
    if profile == "raw":
        prune = None
    tf = frequencies(collection, profile, analyzer, wanted, by_hash)
    if keep is not None:
        tf.write.parquet(keep)
        tf = collection.sparkSession.read.schema(tf.schema).parquet(keep)
    dfs = Wt.prune(Wt.document_frequency(tf), prune)
    n_docs = Wt.collection_size(collection)
    weighted = profile != "raw"
    counts = Wt.counts(tf, dfs, n_docs, by_hash)
    weigh = lambda joined: Wt.weights(joined, n_docs, relative=weighted, idf=weighted)
    return Index(postings=weigh(counts), counts=counts, weigh=weigh, tf=tf, terms=dfs.select("term", "num_docs", "coll_freq"),
                 mapping=mapping(collection), n_docs=n_docs, profile=profile, analyzer=analyzer,
                 part=lambda terms: build_index(collection, profile, prune, analyzer, terms, by_hash=by_hash))
