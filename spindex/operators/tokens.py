"""Token-level operators.

Tokens stay an array per document until the filters are applied, so document
lengths are array sizes (no shuffle) and filters run before the explode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import analyzer as A

PROFILES = ("raw", "weighted", "stemmed")


def document_lexemes(collection: DataFrame, analyzer: str = "full") -> DataFrame:
    """(doc_id, lexemes, doc_len): one raw lexeme per token; empty documents included."""
    lx = A.lexemes(F.col("body"), analyzer)
    return collection.select("doc_id", lx.alias("lexemes")).withColumn(
        "doc_len", F.size("lexemes").cast("long"))


def document_tokens(collection: DataFrame, analyzer: str = "full") -> DataFrame:
    """(doc_id, tokens array<string>, doc_len) for every document, empty ones included."""
    return document_lexemes(collection, analyzer).select(
        "doc_id", F.transform("lexemes", lambda x: A.token_of(x, analyzer)).alias("tokens"), "doc_len")


def token_rows(collection: DataFrame, analyzer: str = "full") -> DataFrame:
    """(doc_id, doc_len, pos, term): one row per token.

    The explode comes right after the scan, so normalizing runs per row in
    whole-stage codegen. ``explode_outer`` + filter: a plain explode makes the
    optimizer repeat the whole scan in an inferred ``size() > 0`` filter. The
    term comes out of an explode of its own: filters on it, given or inferred
    from a join, then read the column instead of normalizing the lexeme again
    (with some copies of that the generated method is too long to be compiled).
    """
    return (document_lexemes(collection, analyzer)
            .select("doc_id", "doc_len", F.posexplode_outer("lexemes").alias("pos", "lexeme"))
            .where(F.col("lexeme").isNotNull())
            .select("doc_id", "doc_len", F.col("pos").cast("long").alias("pos"),
                    # non-nullable, so no isnotnull(term) is inferred
                    F.explode(F.array(F.coalesce(A.token_of(F.col("lexeme"), analyzer), F.lit("")))).alias("term")))


def kinded_rows(collection: DataFrame, analyzer: str = "full") -> DataFrame:
    """(doc_id, kind, lexeme): one row per lexeme, ignored runs and dropped kinds
    included; an e-mail's lexeme keeps its mark, as ``token_of`` takes it.

    Kinds are told per row behind the explode, in compiled code; the kind has an
    explode of its own, so that a filter on it reads the column."""
    x = F.col("lexeme")
    return (collection.select("doc_id", F.explode_outer(A.lexemes(F.col("body"), analyzer, group=0)).alias("lexeme"))
            .where(x.isNotNull())
            .select("doc_id", F.explode(F.array(A.lexeme_kind(x, analyzer))).alias("kind"), A.kept_lexeme(x).alias("lexeme")))


def profile_rows(rows: DataFrame, profile: str) -> DataFrame:
    """The token rows a profile indexes (before stemming)."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}")
    return rows if profile == "raw" else rows.where(A.is_valid_term(F.col("term")))


def doc_length(doc_tokens: DataFrame) -> DataFrame:
    """(doc_id, doc_len): all emitted tokens, filtered ones included."""
    return doc_tokens.select("doc_id", "doc_len")


def valid_doc_length(doc_tokens: DataFrame) -> DataFrame:
    """(doc_id, valid_len): tokens left after the length and stopword filters."""
    return doc_tokens.select("doc_id", F.size(A.valid_tokens(F.col("tokens"))).cast("long").alias("valid_len"))


def corpus_size(doc_tokens: DataFrame) -> DataFrame:
    """One row: all tokens and valid tokens of the collection."""
    return doc_tokens.agg(
        F.sum("doc_len").cast("long").alias("all_tokens"),
        F.sum(F.size(A.valid_tokens(F.col("tokens")))).cast("long").alias("valid_tokens"),
        F.count(F.lit(1)).alias("documents"),
    )


def term_frequency(rows: DataFrame) -> DataFrame:
    """(doc_id, doc_len, term, raw_freq) from token rows.

    Partial aggregation runs map-side: all tokens of a document are in one
    task, so the shuffle carries distinct (doc, term) pairs, not tokens.
    """
    return rows.groupBy("doc_id", "doc_len", "term").agg(F.count(F.lit(1)).alias("raw_freq"))


def line_counts(collection: DataFrame) -> DataFrame:
    """(doc_id, lines): lines as read with universal newlines (a final break ends a line)."""
    body = F.coalesce(F.col("body"), F.lit(""))
    breaks = F.length(F.regexp_replace(body, r"\r\n|\r|\n", "x")) - F.length(F.regexp_replace(body, r"\r\n|\r|\n", ""))
    last = F.substring(body, -1, 1)
    open_tail = F.when((F.length(body) > 0) & ~last.isin("\n", "\r"), 1).otherwise(0)
    return collection.select("doc_id", (breaks + open_tail).cast("long").alias("lines"))
