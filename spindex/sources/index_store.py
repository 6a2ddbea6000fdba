"""Persisted index (S6-S9), document store (Q10) and the original text layouts.

Layout of an index under one folder:
  postings/    bucket=<n>/: term, doc_id, raw_freq, tf, weight — a term's
               postings lie in one bucket (hash of the term), sorted on (term,
               doc_id); a search reads only the folders of its terms' buckets,
               found at run time (dynamic partition pruning)
  dictionary/  term, num_docs, coll_freq, start — sorted on term in each file
  mapping/     doc_id, name — sorted on doc_id
  meta/        one row: profile, analyzer, n_docs, buckets

A document store is the collection, laid out the same way by a hash of doc_id:
the texts of k results are read from at most k folders, and no text is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import fixed_decimal, pad, pad_left
from ..operators.query import bucket_of
from ..operators.sequence import exclusive_prefix_sum
from ..plans.build import Index

# Folders of an index or a store. More folders, less to read for a search; a
# large index takes some thousands (a bucket should be some hundred MB).
BUCKETS = 64
POSTINGS = "term string, doc_id long, raw_freq long, tf double, weight double, bucket int"


def write_index(index: Index, path: str, mode: str = "overwrite", buckets: int = BUCKETS) -> None:
    """Write postings, then derive the dictionary from the written postings
    (a columnar re-read, instead of tokenizing the collection a second time).
    Counts are sorted, not weights, which are as long and don't compress."""
    order = ["bucket", "term", "doc_id"]
    rows = index.postings.select("term", "doc_id", "raw_freq", "tf", "weight") if index.counts is None else index.counts
    rows = rows.withColumn("bucket", bucket_of("term", buckets)).repartitionByRange(*order).sortWithinPartitions(*order)
    ((rows if index.counts is None else index.weigh(rows))
     .write.mode(mode).partitionBy("bucket")
     .option("parquet.bloom.filter.enabled#term", "true")
     .parquet(f"{path}/postings"))
    # an empty table leaves no file to tell the columns from
    written = index.postings.sparkSession.read.schema(POSTINGS).parquet(f"{path}/postings")
    terms = written.groupBy("term").agg(F.count(F.lit(1)).alias("num_docs"),
                                        F.sum("raw_freq").cast("long").alias("coll_freq"))
    dictionary = exclusive_prefix_sum(terms, ["term"], "num_docs", out_col="start")
    (dictionary.select("term", "num_docs", "coll_freq", "start").sortWithinPartitions("term")
     .write.mode(mode).parquet(f"{path}/dictionary"))
    (index.mapping.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
     .write.mode(mode).parquet(f"{path}/mapping"))
    (index.n_docs.select(F.lit(index.profile).alias("profile"), F.lit(index.analyzer).alias("analyzer"), "n_docs",
                         F.lit(buckets).alias("buckets"))
     .coalesce(1).write.mode(mode).parquet(f"{path}/meta"))


def read_index(spark: SparkSession, path: str) -> Index:
    meta = spark.read.parquet(f"{path}/meta")
    row = meta.first()
    dictionary = spark.read.parquet(f"{path}/dictionary")
    return Index(postings=spark.read.schema(POSTINGS).parquet(f"{path}/postings"),
                 terms=dictionary.select("term", "num_docs", "coll_freq", "start"),
                 mapping=spark.read.parquet(f"{path}/mapping"),
                 n_docs=meta.select("n_docs"), profile=row.profile, analyzer=row.analyzer, buckets=row.buckets,
                 size=row.n_docs)


@dataclass
class DocumentStore:
    """A written collection (doc_id, name, body, bucket) that is read by document."""

    documents: DataFrame
    buckets: int


def write_documents(collection: DataFrame, path: str, mode: str = "overwrite", buckets: int = BUCKETS) -> None:
    order = ["bucket", "doc_id"]
    (collection.select("doc_id", "name", "body", bucket_of("doc_id", buckets).alias("bucket"))
     .repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode(mode).partitionBy("bucket").parquet(f"{path}/documents"))
    (collection.sparkSession.range(1).select(F.lit(buckets).alias("buckets"))
     .coalesce(1).write.mode(mode).parquet(f"{path}/documents_meta"))


def read_documents(spark: SparkSession, path: str) -> DocumentStore:
    return DocumentStore(spark.read.parquet(f"{path}/documents"),
                         spark.read.parquet(f"{path}/documents_meta").first().buckets)


# --------------------------------------------------------------------------
# Text layouts of the original tools
# --------------------------------------------------------------------------
# A file's records all have one length: each field is as wide as its longest
# value (in bytes of UTF-8), at least as wide as in the original.


def widths(rows: DataFrame, fields: dict[str, tuple[Column, int]]) -> DataFrame:
    """One row: the width in bytes of each field (a text column and the least width)."""
    return rows.agg(*(F.greatest(F.lit(least), F.coalesce(F.max(F.octet_length(c)), F.lit(0))).alias(f)
                      for f, (c, least) in fields.items()))


def mapping_fields() -> dict[str, tuple[Column, int]]:
    name = F.coalesce("name", F.lit(""))
    # the extension is the part after the first dot, up to a second one
    ext = F.when(F.instr(name, ".") > 0, F.substring_index(F.substring_index(name, ".", 2), ".", -1)).otherwise(F.lit(""))
    return {"doc_id": (F.col("doc_id").cast("string"), R.WIDTH_DOC_ID),
            "base": (F.substring_index(name, ".", 1), R.WIDTH_FILE_NAME), "ext": (ext, 0)}


def dictionary_fields() -> dict[str, tuple[Column, int]]:
    return {"term": (F.col("term"), R.WIDTH_TERM), "num_docs": (F.col("num_docs").cast("string"), R.WIDTH_NUM_DOCS),
            "start": (F.col("start").cast("string"), R.WIDTH_START)}


def postings_fields() -> dict[str, tuple[Column, int]]:
    return {"doc_id": (F.col("doc_id").cast("string"), R.WIDTH_DOC_ID),
            "weight": (fixed_decimal(F.col("weight"), 6), R.WIDTH_WEIGHT)}


def _padded(rows: DataFrame, fields: dict[str, tuple[Column, int]]) -> dict[str, Column]:
    """The fields, padded to widths that are scalar subqueries of ``rows`` (no job runs before the lines are used)."""
    wide = widths(rows, fields)
    return {f: (pad_left if f == "base" else pad)(c, wide.select(f).scalar()) for f, (c, _) in fields.items()}


def mapping_text(mapping: DataFrame) -> DataFrame:
    """``<id>\\t<name before the dot, to the right>.<extension>``; a missing name is empty."""
    f = _padded(mapping, mapping_fields())
    return mapping.select("doc_id", F.concat(f["doc_id"], F.lit("\t"), f["base"], F.lit("."), f["ext"]).alias("line"))


def dictionary_text(dictionary: DataFrame) -> DataFrame:
    """``<term>\\t<num_docs>\\t<start>``."""
    f = _padded(dictionary, dictionary_fields())
    return dictionary.select("term", F.concat(f["term"], F.lit("\t"), f["num_docs"], F.lit("\t"), f["start"]).alias("line"))


def postings_text(postings: DataFrame) -> DataFrame:
    """``<doc id>\\t<weight, fixed notation>``."""
    f = _padded(postings, postings_fields())
    return postings.select("term", "doc_id", F.concat(f["doc_id"], F.lit("\t"), f["weight"]).alias("line"))


def write_text_layout(index: Index, path: str) -> None:
    """Fixed-width text files in term / id order (one part per range), and
    beside each folder a Parquet file ``<folder>_widths`` of one row: the width
    of each field and ``record``, the bytes of a record with its line end. The
    n-th record of a file begins at byte n * record."""
    dictionary = exclusive_prefix_sum(index.terms, ["term"], "num_docs", out_col="start")
    for name, rows, fields, text, order in (
            ("mapping_text", index.mapping, mapping_fields(), mapping_text, ["doc_id"]),
            ("dictionary_text", dictionary, dictionary_fields(), dictionary_text, ["term"]),
            ("postings_text", index.postings, postings_fields(), postings_text, ["term", "doc_id"])):
        wide = widths(rows, fields).withColumn("record", sum((F.col(f) for f in fields), F.lit(len(fields))))
        wide.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}_widths")
        text(rows).repartitionByRange(*order).sortWithinPartitions(*order) \
            .select("line").write.mode("overwrite").text(f"{path}/{name}")


def raw_mapping_text(mapping: DataFrame) -> DataFrame:
    """``<id> \t <name>``; a missing name is empty"""
    return mapping.select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(" \t "),
                                             F.coalesce("name", F.lit(""))).alias("line"))


def raw_dictionary_text(index: Index) -> DataFrame:
    """``<term>\t<num_docs>\t<end>``; a term's postings are the num_docs lines before ``end``."""
    d = exclusive_prefix_sum(index.terms.select("term", "num_docs"), ["term"], "num_docs", out_col="end", inclusive=True)
    return d.select("term", F.concat_ws("\t", "term", F.col("num_docs").cast("string"),
                                        F.col("end").cast("string")).alias("line"))


def raw_postings_text(index: Index) -> DataFrame:
    """``<doc id> \t <frequency>``"""
    return index.postings.select("term", "doc_id", F.concat(
        F.col("doc_id").cast("string"), F.lit(" \t "), F.col("raw_freq").cast("string")).alias("line"))


def _write_lines(df: DataFrame, order: list[str], header: str, path: str) -> None:
    """Plain lines (nothing quoted or trimmed) in order, under a header a file."""
    (df.repartitionByRange(*order).sortWithinPartitions(*order).select(F.col("line").alias(header))
     .write.mode("overwrite").option("header", True).option("sep", "\x01").option("quote", "").option("escape", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_raw_text(index: Index, path: str) -> None:
    """The raw stage's files: header rows, dictionary and postings in term
    order, so the offsets count lines of the postings files in name order."""
    _write_lines(raw_mapping_text(index.mapping), ["doc_id"], "DOCID \t FREQUENCY", f"{path}/mapping_raw")
    _write_lines(raw_dictionary_text(index), ["term"], "TERM \t NUMDOC \t START", f"{path}/dictionary_raw")
    _write_lines(raw_postings_text(index), ["term", "doc_id"], "DOCID \t FREQUENCY", f"{path}/postings_raw")
