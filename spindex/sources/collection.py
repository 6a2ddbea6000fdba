"""Document collections (S1-S5): scan, natural order, dense ids, limit, mapping.

A collection is a DataFrame ``doc_id BIGINT, name STRING, body STRING``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import natural_key
from ..operators.sequence import exclusive_prefix_sum
from ..session import filesystem, ship_package

MAX_DOCS = 1750   # fixed value: the collection cap of the original indexer

# Session setting: spread a collection over this many partitions (hash of
# doc_id) before tokenizing. Leave unset when the source is already split
# finely (many row groups / files); set it for small inputs stored as a few
# unsplittable row groups, where one task would otherwise tokenize everything.
PARTITIONS_CONF = "spark.spindex.collection.partitions"


def balanced(collection: DataFrame, partitions: int | None = None) -> DataFrame:
    n = partitions or collection.sparkSession.conf.get(PARTITIONS_CONF, None)
    if not n:
        return collection
    # by a hash of the id, not the id: counts per (document, term) then still get an exchange of
    # their own, which the branches of a build share instead of tokenizing twice
    return collection.repartition(int(n), F.xxhash64("doc_id"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: ``write_files`` begins a new folder after this many files.
FOLDER_FILES = 1000


def _write_part(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    fs, root = filesystem(path)
    part, n, last, stream = f"{root}/part-{TaskContext.get().partitionId():06d}", 0, None, None
    for batch in batches:
        for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if stream is None or name != last:
                if stream is not None:
                    stream.close()
                folder = f"{part}/{n // FOLDER_FILES:06d}"
                if n % FOLDER_FILES == 0:
                    fs.create_dir(folder, recursive=True)
                stream, last, n = fs.open_output_stream(f"{folder}/{name}", compression=None), name, n + 1
            stream.write(body)
    if stream is not None:
        stream.close()
    if n:
        yield pa.RecordBatch.from_pydict({"files": [n]}, pa.schema([("files", pa.int64())]))


def write_files(named: DataFrame, path: str) -> None:
    """Write (name, body) as a directory of text files, closed by a line end; a
    partition's rows of one name (a file name, not null) share a file.

    Each task has folders of its own, of a bounded number of files, so listing
    them takes few calls; a task that runs again writes the same files. Spark's
    own writer makes a folder and a checksum file beside each of these files,
    and on a local file system starts a process for its mode."""
    ship_package(named.sparkSession)
    fs, root = filesystem(path)
    fs.create_dir(root, recursive=True)
    rows = named.select("name", F.encode(F.concat(F.coalesce("body", F.lit("")), F.lit("\n")), "utf-8").alias("body"))
    rows.sortWithinPartitions("name").mapInArrow(partial(_write_part, path=path), "files long").write.format("noop").mode("overwrite").save()


def scan_documents(spark: SparkSession, path: str, glob: str = "*.html") -> DataFrame:
    """Directory of text files -> (name, body, path); one row per file, whole
    text, read as UTF-8: what can't be decoded becomes U+FFFD. Names may repeat
    over folders, paths don't."""
    df = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True, pathGlobFilter=glob)
    return df.select(F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("name"),
                     F.make_valid_utf8("value").alias("body"),
                     F.col("_metadata.file_path").alias("path"))


def from_table(df: DataFrame, body: str | Column, name: str | Column | None = None,
               doc_id: str | Column | None = None, partitions: int | None = None,
               key: str | Column | None = None) -> DataFrame:
    """A collection from any table.

    ``doc_id`` given: taken as the dense 0-based id (the caller vouches for it).
    Otherwise ids are assigned in natural order of ``name`` (see
    ``assign_doc_ids``); names may be null or repeat. ``key`` is a column that
    is unique and not null, such as a path: with it only names are numbered and
    the ids joined to the bodies; without it the bodies move with the names.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    b, n = col(body), None if name is None else col(name)
    if doc_id is not None:
        i = col(doc_id)
        if n is None:
            n = i.cast("string")
        return balanced(df.select(i.cast("long").alias("doc_id"), n.alias("name"), b.alias("body")), partitions)
    if n is None:
        raise ValueError("a collection needs a doc_id or a name column")
    if key is None:
        numbered = assign_doc_ids(df.select(n.alias("name"), b.alias("body")))
    else:
        named = df.select(n.alias("name"), b.alias("body"), col(key).alias("_key"))
        ids = assign_doc_ids(named.select("name", "_key"), tiebreak=["_key"])
        numbered = ids.select("doc_id", "_key").join(named, "_key")
    return balanced(numbered.select("doc_id", "name", "body"), partitions)


def pages_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as a collection: name ``<page_id>.html``, body the raw html."""
    pages = read_table(spark, sf_dir, "pages")
    return from_table(pages, "html", F.concat(F.col("page_id").cast("string"), F.lit(".html")), "page_id")


def documents_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as a collection: name ``<doc_id>.txt``, body the text."""
    docs = read_table(spark, sf_dir, "documents")
    return from_table(docs, "text", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")), "doc_id")


def assign_doc_ids(names: DataFrame, name_col: str = "name", tiebreak: list[str] | None = None) -> DataFrame:
    """Dense 0-based ``doc_id`` in natural (version-sort) order of ``name_col``.

    The order is (natural key, name, tiebreak...), which must be unique.
    Numbered with a range-partitioned prefix count, never a one-task window.
    """
    tiebreak = tiebreak or []
    keyed = names.withColumn("_nk", natural_key(F.col(name_col)))
    out = exclusive_prefix_sum(keyed, ["_nk", name_col, *tiebreak], out_col="doc_id")
    return out.drop("_nk")


def limit_collection(collection: DataFrame, n: int = MAX_DOCS) -> DataFrame:
    """The first ``n`` documents in id (= natural) order; ids are dense, so a filter."""
    return collection.where(F.col("doc_id") < F.lit(n))


def limited(df: DataFrame, body: str | Column, name: str | Column, n: int = MAX_DOCS) -> DataFrame:
    """A collection of the first ``n`` rows in natural order of ``name``. Only
    they are numbered: each task keeps its first n, and n rows meet in one."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    order = ["_nk", "name"]
    first = (df.select(col(name).alias("name"), col(body).alias("body")).withColumn("_nk", natural_key(F.col("name")))
             .orderBy(*order).limit(n))
    place = F.row_number().over(Window.orderBy(*order)) - 1
    return first.select(place.cast("long").alias("doc_id"), "name", "body")


def mapping(collection: DataFrame) -> DataFrame:
    """(doc_id, name)."""
    return collection.select("doc_id", "name")
