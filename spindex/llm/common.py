"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, filesystem, ship_package  # noqa: F401

#: ASCII white space; words are the runs of every other character.
SPACE = " \t\n\x0b\x0c\r"

#: The same as a regular expression, one character.
SPACE_RE = r"[\x20\x09-\x0D]"

#: A lookup table of at most this many fixed-width rows is broadcast.
BROADCAST_ROWS = 200_000
#: A key of more rows than this is hot.
HOT_ROWS = 50_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    """The text column, null as the empty string."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_text(docs: DataFrame) -> DataFrame:
    """Only (doc_id long, text string, not null): other columns, whatever
    their names, can't clash with an operator's own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def without_space(text: Column) -> Column:
    """A text without its ASCII white space."""
    for c in SPACE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def workers(spark: SparkSession) -> None:
    """What Python workers need: this package (shipped in local mode only)."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the
    lineage is cut, and a lost executor loses nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup_join(rows: DataFrame, table: DataFrame, on: str | list[str], size: str, how: str = "left",
                limit: int = BROADCAST_ROWS, hot: int = HOT_ROWS) -> DataFrame:
    """Join ``rows`` with a saved table that has one fixed-width row a key and
    knows, in column ``size``, about how many rows have it.

    Up to ``limit`` keys (counted first) the table is broadcast. Beyond that
    only the keys of more than ``hot`` rows are, of which there is at most one
    for each ``hot`` rows, and the rest is an ordinary join on the key: a key
    with a third of all rows never meets in one task."""
    if table.limit(limit + 1).count() <= limit:
        return rows.join(F.broadcast(table), on, how)
    large, rest = table.where(F.col(size) > hot), table.where(~(F.col(size) > hot))
    if large.limit(limit + 1).count() > limit:
        return rows.join(table, on, how)
    keys = [on] if isinstance(on, str) else on
    there = F.broadcast(large)
    return rows.join(there, on, "inner").unionByName(
        rows.join(F.broadcast(large.select(*keys)), on, "left_anti").join(rest, on, how))


def leave_out(docs: DataFrame, gone: DataFrame, mark: Column) -> DataFrame:
    """The documents without those in ``gone`` (doc_id, mark), with their own
    columns. ``mark`` is a hash that tells rows with one id apart. The table of
    what goes is broadcast after a check of its rows; else documents are
    joined by id and mark, of which no key is common."""
    null, own = F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    gone = saved(gone.select(null.alias("_llm_null"), own.alias("_llm_id"), F.col("mark").alias("_llm_mark"))
                 .distinct(), "left-out")
    few = gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    marked = docs.withColumns({"_llm_null": null, "_llm_id": own, "_llm_mark": mark})
    return marked.join(F.broadcast(gone) if few else gone, ["_llm_null", "_llm_id", "_llm_mark"],
                       "left_anti").select(*docs.columns)


def columns_of(batch: pa.RecordBatch, *names: str, raw: tuple[str, ...] = ()) -> Iterator[tuple]:
    """The batch's rows as tuples; string columns in ``raw`` as UTF-8 bytes."""
    cols = []
    for n in names:
        c = batch.column(batch.schema.get_field_index(n))
        cols.append((c.cast(pa.binary()) if n in raw else c).to_pylist())
    return zip(*cols, strict=True)


class Rows:
    """Collects rows for a schema and gives them out in batches of bounded size."""

    def __init__(self, schema: pa.Schema, max_bytes: int = 8 << 20, max_rows: int = 50_000):
        self.schema, self.max_bytes, self.max_rows = schema, max_bytes, max_rows
        self.clear()

    def clear(self) -> None:
        self.cols: list[list] = [[] for _ in self.schema]
        self.bytes = 0

    def add(self, *values, weight: int = 0) -> None:
        for c, v in zip(self.cols, values, strict=True):
            c.append(v)
        self.bytes += weight

    def full(self) -> bool:
        return self.bytes >= self.max_bytes or len(self.cols[0]) >= self.max_rows

    def take(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(self.cols, self.schema, strict=True)], schema=self.schema)
        self.clear()
        return out

    def __len__(self) -> int:
        return len(self.cols[0])


def crc_of_id(doc_id: int | None) -> int:
    """crc32 of an id written as text (null: of the empty text)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
