"""The training-data pipeline: quality rules, line dedup, SimHash near-dedup,
mixing sources to target weights, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; ``run`` writes each result as Parquet in the session's shared folder and
reads it again. All but the last return the columns of ``documents``. Nulls,
empty and repeated rows, clashing columns: see the operators' modules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spindex.llm import binary_packing, line_chunks, risk_rules, simhash_bk, source_schedule
from spindex.llm.catalog import vocabulary
from spindex.llm.common import documents, shared_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return risk_rules.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go; every document stays, perhaps shorter."""
    return line_chunks.without_repeats(docs).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that with the smallest id (3-word shingles, 2 bits)."""
    return simhash_bk.first_of_groups(docs, n=3, radius=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, cut where it stops inside one."""
    return source_schedule.mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece of a document, each a sequence of a power of two tokens."""
    return binary_packing.digests(binary_packing.pack(docs, vocabulary()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing),
    ("packing", packing)]

#: The tokenizer can't be written in SQL; tests/llm hold the stages against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
