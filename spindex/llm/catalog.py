"""Queries of this subpackage with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (binary_packing, bitplane, feistel_shards, filter_audit, lattice_lm, line_chunks, minhash_join,
               quotient_dedup, risk_rules, simhash_bk, source_cubes, source_schedule, warc_salvage)
from .common import documents, shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op2_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_packing.digests(binary_packing.pack(documents(spark, sf_dir), vocabulary()))


@query
def op5_bitplane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_path(spark, "planes")
    manifest = bitplane.write_planes(documents(spark, sf_dir), out, vocabulary(), end_id=2)
    return bitplane.read_planes(spark, manifest, sums=True)


@query
def op4_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    manifest = warc_salvage.write_archives(pages, shared_path(spark, "warc"))
    return warc_salvage.resolved(warc_salvage.read_archives(spark, manifest), manifest)


SQL["op4_warc_salvage"] = warc_salvage.SQL


@query
def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = feistel_shards.shard(documents(spark, sf_dir), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_quotient_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotient_dedup.dedup(documents(spark, sf_dir))


SQL["op9_quotient_dedup"] = quotient_dedup.SQL


@query
def op10_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_schedule.taken(documents(spark, sf_dir))


@query
def op3_simhash_bk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_bk.groups(documents(spark, sf_dir))
    return found.select("doc_id", simhash_bk.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op1_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score(documents(spark, sf_dir), vocabulary())


@query
def op6_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return risk_rules.verdicts(documents(spark, sf_dir), labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL["op6_risk_rules"] = risk_rules.sql()


@query
def op7_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_chunks.without_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "text", F.col("_llm_lines_removed").alias("lines_removed"))


SQL["op7_line_chunks"] = line_chunks.SQL


@query
def op11_filter_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL["op11_filter_tries"] = filter_audit.SQL


@query
def op12_source_cubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_cubes.audit(documents(spark, sf_dir))


SQL["op12_source_cubes"] = source_cubes.SQL


@query
def op13_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.groups(documents(spark, sf_dir), n=4)
