"""Reproducible sharding: a Feistel permutation over global row numbers.

Rows are numbered 0..N-1 in order of (id, text checksum, size). A balanced
Feistel network permutes the numbers of the smallest even-bit power of two
that holds N; a number that lands at N or beyond walks the cycle on until it is
below N, which makes the network a permutation of 0..N-1. The permuted number
p gives the shard p mod S and the slot p div S, so shard sizes differ by at
most one row, slots are gapless, and the place of any row can be computed (and
inverted) from its number alone, without the data.

Null text is an empty text; null ids come first; repeated rows are numbered one
by one (rows equal in id, checksum and size are interchangeable); other columns
are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import exclusive_prefix_sum
from .common import id_text, workers

#: Modulus of the round function: products of two remainders stay below 2^62.
PRIME = (1 << 31) - 1
ROUNDS = 4


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """(multiplier, addend) a round, from a linear congruence over the seed."""
    keys, x = [], seed % PRIME
    for _ in range(rounds):
        x = (x * 48_271 + 11) % PRIME
        a = 1 + x % (PRIME - 1)
        x = (x * 48_271 + 11) % PRIME
        keys.append((a, x))
    return keys


def half_bits(n: int) -> int:
    """Bits of each half: the smallest even width whose range holds n numbers."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def mixed(x: np.ndarray, key: tuple[int, int], half: int) -> np.ndarray:
    y = (x % PRIME * key[0] + key[1]) % PRIME
    return ((y * y + key[0]) % PRIME >> 3) & ((1 << half) - 1)


def network(x: np.ndarray, keys: list[tuple[int, int]], half: int) -> np.ndarray:
    left, right = x >> half, x & ((1 << half) - 1)
    for key in keys:
        left, right = right, left ^ mixed(right, key, half)
    return left << half | right


def back(x: np.ndarray, keys: list[tuple[int, int]], half: int) -> np.ndarray:
    left, right = x >> half, x & ((1 << half) - 1)
    for key in reversed(keys):
        left, right = right ^ mixed(left, key, half), left
    return left << half | right


def walk(x: np.ndarray, n: int, seed: int, step) -> np.ndarray:
    keys, half = round_keys(seed), half_bits(n)
    x = step(np.asarray(x, np.int64), keys, half)
    while (out := x >= n).any():
        x[out] = step(x[out], keys, half)
    return x


def permuted(rows: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The permuted numbers of rows (each in 0..n-1)."""
    return walk(rows, n, seed, network)


def row_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int, seed: int) -> np.ndarray:
    """The row number at a shard and slot: the inverse of ``permuted``."""
    return walk(np.asarray(slot, np.int64) * shards + np.asarray(shard, np.int64), n, seed, back)


SCHEMA = "doc_id long, size long, text_crc32 long, row long, place long"


def place(batches: Iterator[pa.RecordBatch], n: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column(batch.schema.get_field_index("row")).to_numpy()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(permuted(rows.copy(), n, seed))],
                                         names=[*batch.schema.names, "place"])


def shard(docs: DataFrame, shards: int = 8, seed: int = 42) -> DataFrame:
    """(doc_id, size, text_crc32, row, place, shard, slot). ``size`` is the
    text's UTF-8 bytes plus 1; ``row`` the global number, ``place`` its image.
    The text is dropped before the numbering; N comes from a count."""
    workers(docs.sparkSession)
    small = id_text(docs).select("doc_id", (F.octet_length("text") + 1).cast("long").alias("size"),
                                 F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    n = docs.count()
    order = small.withColumn("_llm_null", F.col("doc_id").isNotNull())
    numbered = exclusive_prefix_sum(order, ["_llm_null", "doc_id", "text_crc32", "size"], out_col="row")
    placed = numbered.select("doc_id", "size", "text_crc32", "row").mapInArrow(partial(place, n=n, seed=seed), SCHEMA)
    return (placed.withColumn("shard", F.pmod("place", F.lit(shards)).cast("int"))
            .withColumn("slot", F.floor(F.col("place") / shards).cast("long")))

