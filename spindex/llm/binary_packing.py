"""Power-of-two packing: no sequence crosses documents and none is padded.

A document of n tokens is cut into n // 1024 pieces of 1024 and one piece for
each bit of the rest, longest first. Every piece is a sequence by itself;
sequences of equal length form a bucket, from which batches without padding
are drawn. Sequence ids sort by bucket, so a range of ids has one length.

Null text is an empty text (the end token alone: one piece of length 1). Rows
are packed one by one: repeated rows and null ids give their own sequences.
Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rows, columns_of, id_text, workers
from .token_ids import encoder, packed

SEQUENCE = 1024
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, bucket int"
ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                   ("doc_tokens", pa.int64()), ("bucket", pa.int32())])


def binary_lengths(n: int, longest: int = SEQUENCE) -> list[int]:
    """Powers of two that add up to n: the longest as often as it fits, then the rest's bits."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def cut(batches: Iterator[pa.RecordBatch], path: str, end_id: int, longest: int) -> Iterator[pa.RecordBatch]:
    enc, end, rows = encoder(path), packed([end_id]), Rows(ARROW)
    for batch in batches:
        for doc_id, text in columns_of(batch, "doc_id", "text"):
            ids = enc.ids(text) + end
            n, at = len(ids) // 4, 0
            for length in binary_lengths(n, longest):
                rows.add(doc_id, at, length, ids[4 * at:4 * (at + length)], n, length.bit_length() - 1,
                         weight=4 * length)
                at += length
                if rows.full():
                    yield rows.take()
    if len(rows):
        yield rows.take()


def pack(docs: DataFrame, path: str, end_id: int = 0, longest: int = SEQUENCE) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, bucket, sequence_id, offset):
    one row a piece. ``ids`` are little-endian unsigned 32-bit integers,
    ``bucket`` is log2 of the length, ``longest`` must be a power of two.

    No shuffle: a task cuts its own documents. A sequence id is the bucket
    (longest first) and the row's number within its task."""
    if longest & (longest - 1) or longest < 1:
        raise ValueError("the longest piece must be a power of two")
    workers(docs.sparkSession)
    pieces = id_text(docs).mapInArrow(partial(cut, path=path, end_id=end_id, longest=longest), SCHEMA)
    turn = (F.lit(longest.bit_length() - 1) - F.col("bucket")).cast("long")
    return (pieces.withColumn("sequence_id", F.shiftleft(turn, 56) + F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))


def write_buckets(pieces: DataFrame, out: str) -> None:
    """One folder a length: a trainer draws its batches from one folder at a time."""
    pieces.write.partitionBy("bucket").parquet(out)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "bucket")
