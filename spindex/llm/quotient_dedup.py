"""Exact deduplication by counting quotient filters.

Each partition builds a counting quotient filter of its texts' 64-bit
fingerprints: a fingerprint is cut into a quotient (its bucket) and a
remainder; a bucket's run holds its remainders in order, each with a count.
Nothing is rounded, so a filter is a lossless sorted multiset. Filters are
written as ranges of quotients; all ranges with the same quotients meet in one
group, where the sorted remainders are merged and counts added. Fingerprints
counted once belong to unique texts. The rest route to byte verification: the
texts behind them are grouped by their normalised bytes.

Texts are equal when they are identical without their ASCII white space. Of
equal texts the row with the most code points in the original text stays, then
the smallest doc_id. Null text is an empty text; a null id loses every tie and
is the keep_id only of a group without any other id; repeated rows (equal id and text)
all are in their group, and all of them are kept when theirs is the row that
stays. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, lookup_join, saved, without_space, workers

#: A merged range of quotients holds about this many fingerprints.
RANGE_ROWS = 250_000
#: So many entries of a range wait for a merge at least.
MERGE_ROWS = 1_000_000
FILTER = "range_id int, quotients binary, runs binary, remainders binary, counts binary"
FILTER_ARROW = pa.schema([("range_id", pa.int32()), ("quotients", pa.binary()), ("runs", pa.binary()),
                          ("remainders", pa.binary()), ("counts", pa.binary())])
REPEATED = "fp long, copies long"
REPEATED_ARROW = pa.schema([("fp", pa.int64()), ("copies", pa.int64())])


class QuotientFilter:
    """A counting quotient filter in sorted form: the occupied quotients, how
    many remainders each one's run has, the remainders run by run, and their
    counts. ``bits`` is the width of a remainder."""

    def __init__(self, quotients, runs, remainders, counts, bits: int):
        self.quotients, self.runs, self.remainders, self.counts, self.bits = quotients, runs, remainders, counts, bits

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> QuotientFilter:
        """From fingerprints in any order, with a count each."""
        values, which = np.unique(fingerprints.astype(np.uint64), return_inverse=True)
        totals = np.zeros(len(values), np.int64)
        np.add.at(totals, which, counts)
        quotients, runs = np.unique(values >> np.uint64(bits), return_counts=True)
        return cls(quotients, runs.astype(np.int64), values & np.uint64((1 << bits) - 1), totals, bits)

    def fingerprints(self) -> np.ndarray:
        return np.repeat(self.quotients, self.runs) << np.uint64(self.bits) | self.remainders

    def count(self, fingerprint: int) -> int:
        """Copies of one fingerprint: its quotient's run is searched for the remainder."""
        q, r = fingerprint >> self.bits, fingerprint & ((1 << self.bits) - 1)
        k = int(np.searchsorted(self.quotients, np.uint64(q)))
        if k == len(self.quotients) or int(self.quotients[k]) != q:
            return 0
        start = int(self.runs[:k].sum())
        run = self.remainders[start:start + int(self.runs[k])]
        i = int(np.searchsorted(run, np.uint64(r)))
        return int(self.counts[start + i]) if i < len(run) and int(run[i]) == r else 0

    def merged(self, *others: QuotientFilter) -> QuotientFilter:
        """All multisets as one, by one ordered merge; nothing is lost."""
        every = (self, *others)
        return QuotientFilter.of(np.concatenate([x.fingerprints() for x in every]),
                                 np.concatenate([x.counts for x in every]), self.bits)

    def pieces(self, range_bits: int) -> Iterator[dict]:
        """The filter as ranges of quotients: a range is the quotient's first ``range_bits`` bits."""
        ids = (self.quotients >> np.uint64(64 - self.bits - range_bits)).astype(np.int64)
        ends = np.cumsum(self.runs)
        for i in np.unique(ids):
            a, b = np.searchsorted(ids, [i, i + 1])
            x, y = (int(ends[a - 1]) if a else 0), int(ends[b - 1])
            steps = np.diff(self.quotients[a:b], prepend=np.uint64(0))
            yield {"range_id": int(i), "quotients": int(steps[0]).to_bytes(8, "little") + packed(steps[1:]),
                   "runs": packed(self.runs[a:b]), "counts": packed(self.counts[x:y]),
                   "remainders": self.remainders[x:y].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :-(-self.bits // 8)].tobytes()}

    @classmethod
    def read(cls, row: dict, bits: int) -> QuotientFilter:
        first = np.frombuffer(row["quotients"][:8], "<u8")
        quotients = np.cumsum(np.concatenate([first, unpacked(row["quotients"][8:], np.uint64)]), dtype=np.uint64)
        raw = np.frombuffer(row["remainders"], np.uint8).reshape(-1, -(-bits // 8))
        remainders = np.zeros((len(raw), 8), np.uint8)
        remainders[:, :raw.shape[1]] = raw
        return cls(quotients, unpacked(row["runs"], np.int64), remainders.view("<u8").ravel(),
                   unpacked(row["counts"], np.int64), bits)


def packed(numbers: np.ndarray) -> bytes:
    """The width that the largest number needs (1, 2, 4 or 8 bytes), then all of them in it."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(numbers) or int(numbers.max()) < 1 << (8 * w))
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(kind)


def build(batches: Iterator[pa.RecordBatch], bits: int, range_bits: int,
          most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """A partition's filter; given out whenever ``most`` fingerprints wait."""
    waiting, n = [], 0

    def out():
        fps = np.concatenate(waiting)
        made = list(QuotientFilter.of(fps, np.ones(len(fps), np.int64), bits).pieces(range_bits))
        return pa.RecordBatch.from_pylist(made, FILTER_ARROW)

    for batch in batches:
        waiting.append(batch.column(0).to_numpy().view(np.uint64))
        n += len(waiting[-1])
        if n >= most:
            yield out()
            waiting, n = [], 0
    if n:
        yield out()


def merge(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Range by range (rows come sorted by range): the fingerprints counted more than once."""
    now, waiting, n = None, [], 0

    def out():
        held = waiting[0].merged(*waiting[1:])
        many = held.counts > 1
        return pa.RecordBatch.from_arrays([pa.array(held.fingerprints()[many].view(np.int64)),
                                           pa.array(held.counts[many])], schema=REPEATED_ARROW)

    for batch in batches:
        for row in batch.to_pylist():
            if row["range_id"] != now:
                if waiting:
                    yield out()
                now, waiting, n = row["range_id"], [], 0
            waiting.append(QuotientFilter.read(row, bits))
            n += len(waiting[-1].counts)
            # what waits is merged when it outgrows what is merged: each entry a few times, however many the pieces
            if n > max(MERGE_ROWS, 2 * len(waiting[0].counts)):
                waiting = [waiting[0].merged(*waiting[1:])]
                n = len(waiting[0].counts)
    if waiting:
        yield out()


def repeated(fingerprints: DataFrame, n: int, remainder_bits: int = 40) -> DataFrame:
    """(fp, copies) of the fingerprints that occur more than once; n is about their number."""
    range_bits = min(64 - remainder_bits, max(4, (n // RANGE_ROWS).bit_length()))
    filters = fingerprints.select("fp").mapInArrow(partial(build, bits=remainder_bits, range_bits=range_bits), FILTER)
    return (filters.repartition(1 << range_bits, "range_id").sortWithinPartitions("range_id")
            .mapInArrow(partial(merge, bits=remainder_bits), REPEATED))


def dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row a document."""
    spark = docs.sparkSession
    workers(spark)
    texts = id_text(docs).select("doc_id", F.length("text").cast("long").alias("points"),
                                 without_space(F.col("text")).alias("bare"))
    hashed = texts.select("doc_id", "points", F.xxhash64("bare").alias("fp"), F.sha2("bare", 256).alias("sha"))
    small = saved(hashed, "dedup-rows")
    twice = saved(repeated(small, small.count()), "dedup-fingerprints")
    # byte verification: texts behind repeated fingerprints, grouped by their bytes.
    # Copies are combined where they are read, so a large group moves as a few rows.
    suspects = (lookup_join(texts.withColumn("fp", F.xxhash64("bare")), twice, "fp", "copies", "inner")
                .groupBy("fp", "bare", "points").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    best = F.struct(-F.col("points"), F.col("first").isNull(), F.col("first"))
    groups = (suspects.groupBy("fp", "bare").agg(F.sum("n").alias("group_size"), F.min(best).alias("b"))
              .select(F.sha2("bare", 256).alias("sha"), "fp", "group_size", F.col("b.first").alias("keep_id"),
                      (-F.col("b.col1")).alias("keep_points")))
    groups = saved(groups.where("group_size > 1"), "dedup-groups")
    joined = lookup_join(small, groups, ["fp", "sha"], "group_size")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    stays = alone | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points")))
    return joined.select("doc_id", keep.alias("keep_id"),
                         F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                         stays.alias("kept"), F.col("sha").alias("text_sha256"))


SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare FROM documents),
     g AS (SELECT *, count(*) OVER (PARTITION BY bare) AS group_size,
                  first_value(doc_id) OVER (PARTITION BY bare ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
                  max(points) OVER (PARTITION BY bare) AS most FROM t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND points = most AS kept,
       sha256(bare) AS text_sha256 FROM g
"""
