"""Mixing sources to target weights by a low-discrepancy schedule.

Sizes are words. Sources in code-point order (null last) weigh 1, 2, 3, 1, 2,
3, ...; targets share the total of all sizes by weight, stop at 3 times their
source's size, and what is above is shared again by weight until none is.

Each source's documents are shuffled (by a hash of the id), laid end to end and
cut into blocks of equal size (to one word): of ``BLOCK`` words at most, and at
least ``LEAST_BLOCKS`` of them where there are as many words. Slot t of the mix
gets the t-th van der Corput point (t's bits reversed, as a fraction), mapped
through cumulative shares of slots to a source, so any stretch of the mix holds
every source near its share. The r-th slot of a source takes its block r modulo
the number of its blocks: a source is gone through whole before any of it comes
again, and three times at most (a slot beyond that stays empty).

Sources may be as many as documents: they are numbered, summed and given their
intervals as a table, the driver sees one row a round of sharing, and points
find their interval by a sort inside cells of about ``CHUNK`` slots.

Null text is an empty text of size 0; documents of size 0 are never taken.
Null ids are shuffled like any other; repeated rows are mixed one by one; other
columns are not read (``mixed`` keeps them all). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sequence import exclusive_prefix_sum
from .common import BROADCAST_ROWS, SPACE_RE, lookup_join, saved, text_of, workers

BLOCK, LEAST_BLOCKS, MOST = 1024, 256, 3
#: Slots ranked in one window.
CHUNK = 1 << 16
#: Parts of a slot in which intervals are measured: whole numbers, so sums don't depend on their order.
UNIT = 1 << 16


@dataclass
class Sources:
    """The mix's sources. ``table`` has a saved row a source: none and source
    (null told apart), n_docs, number, base (words of sources before it),
    source_size, target, blocks, small (words of a block), larger (blocks with
    one word more), and its interval of ``share`` units from ``low`` on."""

    table: DataFrame
    units: int
    slots: int


def n_words(text: Column) -> Column:
    """Words of a text that isn't null: parts between white space, without the empty ones at its ends."""
    parts = F.size(F.split(text, SPACE_RE + "+"))
    return (parts - F.rlike(text, F.lit(r"\A" + SPACE_RE)).cast("int")
            - F.rlike(text, F.lit(SPACE_RE + r"\z|\A\z")).cast("int")).cast("long")


def water_level(total: int, weight: int, closed: Callable[[float], tuple[int, int]]) -> float:
    """The level at which sum(min(cap, level * weight)) is ``total``.
    ``closed`` gives the caps' and the weights' sums of the sources whose
    weight * level is above their cap. The level only rises, so these only
    grow; each round is a Newton step on a concave sum, and few are needed."""
    level, before = (total / weight if weight else 0.0), None
    while True:
        caps, gone = closed(level)
        if (caps, gone) == before or gone >= weight:
            return level
        level, before = max(level, (total - caps) / (weight - gone)), (caps, gone)


def source_table(sized: DataFrame, block: int = BLOCK, most: int = MOST) -> Sources:
    key = ["none", "source"]
    sums = (sized.withColumn("none", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit("")))
            .groupBy(*key).agg(F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("n_docs")))
    numbered = exclusive_prefix_sum(exclusive_prefix_sum(sums, key, out_col="number"), key, "source_size", out_col="base")
    numbered = numbered.withColumns({"weight": F.col("number") % 3 + 1, "cap": F.col("source_size") * most})
    all_ = numbered.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("weight")).first()

    def closed(level: float) -> tuple[int, int]:
        row = (numbered.where(F.col("weight") * F.lit(level) > F.col("cap"))
               .agg(F.sum("cap").alias("caps"), F.sum("weight").alias("weight")).first())
        return row.caps or 0, row.weight or 0

    level = water_level(all_.total or 0, all_.weight or 0, closed)
    n = F.col("source_size")
    words, some = (F.nullif(F.col(c), F.lit(0).cast("long")) for c in ("source_size", "blocks"))
    table = (numbered.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level)))
             .withColumn("blocks", F.least(n, F.greatest(F.ceil(n / block), F.lit(LEAST_BLOCKS).cast("long"))))
             .withColumns({"small": F.floor(n / some), "larger": n % some,
                           # a source needs target / (words of a block) slots
                           "share": F.coalesce(F.round(F.col("target") * F.col("blocks") / words * UNIT), F.lit(0)).cast("long")}))
    table = saved(exclusive_prefix_sum(table, key, "share", out_col="low").drop("weight", "cap"), "mix-sources")
    units = table.agg(F.sum("share").alias("units")).first().units or 0
    return Sources(table, units, round(units / UNIT))


def laid_out(docs: DataFrame, seed: int = 42, keep: Column | None = None, block: int = BLOCK,
             limit: int = BROADCAST_ROWS) -> tuple[DataFrame, Sources]:
    """(row, doc_id, size, number, at, keep, and facts of its source): every
    document with its place ``at`` in the shuffled words of its source, saved;
    and the sources. Up to ``limit`` sources are broadcast to the documents."""
    spark = docs.sparkSession
    workers(spark)
    keep = F.lit(None).cast("long") if keep is None else keep
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        n_words(text_of()).alias("size"), keep.alias("keep"))
    sized = saved(sized, "mix-sizes")
    sources = source_table(sized, block)
    order = (sized.withColumns({"none": F.col("source").isNull(), "source": F.coalesce("source", F.lit(""))})
             .withColumn("turn", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")))))
    placed = exclusive_prefix_sum(order, ["none", "source", "turn", "doc_id", "size", "keep"], "size", out_col="place")
    rows = (lookup_join(placed, sources.table, ["none", "source"], "n_docs", "inner", limit)
            .select(F.monotonically_increasing_id().alias("row"), "doc_id", "size", "number",
                    (F.col("place") - F.col("base")).alias("at"), "keep", "source_size", "target", "small", "larger"))
    return saved(rows, "mix-rows"), sources


def corput(t: np.ndarray) -> np.ndarray:
    """Van der Corput points of slots, exact in a double up to 2^53 slots."""
    t, u, part = t.astype(np.uint64).copy(), np.zeros(len(t)), 0.5
    while t.any():
        u += part * (t & np.uint64(1)).astype(float)
        t >>= np.uint64(1)
        part /= 2
    return u


def to_point(batches: Iterator[pa.RecordBatch], units: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        t = batch.column(0).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(np.floor(corput(t) * units).astype(np.int64))],
                                         names=["t", "point"])


def slot_sources(spark, sources: Sources, chunk: int = CHUNK) -> DataFrame:
    """(t, number, blocks): the source of each slot. Units are cut into cells of
    about ``chunk`` slots, an interval has a row in each cell that it meets,
    and a point takes the last interval begun before it in its cell."""
    width = max(1, -(-sources.units // max(1, -(-sources.slots // chunk))))
    points = (spark.range(sources.slots).select(F.col("id").alias("t"))
              .mapInArrow(partial(to_point, units=sources.units), "t long, point long"))
    points = points.select(F.floor(F.col("point") / width).alias("cell"), "point", "t",
                           F.lit(None).cast("struct<number: bigint, blocks: bigint>").alias("own"))
    first, last = F.floor(F.col("low") / width), F.floor((F.col("low") + F.col("share") - 1) / width)
    begun = (sources.table.where("share > 0").select("*", F.explode(F.sequence(first, last)).alias("cell"))
             .select("cell", F.greatest("low", F.col("cell") * width).alias("point"), F.lit(None).cast("long").alias("t"),
                     F.struct("number", "blocks").alias("own")))
    so_far = Window.partitionBy("cell").orderBy("point", F.col("t").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = points.unionByName(begun).withColumn("own", F.last("own", ignorenulls=True).over(so_far))
    return found.where("t is not null").select("t", "own.number", "own.blocks")


def schedule(spark, sources: Sources, most: int = MOST, chunk: int = CHUNK) -> DataFrame:
    """(t, number, epoch, block): the slots of the mix in order of t. Slots are
    ranked inside chunks and chunk counts summed before, so no task sees all
    slots of a source."""
    slots = saved(slot_sources(spark, sources, chunk).withColumn("chunk", F.floor(F.col("t") / chunk)), "mix-slots")
    counts = slots.groupBy("number", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("number").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("number", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("number", "chunk").orderBy("t")
    rank = F.col("before") + F.row_number().over(inside) - 1
    return (slots.join(counts, ["number", "chunk"])
            .select("t", "number", rank.alias("rank"), "blocks")
            .select("t", "number", F.floor(F.col("rank") / F.col("blocks")).alias("epoch"),
                    F.pmod("rank", "blocks").alias("block")).where(F.col("epoch") < most))


def pieces(rows: DataFrame) -> DataFrame:
    """(row, doc_id, number, block, start, stop, size, keep): each document cut
    at its source's blocks; start and stop count the document's words."""
    def block_of(x: Column) -> Column:  # the first ``larger`` blocks have one word more
        edge = F.col("larger") * (F.col("small") + 1)
        return F.when(x < edge, F.floor(x / (F.col("small") + 1))).otherwise(
            F.col("larger") + F.floor((x - edge) / F.col("small"))).cast("long")

    def begin(b: Column) -> Column:
        return b * F.col("small") + F.least(b, F.col("larger"))

    cut = rows.where("size > 0").withColumn(
        "block", F.explode(F.sequence(block_of(F.col("at")), block_of(F.col("at") + F.col("size") - 1))))
    start = F.greatest(F.lit(0), begin(F.col("block")) - F.col("at"))
    stop = F.least(F.col("size"), begin(F.col("block") + 1) - F.col("at"))
    return cut.select("row", "doc_id", "number", "block", start.alias("start"), stop.alias("stop"), "size", "keep")


def mix(docs: DataFrame, seed: int = 42, limit: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame, Sources]:
    """(the mix, the documents laid out, the sources). The mix has a row
    (t, row, doc_id, epoch, start, stop, size, keep) for each stretch of a
    document in a slot; in order of (t, row) it is what a trainer reads."""
    rows, sources = laid_out(docs, seed, limit=limit)
    return _mixed_rows(rows, sources), rows, sources


def _mixed_rows(rows: DataFrame, sources: Sources) -> DataFrame:
    slots = schedule(rows.sparkSession, sources)
    return slots.join(pieces(rows), ["number", "block"]).drop("number", "block")


def taken(docs: DataFrame, seed: int = 42, limit: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    mixed_rows, rows, _ = mix(docs, seed, limit)
    sums = mixed_rows.groupBy("row").agg(F.sum(F.col("stop") - F.col("start")).alias("taken"))
    return (rows.join(sums, "row", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed(docs: DataFrame, seed: int = 42) -> DataFrame:
    """The documents as the mix takes them, with all their columns: one row a
    document and pass, whole or (at most one document a source, in the last
    pass) the words taken, with the white space before each word. ``n_chars``
    follows the text where the column is there. The text is shuffled once."""
    names, mark = docs.columns, F.xxhash64(*[F.col(c).cast("string") for c in docs.columns])
    rows, sources = laid_out(docs, seed, keep=mark)
    passes = (_mixed_rows(rows, sources).groupBy("row", "epoch")
              .agg(F.first("doc_id").alias("_llm_id"), F.first("keep").alias("_llm_key"), F.first("size").alias("size"),
                   F.min("start").alias("start"), F.max("stop").alias("stop")))
    # rows equal in every column are told apart by their turn
    takes = F.struct("epoch", "start", "stop", "size")
    by_row = passes.groupBy("_llm_key", "row").agg(F.sort_array(F.collect_list(takes)).alias("takes"))  # MOST at most
    by_row = by_row.withColumn("_llm_turn", F.row_number().over(Window.partitionBy("_llm_key").orderBy("row")))
    own = docs.withColumn("_llm_key", mark)
    own = own.withColumn("_llm_turn", F.row_number().over(Window.partitionBy("_llm_key").orderBy("_llm_key")))
    copies = own.join(by_row.drop("row"), ["_llm_key", "_llm_turn"]).select(*names, F.explode("takes").alias("_llm_take"))
    units = F.split(F.col("text"), rf"(?<!{SPACE_RE})(?={SPACE_RE})")
    some = F.array_join(F.slice(units, F.col("_llm_take.start").cast("int") + 1,
                                (F.col("_llm_take.stop") - F.col("_llm_take.start")).cast("int")), "")
    whole = (F.col("_llm_take.start") == 0) & (F.col("_llm_take.stop") == F.col("_llm_take.size"))
    out = copies.withColumn("text", F.when(whole, F.col("text")).otherwise(some))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*names)
