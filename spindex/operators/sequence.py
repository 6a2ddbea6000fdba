"""Global running sums without an unpartitioned window.

``exclusive_prefix_sum`` numbers rows (or sums a column) in a global order.
The data is range-partitioned on the order, tagged with its partition id and
written to the checkpoint folder (so both passes below see the same
partitioning, and a lost executor recomputes nothing upstream). Each
partition computes its own running sum; the per-partition totals (one row per
partition, a bounded table) give each partition's base offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def exclusive_prefix_sum(df: DataFrame, order_cols: list[str], value_col: str | None = None,
                         out_col: str = "offset", inclusive: bool = False) -> DataFrame:
    """Add ``out_col`` = sum of ``value_col`` (1 per row if None) over the rows
    before this one in ascending ``order_cols`` order (the row itself too
    when ``inclusive``). ``order_cols`` must form a unique key."""
    ensure_checkpoint_dir(df.sparkSession)
    v = F.lit(1).cast("long") if value_col is None else F.col(value_col).cast("long")
    tagged = (
        df.withColumn("_seq_v", v)
        .repartitionByRange(*order_cols)
        .withColumn("_seq_pid", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    upper = 0 if inclusive else -1
    w = Window.partitionBy("_seq_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, upper)
    within = tagged.withColumn("_seq_in", F.coalesce(F.sum("_seq_v").over(w), F.lit(0).cast("long")))
    totals = tagged.groupBy("_seq_pid").agg(F.sum("_seq_v").alias("_seq_tot"))
    # one row per partition: bounded by the partition count, safe to broadcast
    wt = Window.orderBy("_seq_pid").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_seq_pid", F.coalesce(F.sum("_seq_tot").over(wt), F.lit(0).cast("long")).alias("_seq_base"))
    return (
        within.join(F.broadcast(bases), "_seq_pid")
        .withColumn(out_col, (F.col("_seq_base") + F.col("_seq_in")).cast("long"))
        .drop("_seq_pid", "_seq_v", "_seq_in", "_seq_base")
    )
