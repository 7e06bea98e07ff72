"""Distributed running totals over a sorted column.

An un-partitioned ``sum() OVER (ORDER BY s)`` moves every row into one task. Instead the rows
(already one per distinct ``s``) are range-partitioned on ``s`` into parts of bounded size and
checkpointed to the shared checkpoint folder, so the part boundaries are fixed for both uses
below even if an executor is lost and work is retried:

1. per-part totals (one row per part) -> exclusive prefix offsets over that tiny table;
2. a running sum inside each part (bounded window) plus the part's offset (broadcast of
   one row per part, a bound we choose).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_PART = 1_000_000
#: Parts beyond which smaller ones are no use: each adds samples of its bounds, and a task's results, to the driver's memory.
MOST_PARTS = 200


def part_count(rows: int, rows_per_part: int) -> int:
    """Range partitions for so many rows: parts of ``rows_per_part``, but no more than ``MOST_PARTS`` of them unless parts
    would exceed ``ROWS_PER_PART`` rows."""
    return max(1, min(-(-rows // rows_per_part), max(MOST_PARTS, -(-rows // ROWS_PER_PART))))


def running_totals(df: DataFrame, order_col: str, sum_cols: Sequence[str], descending: bool = True,
                   rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Adds ``cum_<c>`` (inclusive running sum in the given order) for every ``c`` in ``sum_cols``.

    ``df`` must hold one row per distinct ``order_col`` value (aggregate first).
    """
    # The count below and the running sums both read ``df`` (typically an aggregate over a long
    # scoring lineage). A checkpoint runs that lineage once, survives a lost executor, and is removed by
    # Spark's cleaner when no frame refers to it any more (spark.cleaner.referenceTracking.cleanCheckpoints).
    df = df.checkpoint(eager=True)
    n = df.count()
    parts = part_count(n, rows_per_part)
    o = F.col(order_col).desc() if descending else F.col(order_col).asc()
    if parts == 1:
        # Everything fits one bounded part: a single running window, no checkpoint needed.
        w = Window.partitionBy(F.lit(0)).orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({f"cum_{c}": F.sum(c).over(w) for c in sum_cols})
    ranged = (df.repartitionByRange(parts, o).withColumn("__part", F.spark_partition_id()).checkpoint(eager=True))
    totals = ranged.groupBy("__part").agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    wp = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__part", *[F.coalesce(F.sum(f"__t_{c}").over(wp), F.lit(0)).alias(f"__o_{c}")
                                        for c in sum_cols])
    w = Window.partitionBy("__part").orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranged.join(F.broadcast(offsets), "__part").withColumns(
        {f"cum_{c}": F.sum(c).over(w) + F.col(f"__o_{c}") for c in sum_cols})
    return out.drop("__part", *[f"__o_{c}" for c in sum_cols])
