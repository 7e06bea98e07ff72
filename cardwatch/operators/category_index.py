"""Category indexes without a driver-side list of values.

A value's index is its place among the column's values by count (largest first), then alphabetically. Counts of all
columns come from one pass; they are sorted by range partitions over all tasks, and the places before a partition are
added to the places in it (``prefix.running_totals`` does that for sums of ones). The index is a table that is joined: it may
have as many rows as the data. NULL and values that weren't seen get the number of values, as MLlib's
``StringIndexer(handleInvalid="keep", stringOrderType="frequencyDesc")`` gives them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.operators.prefix import ROWS_PER_PART, part_count


def category_index(df: DataFrame, columns: Sequence[str], rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """(column, value, idx double, n_values) for each value of the text columns, checkpointed."""
    pairs = ", ".join(f"struct('{c}' AS column, CAST(`{c}` AS STRING) AS value)" for c in columns)
    counts = df.select(F.explode(F.expr(f"array({pairs})")).alias("p")).select("p.*").where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.checkpoint()
    parts = part_count(counts.count(), rows_per_part)
    order = [F.col("column"), F.col("n").desc(), F.col("value")]
    dealt = counts.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()).checkpoint()
    # one row for each part and column: places of a column's values in the parts before
    sizes = dealt.groupBy("column", "part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumns({"start": F.coalesce(F.sum("size").over(before), F.lit(0)), "n_values": F.sum("size").over(Window.partitionBy("column"))}).drop("size")
    inside = Window.partitionBy("column", "part").orderBy(F.col("n").desc(), "value")
    placed = dealt.withColumn("at", F.row_number().over(inside)).join(starts, ["column", "part"])
    return placed.selectExpr("column", "value", "CAST(start + at - 1 AS DOUBLE) AS idx", "n_values").checkpoint()


def with_index(df: DataFrame, index: DataFrame, columns: Sequence[str], suffix: str = "_idx") -> DataFrame:
    """Add ``<column>_idx`` for each column. The planner broadcasts a column's index or shuffles, by its size."""
    for c in columns:
        own = index.where(F.col("column") == c)
        size = F.coalesce(own.select(F.max("n_values")).scalar(), F.lit(0)).cast("double")
        values = own.select(F.col("value").alias("__value"), F.col("idx").alias("__idx"))
        df = df.join(values, F.col(c).cast("string") == F.col("__value"), "left").withColumn(c + suffix, F.coalesce("__idx", size)).drop("__value", "__idx")
    return df
