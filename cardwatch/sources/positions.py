"""Where a row stands in its file.

Spark deals the splits of several files out by size, so the order of a scan isn't the order of the files. ``with_place``
keys each row by its file's name, its split's start and its place in the split, which sorts rows as the files have them
whatever the splits' sizes. ``numbered`` adds line numbers: splits are counted, and the counts before a split are
added to the place in it. Only these counts (one row a split) pass a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PLACE = "place"
#: Rows of a side that is broadcast once they are counted (splits or files: about 200 bytes each).
FEW = 200_000
#: Sorts like (file name, offset): the parts of ``place``.
PLACE_TYPE = "struct<file:string,start:bigint,at:bigint>"


def with_place(df: DataFrame, name: str = PLACE) -> DataFrame:
    """Add ``name``: struct(file, start, at). ``df`` must be a read of files, at most narrowed since (select, where)."""
    return df.select("*", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        # rows of a split follow each other in one task
        F.monotonically_increasing_id().alias("at")).alias(name))


def is_file_read(df: DataFrame) -> bool:
    """Whether the rows come from the files of one read, so that Spark knows the file of each."""
    hidden = df._jdf.queryExecution().analyzed().metadataOutput()
    return sum(hidden.apply(k).name() == "_metadata" for k in range(hidden.size())) == 1


def numbered(stored: DataFrame, name: str = "line", place: str = PLACE) -> DataFrame:
    """Replace ``place`` by ``file`` and the row's number in its file, from 1. ``stored`` must be a written table: its
    places are read twice and have to be the same."""
    split = [F.col(f"{place}.file").alias("__file"), F.col(f"{place}.start").alias("__start")]
    splits = stored.groupBy(*split).agg(F.count(F.lit(1)).alias("__n"), F.min(f"{place}.at").alias("__first"))
    before = Window.partitionBy("__file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    joined = stored.join(if_few(offsets), (F.col(f"{place}.file") == F.col("__file")) & (F.col(f"{place}.start") == F.col("__start")))
    number = F.col("__before") + F.col(f"{place}.at") - F.col("__first") + 1
    return joined.withColumns({"file": F.col("__file"), name: number}).drop(place, "__file", "__start", "__first", "__before")


def if_few(df: DataFrame, most: int = FEW) -> DataFrame:
    """Broadcast ``df`` if it has at most ``most`` rows, so that the other side of a join needn't be shuffled."""
    return F.broadcast(df) if df.count() <= most else df


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and go on from the files."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
