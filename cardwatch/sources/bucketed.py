"""Fact-sized tables that are stored by key, so that joins on it need no shuffle.

``save`` writes a catalog table bucketed and sorted by its key. Spark then knows how the stored rows are partitioned: a join of two such
tables with equal bucket counts, or an aggregation by the key, starts from the scan. ``insert_absent`` adds rows whose key the table
lacks: only the incoming rows are shuffled, to the table's buckets, however large the table is. It first finds which incoming
keys the table holds, as a semi join that filters the table; for a large table Spark builds a Bloom filter of the
incoming keys and applies it in the table's scan (``spark.sql.optimizer.runtime.bloomFilter.*``). For that the incoming
rows are stored first and read with their keys' range, which is also pushed down to the table's files.

The bucket count should be at least ``spark.sql.shuffle.partitions``: Spark prefers a new shuffle to fewer partitions than that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.operators.dedupe import first_of_repeated
from cardwatch.sources.positions import written

#: Bytes of a bucket that ``bucket_count`` aims at.
BUCKET_BYTES = 256 << 20


def bucket_count(spark: SparkSession, table_bytes: int) -> int:
    """Buckets for a table of this size: by its bytes, but no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-table_bytes // BUCKET_BYTES))


def save(spark: SparkSession, df: DataFrame, name: str, location: str, key: str, buckets: int) -> DataFrame:
    """Create or replace the table ``database.table`` at ``location``, bucketed and sorted by ``key``: one file a bucket."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    # rows go to the task that writes their bucket, else each task would write a file into every bucket
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").option("path", location).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def absent(table: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of ``incoming`` (one for each key) whose key ``table`` lacks. The table is never shuffled; null keys are left out."""
    low, high = incoming.agg(F.min(key), F.max(key)).first()
    if low is None:
        return incoming.limit(0)
    # the range reaches the table's scan as well, where row groups outside of it are skipped
    fresh = incoming.where(F.col(key).between(F.lit(low), F.lit(high)))
    present = table.select(key).join(fresh.select(key), key, "left_semi")
    return fresh.join(present, key, "left_anti")


def insert_absent(spark: SparkSession, name: str, incoming: DataFrame, key: str, scratch: str,
                  order: Sequence[str | Column] = ()) -> DataFrame:
    """Append the rows of ``incoming`` whose key the table ``name`` lacks; of rows with one key the first by ``order``.

    ``scratch``: a new folder of the shared storage. Returns the rows that were appended."""
    table = spark.table(name)
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    buckets = int(info["Num Buckets"])
    stored = written(first_of_repeated(incoming, [key], order).select(*table.columns), f"{scratch}/incoming")
    new = written(absent(table, stored, key), f"{scratch}/new")
    new.repartition(buckets, key).write.mode("append").option("path", info["Location"]).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return new
