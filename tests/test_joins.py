import contextlib
import re

from pyspark.sql import functions as F

from cardwatch.operators import silver as sv
from cardwatch.operators.joins import dimension_join, unique_by_key


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: What makes AQE call a partition of this test's size skewed.
SMALL = {
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "16k", "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "16k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5", "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


def _skewed(spark, scratch, hot, n=60_000):
    """Half of the fact has the key ``hot``; stored, so that it is read as a fact table is."""
    spark.range(n).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit(hot)).otherwise((F.col("id") % 500).cast("string")).alias("client_id"),
        F.md5(F.col("id").cast("string")).alias("payload")).repartition(16).write.parquet(f"{scratch}/fact")
    users = spark.range(1, 1000).select(F.pmod("id", F.lit(500)).cast("string").alias("client_id"), (F.col("id") * 10).alias("score"))
    return spark.read.parquet(f"{scratch}/fact"), users


def _check_split(spark, scratch, hot):
    with settings(spark, **SMALL):
        tx, users = _skewed(spark, scratch, hot)
        dim = unique_by_key(users, "client_id")
        joined = dimension_join(tx, dim, "client_id", "merge")
        per_task = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max("payload")).collect()]
        assert sum(per_task) == 60_000
        assert max(per_task) < 12_000  # the hot half, 30 000 rows, isn't one task
        plain = tx.join(F.broadcast(dim), "client_id", "left")
        columns = ["id", "client_id", "score"]
        assert joined.select(columns).exceptAll(plain.select(columns)).count() == 0


def test_null_keys_are_split(spark, scratch):
    _check_split(spark, scratch, None)


def test_hot_key_is_split(spark, scratch):
    _check_split(spark, scratch, "7")


def test_repeated_and_missing_dimension_keys(spark):
    tx = spark.createDataFrame([(1, "a"), (2, None), (3, "x")], "id long, k string")
    dim = spark.createDataFrame([("a", 2), ("a", 1), (None, 5)], "k string, v int")
    for strategy in (None, "merge"):
        rows = dimension_join(tx, unique_by_key(dim, "k"), "k", strategy).collect()
        assert sorted((r.id, r.v) for r in rows) == [(1, 1), (2, None), (3, None)]


def test_silver_reads_the_fact_once_whatever_the_join(spark, sf_small, scratch):
    from cardwatch import fixtures

    d = fixtures.domain(spark, sf_small)
    sv.latest_snapshot(d["transactions"]).write.parquet(f"{scratch}/tx")
    tx = spark.read.parquet(f"{scratch}/tx")
    frames = [sv.build_silver(tx, d["users"], d["cards"], d["mcc"], d["labels"], strategy=s) for s in (None, "merge")]
    for f in frames:
        plan = f._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"merchant_city#\d+[^\n]*parquet", plan)) == 1
    assert frames[0].exceptAll(frames[1]).count() == 0 and frames[1].exceptAll(frames[0]).count() == 0


def test_building_a_join_runs_no_job(spark, sf_small):
    from cardwatch import fixtures

    d = fixtures.domain(spark, sf_small)
    tx = sv.latest_snapshot(d["transactions"])
    spark.sparkContext.setJobGroup("build", "planning only")
    sv.build_silver(tx, d["users"], d["cards"], d["mcc"], d["labels"])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("build")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
