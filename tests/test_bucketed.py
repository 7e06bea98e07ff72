import uuid

import pytest
from pyspark.sql import functions as F

from cardwatch.operators import silver
from cardwatch.sources import bucketed


def shuffled_scans(plan):
    """Operators below each exchange of a physical plan, as text (an adaptive plan's first form)."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            walk(node.initialPlan())
            return
        if "Exchange" in name and "Broadcast" not in name:
            found.append(node.toString())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(plan)
    return found


def plan_of(df):
    return df._jdf.queryExecution().executedPlan()


@pytest.fixture()
def merge_joins(spark):
    """Joins of large tables: nothing is broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def save(spark, scratch, df, key):
    name = f"bucketed_tests.t{uuid.uuid4().hex[:8]}"
    return name, bucketed.save(spark, df, name, f"{scratch}/{name}", key, 8)


def test_label_join_without_a_shuffle(spark, scratch, merge_joins):
    tx = spark.range(3000).selectExpr("id", "id % 7 AS v")
    labels = spark.range(0, 4000, 3).selectExpr("CAST(id AS STRING) AS transaction_id", "IF(id % 2 = 0, 'Yes', 'No') AS label")
    labels = labels.unionByName(labels.limit(50))  # repeated labels are reduced when the table is stored
    _, a = save(spark, scratch, silver.label_keyed(tx), silver.LABEL_KEY)
    _, b = save(spark, scratch, silver.labels_dim(labels), "label_transaction_id")
    joined = silver.join_labels_stored(a, b)
    assert "SortMergeJoin" in plan_of(joined).toString() and shuffled_scans(plan_of(joined)) == []
    plain = silver.join_labels(tx, labels)
    assert len(shuffled_scans(plan_of(plain))) >= 2
    assert sorted(map(tuple, joined.select("id", "v", "label").collect()), key=str) == sorted(map(tuple, plain.select("id", "v", "label").collect()), key=str)


def test_insert_shuffles_only_the_incoming_rows(spark, scratch, merge_joins):
    name, table = save(spark, scratch, spark.range(0, 5000, 2).selectExpr("id", "'old' AS v"), "id")
    incoming = spark.range(990, 1010).selectExpr("id", "'new' AS v")
    incoming.write.parquet(f"{scratch}/in")
    stored = spark.read.parquet(f"{scratch}/in")
    keys = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        new = bucketed.absent(table, stored, "id")
        text = plan_of(new).toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert not [p for p in shuffled_scans(plan_of(new)) if name.split(".")[1] in p]
    assert "GreaterThanOrEqual(id,990)" in text and "might_contain" in text  # the keys' range and their Bloom filter reach the scan
    assert sorted(r.id for r in new.collect()) == list(range(991, 1010, 2))


def test_insert_absent(spark, scratch):
    name, _ = save(spark, scratch, spark.range(0, 10).selectExpr("id", "'old' AS v", "0 AS n"), "id")
    rows = [(3, "b", 1), (12, "late", 2), (12, "first", 1), (None, "x", 1), (11, "c", 1), (3, "a", 0)]
    incoming = spark.createDataFrame(rows, "id long, v string, n int")
    new = bucketed.insert_absent(spark, name, incoming, "id", f"{scratch}/a", ["n"])
    assert sorted(map(tuple, new.collect())) == [(11, "c", 1), (12, "first", 1)]
    again = bucketed.insert_absent(spark, name, incoming, "id", f"{scratch}/b", ["n"])
    assert again.count() == 0
    got = {r.id: r.v for r in spark.table(name).collect()}
    assert got == {**{k: "old" for k in range(10)}, 11: "c", 12: "first"} and spark.table(name).count() == 12
    assert bucketed.insert_absent(spark, name, incoming.limit(0), "id", f"{scratch}/c").count() == 0
    # the table keeps its buckets
    assert shuffled_scans(plan_of(spark.table(name).groupBy("id").agg(F.count("*")))) == []


def test_bucket_count(spark):
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert bucketed.bucket_count(spark, 0) == width
    assert bucketed.bucket_count(spark, (width + 3) * bucketed.BUCKET_BYTES) == width + 3
