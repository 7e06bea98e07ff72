import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardwatch.operators.prefix import running_totals
from cardwatch.operators.selection import hash_key, hash_order, smallest_k


@pytest.mark.parametrize("exact_limit,buckets", [(10, 4), (50, 16), (10_000, 4096)])
def test_smallest_k_matches_window(spark, exact_limit, buckets):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([0, 0, 0, 1])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, label int").withColumn("hk", hash_key(F.col("id"), "s1:"))
    k_of = lambda c: {g: min(c.get(0, 0), c.get(1, 0)) for g in c}
    got = smallest_k(df, "hk", [hash_order(F.col("id"), "s1:"), F.col("id")], k_of, group_col="label",
                     buckets=buckets, exact_limit=exact_limit)
    w = Window.partitionBy("label").orderBy(hash_order(F.col("id"), "s1:"), "id")
    n1 = sum(1 for _, lab in rows if lab == 1)
    want = df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n1)
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())
    counts = {r["label"]: r["count"] for r in got.groupBy("label").count().collect()}
    assert counts == {0: n1, 1: n1}


def test_smallest_k_with_duplicate_keys(spark):
    rows = [(i // 3, i) for i in range(300)]  # every key three times
    df = spark.createDataFrame(rows, "k bigint, v bigint")
    got = smallest_k(df, "k", [F.col("k"), F.col("v")], lambda c: {g: 100 for g in c}, buckets=4, exact_limit=20)
    assert sorted(r["v"] for r in got.collect()) == list(range(100))


def test_smallest_k_edges(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "k bigint")
    assert got_ids(smallest_k(df, "k", [F.col("k")], lambda c: {g: 0 for g in c})) == []
    assert got_ids(smallest_k(df, "k", [F.col("k")], lambda c: {g: 99 for g in c})) == list(range(10))


def got_ids(df):
    return sorted(r[0] for r in df.collect())


def test_running_totals_multi_part(spark):
    rnd = random.Random(3)
    rows = [(float(i) / 7.0, rnd.randint(0, 3), rnd.randint(0, 3)) for i in range(500)]
    df = spark.createDataFrame(rows, "score double, pos bigint, neg bigint")
    out = running_totals(df, "score", ["pos", "neg"], descending=True, rows_per_part=37).collect()
    ordered = sorted(rows, key=lambda r: -r[0])
    cp = cn = 0
    want = {}
    for s, p, n in ordered:
        cp += p
        cn += n
        want[s] = (cp, cn)
    assert {r["score"]: (r["cum_pos"], r["cum_neg"]) for r in out} == want
