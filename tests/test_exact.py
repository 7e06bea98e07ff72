import math
import random
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardwatch.functions.exact import exact_avg, exact_sum
from cardwatch.operators import views


def bits(x):
    return None if x is None else struct.pack(">d", x)


def test_equal_bits_for_every_partitioning(spark):
    rng = random.Random(1)
    rows = [(k % 5, rng.choice([0.1, 1e9, -1e9, 1 / 3, 1e-7]) * rng.random()) for k in range(4000)]
    df = spark.createDataFrame(rows, "g int, x double")
    seen = set()
    for n in (1, 7, 200):
        for seed in (0, 1):
            out = df.orderBy(F.rand(seed)).repartition(n).groupBy("g").agg(exact_avg("x").alias("m")).collect()
            seen.add(tuple(sorted((r.g, bits(r.m)) for r in out)))
    assert len(seen) == 1
    for g, m in next(iter(seen)):
        own = [Decimal(repr(x)).quantize(Decimal(1).scaleb(-18)) for h, x in rows if h == g]
        assert bits(float(sum(own)) / len(own)) == m


def test_plain_sums_do_change(spark):
    """What the exact sum is for: the same rows, other partitions, other bits."""
    df = spark.createDataFrame([(1e16 if k % 2 else 1.0,) for k in range(400)] + [(-1e16,)] * 200, "x double")
    assert df.agg(exact_sum("x")).first()[0] == 200


@pytest.mark.parametrize("values, expected", [
    ([1.5, None, 2.5], 2.0), ([None], None), ([], None), ([math.inf, 1.0], math.inf), ([-math.inf, 1.0, None], -math.inf), ([-0.0], 0.0)])
def test_odd_values(spark, values, expected):
    got = spark.createDataFrame([(v,) for v in values], "x double").agg(exact_avg("x").alias("m")).first().m
    assert got == expected


@pytest.mark.parametrize("values", [[math.nan, 1.0], [math.inf, -math.inf]])
def test_no_number(spark, values):
    assert math.isnan(spark.createDataFrame([(v,) for v in values], "x double").agg(exact_avg("x").alias("m")).first().m)


def test_views_use_them(spark):
    rng = random.Random(2)
    rows = [(str(k % 40), rng.random() * 1000, "S", "C", k % 2, float(k % 2), rng.random()) for k in range(3000)]
    gold = spark.createDataFrame(rows, "client_id string, amount double, merchant_state string, merchant_city string, label int, label_pred double, fraud_probability double")
    for view in (views.avg_amount_by_class, views.top_suspect_clients):
        one, many = (sorted(map(tuple, view(gold.repartition(n)).collect())) for n in (1, 23))
        assert one == many
