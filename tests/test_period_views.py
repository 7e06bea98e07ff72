import glob
import os
import random

from cardwatch.operators import views
from cardwatch.plans import period_views as pv

GOLD = "id long, client_id string, amount double, merchant_city string, merchant_state string, label int, label_pred double, fraud_probability double, period string"


def gold(spark, seed, periods):
    rng = random.Random(seed)
    rows = [(k, rng.choice(["1", "2", "3", None]), rng.choice([10.25, 0.1, None, 3.3]), rng.choice(["C", "D", None]), "S", 0,
             rng.choice([0.0, 1.0, None]), rng.choice([0.3, 1 / 3, None]), rng.choice(periods)) for k in range(500)]
    return spark.createDataFrame(rows, GOLD)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def same_as_scan(spark, path, whole):
    assert rows(pv.global_fraud_rate(spark, path)) == rows(views.global_fraud_rate(whole))
    assert rows(pv.fraud_by_city_state(spark, path)) == rows(views.fraud_by_city_state(whole))
    assert rows(pv.avg_amount_by_class(spark, path)) == rows(views.avg_amount_by_class(whole))
    assert pv.top_suspect_clients(spark, path).collect() == views.top_suspect_clients(whole).collect()


def files(path):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(path + "/*/period=*/*.parquet")}


def test_one_changed_period_rewrites_only_its_part(spark, scratch):
    first = gold(spark, 1, ["2025-01", "2025-02", "2025-03"])
    pv.write_periods(first, scratch + "/v")
    same_as_scan(spark, scratch + "/v", first)
    before = files(scratch + "/v")
    change = gold(spark, 2, ["2025-02"])
    pv.write_periods(change, scratch + "/v")
    after = files(scratch + "/v")
    kept = {p: t for p, t in before.items() if "2025-02" not in p}
    assert kept and all(after[p] == t for p, t in kept.items())
    assert not {p for p in before if "2025-02" in p} & {*after}
    same_as_scan(spark, scratch + "/v", first.where("period <> '2025-02'").unionByName(change))


def test_a_new_period_is_added(spark, scratch):
    a, b = gold(spark, 3, ["2025-01"]), gold(spark, 4, ["2025-02"])
    for part in (a, b):
        pv.write_periods(part, scratch + "/v")
    same_as_scan(spark, scratch + "/v", a.unionByName(b))
