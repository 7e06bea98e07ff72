import re

from pyspark.sql import functions as F

from cardwatch.operators import silver as sv

TX = "id bigint, date timestamp_ntz, client_id string, card_id string, amount double, use_chip string, " \
     "merchant_id string, merchant_city string, merchant_state string, zip string, mcc string, errors string"
USERS = "id bigint, gender string, credit_score bigint, num_credit_cards bigint, latitude double, " \
        "longitude double, per_capita_income string, yearly_income string, total_debt string"
CARDS = "id bigint, client_id bigint, card_brand string, card_type string, has_chip string, " \
        "num_cards_issued bigint, credit_limit string"


def _frames(spark):
    tx = spark.createDataFrame([
        (1, None, "1", "10", 50.0, "Yes", "7", "A", "S", "58523", "5411", None),
        (2, None, "NaN", "10", 20.0, "Yes", "7", "A", "S", None, "5411", "Bad PIN"),
        (3, None, None, "99", 0.0, "No", "7", "A", "S", None, "1", None),
        (4, None, "1", "10", -3.0, "No", "7", "A", "S", None, "1", None),
        (5, None, "1", "10", None, "No", "7", "A", "S", None, "1", None),
    ], TX)
    users = spark.createDataFrame([(1, "Male", 700, 2, 40.0, 1.0, "$1,000", "$2,000", "$3.5")], USERS)
    cards = spark.createDataFrame([
        (10, 1, "Visa", "Debit", "YES", 1, "$500"),
        (10, 1, "Amex", "Credit", "NO", 2, "$900"),  # duplicate card id
    ], CARDS)
    mcc = spark.createDataFrame([("5411", "Grocery")], "mcc_code string, description string")
    labels = spark.createDataFrame([("1", "Yes")], "transaction_id string, label string")
    return tx, users, cards, mcc, labels


def test_silver_edge_cases(spark):
    s = sv.build_silver(*_frames(spark)).orderBy("id").collect()
    # amount > 0 drops 0, negative and NULL amounts
    assert [r["id"] for r in s] == [1, 2]
    r1, r2 = s
    assert r1["gender"] == "Male" and r1["per_capita_income"] == 1000.0 and r1["total_debt"] == 3.5
    assert r2["gender"] is None  # "NaN" key matches nothing, raises nothing
    assert r1["description"] == "Grocery" and r1["label"] == 1 and r2["label"] == 0
    # duplicate dimension key does not fan out; the kept row is deterministic (smallest row)
    assert r1["card_brand"] == "Amex"


def test_unlabelled_drop_option(spark):
    s = sv.build_silver(*_frames(spark), unlabelled="drop")
    assert [r["id"] for r in s.collect()] == [1]


def test_latest_snapshot_prunes_partitions(spark, scratch):
    from cardwatch.schemas import TRANSACTIONS
    from cardwatch.sources import snapshots

    df = spark.createDataFrame([(1, "2025-01-01"), (2, "2025-01-02")], "id bigint, d string").select(
        "id", F.to_date("d").alias("date_insertion"))
    path = scratch + "/bronze"
    snapshots.write_snapshots(df, path)
    schema = TRANSACTIONS
    latest = snapshots.read_latest(spark, path, schema)
    assert [r["id"] for r in latest.collect()] == [2]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    # every scan, nested ones too, has the newest date as a literal partition filter: older files stay closed
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert scans and all("2025-01-02" in s for s in scans) and "ubquery" not in plan
    assert snapshots.listed_dates(spark, scratch + "/none") == []


def test_first_per_key_odd_column_names_and_key_only(spark):
    from cardwatch.operators.dedupe import first_per_key

    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, None, 1)], "k int, `it's` string, `x\\y` int")
    out = {r["k"]: (r["it's"], r["x\\y"]) for r in first_per_key(df, ["k"]).collect()}
    assert out == {1: ("a", 3), 2: (None, 1)}
    by_order = {r["k"]: r["it's"] for r in first_per_key(df, ["k"], ["x\\y"]).collect()}
    assert by_order == {1: "b", 2: None}
    assert sorted(r["k"] for r in first_per_key(df.select("k"), ["k"]).collect()) == [1, 2]
