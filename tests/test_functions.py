from pyspark.sql import functions as F

from cardwatch.functions import rules
from cardwatch.functions.scalar import class_text, id_from_text, label_to_int, missing_text_to_null, money_to_double


def test_money_parsing(spark):
    df = spark.createDataFrame([("$1,234.50",), ("$-77.00",), ("",), ("abc",), (None,)], "m string")
    got = [r[0] for r in df.select(money_to_double("m")).collect()]
    assert got == [1234.5, -77.0, None, None, None]


def test_label_encoding(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("yes",), (None,)], "l string")
    assert [r[0] for r in df.select(label_to_int("l")).collect()] == [1, 0, 0, 0]


def test_id_parse_and_nan_text(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,), ("7.9",)], "i string")
    assert [r[0] for r in df.select(id_from_text("i")).collect()] == [12, None, None, 7]
    t = spark.createDataFrame([("nan",), ("NaN",), ("58523.0",), ("",)], "z string")
    assert [r[0] for r in t.select(missing_text_to_null("z")).collect()] == [None, None, "58523.0", None]


REQ = ("amount double, credit_score double, num_credit_cards double, num_cards_issued double, "
       "latitude double, longitude double, use_chip string, gender string")


def test_rules_none_and_all(spark):
    df = spark.createDataFrame([
        (10.0, 700.0, 1.0, 1.0, 40.0, 0.0, "Yes", "Male"),
        (5000.0, 100.0, 9.0, 6.0, 60.0, 0.0, "NO", "Unknown"),
        (None, None, None, None, None, None, None, None),
    ], REQ)
    out = df.select(rules.rules_fired().alias("k"), rules.reasons().alias("r")).collect()
    assert out[0]["k"] == 0 and out[0]["r"] == [rules.NO_REASON]
    assert out[1]["k"] == 7
    assert out[1]["r"] == [
        rules.REASON_HIGH_AMOUNT, rules.REASON_LOW_CREDIT, rules.REASON_UNUSUAL_PLACE, rules.REASON_NO_CHIP,
        rules.REASON_MANY_CARDS_ISSUED, rules.REASON_TOO_MANY_CARDS, rules.REASON_UNKNOWN_GENDER]
    # NULL inputs never fire a rule and never raise
    assert out[2]["k"] == 0 and out[2]["r"] == [rules.NO_REASON]


def test_class_text(spark):
    df = spark.createDataFrame([(1.0,), (0.0,)], "p double")
    assert [r[0] for r in df.select(class_text("p")).collect()] == ["FRAUDE", "TRANSACTION NORMALE"]


def test_plan_has_no_python(spark, sf_small):
    from cardwatch.plans import keys as K

    plan = K.gold(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None
