from pyspark.sql import functions as F

from cardwatch.operators import sampling


def test_split_is_a_stable_partition(spark):
    df = spark.range(5000).withColumn("label", (F.col("id") % 5 == 0).cast("int"))
    tr, te = sampling.split(df, 0.8)
    a = {r[0] for r in tr.select("id").collect()}
    b = {r[0] for r in te.select("id").collect()}
    assert not (a & b) and len(a | b) == 5000
    assert 0.75 < len(a) / 5000 < 0.85
    tr2, _ = sampling.split(df.repartition(7), 0.8)
    assert {r[0] for r in tr2.select("id").collect()} == a


def test_undersample_exact_and_majority_fraud(spark):
    df = spark.range(1000).withColumn("label", (F.col("id") % 10 < 6).cast("int"))  # 60 % fraud
    out = sampling.undersample(df)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {0: 400, 1: 400}


def test_class_weights_and_counts(spark):
    df = spark.range(100).withColumn("label", (F.col("id") < 20).cast("int"))
    c = sampling.class_counts(df).first()
    assert (c["count_0"], c["count_1"], c["minority"]) == (80, 20, 20)
    w = {r["label"]: r["class_weight"] for r in sampling.class_weights(df).select("label", "class_weight")
         .distinct().collect()}
    assert w == {0: 1.0, 1: 4.0}


def test_sample_if_large_threshold(spark):
    small = spark.range(100)
    assert sampling.sample_if_large(small, 0.3, threshold=1000).count() == 100
    assert 10 < sampling.sample_if_large(small, 0.3, threshold=10).count() < 60


def test_fraction_hex():
    assert sampling.fraction_hex(0.8) == "cccccccd"
    assert sampling.fraction_hex(0.1) == "1999999a"
