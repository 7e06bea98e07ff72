from pyspark.sql import functions as F

from cardwatch.plans import models
from cardwatch.plans.gold import score_with_model


def _synthetic(spark, n=600, fraud_share=0.6):
    """Labels that depend on a feature, so a model can learn them."""
    df = spark.range(n).select(
        F.col("id"),
        (F.col("id") % 100 * 50.0).alias("amount"),
        (F.lit(300) + F.col("id") % 500).cast("bigint").alias("credit_score"),
        (F.col("id") % 9).cast("bigint").alias("num_credit_cards"),
        (F.col("id") % 7).cast("bigint").alias("num_cards_issued"),
        F.lit(40.0).alias("latitude"), F.lit(-100.0).alias("longitude"),
        F.when(F.col("id") % 3 == 0, "No").otherwise("Yes").alias("use_chip"),
        F.lit("Visa").alias("card_brand"), F.lit("Debit").alias("card_type"), F.lit("YES").alias("has_chip"),
        F.when(F.col("id") % 2 == 0, "Male").otherwise("Female").alias("gender"),
    )
    cut = 100 * (1 - fraud_share)
    return df.withColumn("label", (F.col("id") % 100 >= cut).cast("int"))


def test_majority_fraud_prediction_stays_in_label_space(spark):
    df = _synthetic(spark)
    model = models.build_estimator(models.Variant("t", "gbt", {"maxIter": 5, "maxDepth": 3}, "balance", False)).fit(df)
    scored = score_with_model(model, df)
    acc = scored.where(F.col("label_pred") == F.col("label")).count() / df.count()
    assert acc > 0.9  # 1.0 means fraud even though fraud is the majority class
    probs = scored.agg(F.min("fraud_probability"), F.max("fraud_probability")).first()
    assert 0.0 <= probs[0] <= probs[1] <= 1.0


def test_save_load_roundtrip_and_null_policy(spark, scratch):
    df = _synthetic(spark, 300, 0.3)
    model = models.build_estimator(models.Variant("t", "rf", {"numTrees": 5, "maxDepth": 3}, "balance", False)).fit(df)
    models.save(model, scratch + "/m")
    loaded = models.load(scratch + "/m")
    a = score_with_model(model, df).select("id", F.col("fraud_probability").alias("a"))
    b = score_with_model(loaded, df).select("id", F.col("fraud_probability").alias("b"))
    assert a.join(b, "id").where(F.col("a") != F.col("b")).count() == 0
    # a NULL numeric feature follows the 'skip' policy: the row is dropped, nothing raises
    with_null = df.withColumn("credit_score", F.when(F.col("id") == 0, None).otherwise(F.col("credit_score")))
    assert score_with_model(loaded, with_null).count() == df.count() - 1
    # unseen category -> index = number of labels, no error
    unseen = df.withColumn("card_brand", F.lit("Discover"))
    assert score_with_model(loaded, unseen).count() == df.count()
