"""Registered queries for model training, persistence and model scoring.

The test labels do not depend on the features, so these keys make no claim on quality. They return what another
engine can count: the rows of each part and class, the confusion matrix's total, and whether scores are in range and
a loaded model repeats the fitted one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwatch.operators import evaluate, sampling
from cardwatch.plans import keys as K
from cardwatch.plans import models
from cardwatch.plans.gold import gold_from_model
from cardwatch.session import scope_of, shared_path


def _train_report(spark, sf_dir, name):
    data = models.prepared(K.silver(spark, sf_dir), name)
    _, scored = models.fit(data, name)
    parts = data.withColumn("inside", sampling.hash_below(0.8, sampling.SALT_SPLIT))
    rows = parts.agg(*(F.count_if((F.col("inside") == inside) & (F.col("label") == label)).alias(f"{part}_{label}")
                       for part, inside in (("train", True), ("test", False)) for label in (0, 1)))
    report = evaluate.report(scored)
    in_range = F.coalesce(F.col("auc").between(0, 1), F.lit(True))
    totals = report.select((F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("matrix_total"), in_range.alias("auc_ok"))
    probabilities = scored.agg(F.coalesce(F.bool_and(F.col("fraud_probability").between(0, 1)), F.lit(True)).alias("probabilities_ok"))
    return rows.join(F.broadcast(totals)).join(F.broadcast(probabilities)).withColumn("variant", F.lit(name))  # one row each


def q_train_gbt(spark, sf_dir):
    return _train_report(spark, sf_dir, "gbt")


def q_train_rf_balanced(spark, sf_dir):
    return _train_report(spark, sf_dir, "rf_balanced")


def q_train_rf_weighted(spark, sf_dir):
    return _train_report(spark, sf_dir, "rf_medium")


def q_train_rf_basic(spark, sf_dir):
    return _train_report(spark, sf_dir, "rf_basic")


def q_model_roundtrip(spark, sf_dir):
    """Fit, save, load; gold of every silver row by both models: its columns, ``scored``, and whether they agree."""
    silver = K.silver(spark, sf_dir)
    model, _ = models.train(silver, "gbt")
    path = shared_path(spark, scope_of(sf_dir), "models", "gbt")
    models.save(model, path)
    a = gold_from_model(model, silver).select("id", F.col("fraud_probability").alias("p_fit"))
    b = gold_from_model(models.load(path), silver)
    return b.join(a, "id").select(
        "id", "client_id", "amount", "merchant_city", "merchant_state", "label", F.col("label_pred").isNotNull().alias("scored"),
        F.col("p_fit").eqNullSafe(F.col("fraud_probability")).alias("same"),
        F.coalesce(F.col("fraud_probability").between(0, 1), F.lit(True)).alias("probability_ok"))


MODEL_REGISTRY = {
    "train_gbt": q_train_gbt,
    "train_rf_balanced": q_train_rf_balanced,
    "train_rf_weighted": q_train_rf_weighted,
    "train_rf_basic": q_train_rf_basic,
    "model_roundtrip": q_model_roundtrip,
}
