"""Silver -> gold: score every transaction and keep the eight analyst columns.

Two scorers produce the same gold shape:
- the rule scorer (ours): probability = share of the seven explanation rules that fire,
  fraud when three or more fire. Deterministic, so gold is checkable against SQL.
- a fitted MLlib pipeline (``score_with_model``): probability of class 1 from the vector,
  read with ``vector_to_array`` (no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.rules import rule_decision, rule_probability, rules_fired
from cardwatch.functions.scalar import vector_element
from cardwatch.schemas import NUMERIC_FEATURES

GOLD_COLUMNS = ["id", "client_id", "amount", "merchant_city", "merchant_state", "label", "label_pred",
                "fraud_probability"]


def labelled(silver: DataFrame) -> DataFrame:
    """Catalog-style ``WHERE label IS NOT NULL`` (a no-op after label encoding, kept for parity)."""
    return silver.where(F.col("label").isNotNull())


def score_with_rules(df: DataFrame) -> DataFrame:
    k = F.col("rules_fired")
    return df.withColumn("rules_fired", rules_fired()).withColumns({
        "label_pred": rule_decision(k),
        "fraud_probability": rule_probability(k),
    })


def gold_from_rules(silver: DataFrame) -> DataFrame:
    return score_with_rules(labelled(silver)).select(*GOLD_COLUMNS)


def score_with_model(model, df: DataFrame, positive_index: int = 1) -> DataFrame:
    """Apply a fitted pipeline; ``prediction`` is in label space (the label is never re-indexed)."""
    # a copy has no training summary: that refers to the session, which would be sent to each task with the model (and
    # can't be, once the session has observed a write)
    scored = model.copy().transform(df)
    return scored.withColumns({
        "label_pred": F.col("prediction"),
        "fraud_probability": vector_element("probability", positive_index),
    })


def gold_from_model(model, silver: DataFrame, positive_index: int = 1) -> DataFrame:
    """Gold for every labelled silver row. A row with a NULL number can't be scored: it keeps its place with a NULL
    prediction and probability, so totals over gold are totals over silver."""
    rows = labelled(silver)
    lacks = F.lit(False)
    for c in NUMERIC_FEATURES:
        lacks = lacks | F.col(c).isNull()
    marked = rows.withColumns({"__unscored": lacks, "__amount": F.col("amount")}).withColumns(
        {c: F.coalesce(c, F.lit(0).cast(rows.schema[c].dataType)) for c in NUMERIC_FEATURES})
    scored = score_with_model(model, marked, positive_index)
    only = lambda c: F.when(~F.col("__unscored"), F.col(c))
    return scored.withColumns({"amount": F.col("__amount"), "label_pred": only("label_pred"), "fraud_probability": only("fraud_probability")}).select(*GOLD_COLUMNS)
