"""Scoring requests in batch: decision text, rounded probability and rule explanations.

A request is the eleven-field record of ``schemas.REQUEST``. Many requests are scored as one
DataFrame (one job for the batch, not one per request); the same function serves a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.rules import reasons, rule_decision, rule_probability, rules_fired
from cardwatch.functions.scalar import class_text, vector_element
from cardwatch.schemas import REQUEST


def requests_from(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Typed requests out of any table carrying the eleven fields; incomplete rows are not requests."""
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in REQUEST.fields]
    return df.select(F.col(id_col), *fields).dropna(subset=[f.name for f in REQUEST.fields])


def predict(requests: DataFrame, model=None, keep=("id",)) -> DataFrame:
    """``prediction`` text, ``fraude_probabilite`` (4 digits) and ``explication`` (array of reasons).

    Without a model the rule scorer decides; with a fitted pipeline, its class-1 probability.
    """
    if model is None:
        k = F.col("__k")
        scored = requests.withColumn("__k", rules_fired()).withColumns(
            {"__pred": rule_decision(k), "__p": rule_probability(k)})
    else:
        # a copy has no training summary, which refers to the session (see gold.score_with_model)
        scored = model.copy().transform(requests).withColumns(
            {"__pred": F.col("prediction"), "__p": vector_element("probability", 1)})
    return scored.select(
        *[F.col(c) for c in keep if c in requests.columns],
        class_text("__pred").alias("prediction"),
        F.round(F.col("__p"), 4).alias("fraude_probabilite"),
        reasons().alias("explication"),
    )
