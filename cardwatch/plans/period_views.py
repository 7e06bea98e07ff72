"""The analyst views kept up by period, without a scan of all of gold.

For each period (a day, or any text derived from the transaction's date) partial results are stored: counts, hits and
exact sums by city, by class and by client. A period that changes is replaced (dynamic partition overwrite), the others'
files stay; reading merges the partial rows. Exact sums make the merged means equal, to the bit, those over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions.exact import SUM_TYPE, as_double, exact_sum, special_sum
from cardwatch.operators.views import TOP_CLIENTS

PERIOD = "period"
#: View -> (keys, column that is averaged).
PARTIALS = {"city": (("merchant_state", "merchant_city"), None), "class": (("label_pred",), "amount"), "client": (("client_id",), "fraud_probability")}


def _figures(averaged: str | None) -> list:
    hits = F.sum(F.when(F.col("label_pred") == 1, 1).otherwise(0))
    out = [F.count(F.lit(1)).alias("n"), hits.alias("hits")]
    return out + ([exact_sum(averaged).alias("total"), special_sum(averaged).alias("special"), F.count(averaged).alias("n_total")] if averaged else [])


def write_periods(gold: DataFrame, path: str) -> None:
    """Store the partial results of the periods in ``gold`` (its columns and ``period``); other periods stay as they are."""
    for name, (keys, averaged) in PARTIALS.items():
        rows = gold.groupBy(PERIOD, *keys).agg(*_figures(averaged))
        (rows.repartition(PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(f"{path}/{name}"))


def _merged(spark: SparkSession, path: str, name: str) -> DataFrame:
    keys, averaged = PARTIALS[name]
    types = {"label_pred": "double"}
    more = f", total {SUM_TYPE}, special double, n_total bigint" if averaged else ""
    schema = ", ".join(f"{k} {types.get(k, 'string')}" for k in keys) + f", n bigint, hits bigint{more}, {PERIOD} string"
    rows = spark.read.schema(schema).parquet(f"{path}/{name}")
    sums = [F.sum("n").alias("n"), F.sum("hits").alias("hits")]
    if averaged:
        mean = as_double(F.sum("total").cast(SUM_TYPE), F.sum("special")) / F.sum("n_total")
        sums.append(mean.alias("mean"))
    return rows.groupBy(*keys).agg(*sums)


def global_fraud_rate(spark: SparkSession, path: str) -> DataFrame:
    whole = _merged(spark, path, "class").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_transactions"), F.sum("hits").alias("total_fraudes"))
    return whole.withColumn("taux_fraude_percent", F.expr("round(try_divide(100.0D * total_fraudes, total_transactions), 2)"))


def fraud_by_city_state(spark: SparkSession, path: str) -> DataFrame:
    return _merged(spark, path, "city").selectExpr("merchant_state", "merchant_city", "n AS total_transactions", "hits AS nb_fraudes")


def avg_amount_by_class(spark: SparkSession, path: str) -> DataFrame:
    return _merged(spark, path, "class").selectExpr("label_pred AS est_fraude", "n AS nb_trans", "round(mean, 2) AS montant_moyen")


def top_suspect_clients(spark: SparkSession, path: str, k: int = TOP_CLIENTS) -> DataFrame:
    rows = _merged(spark, path, "client").selectExpr("client_id", "n AS nb_trans", "round(mean, 4) AS moyenne_proba", "hits AS nb_fraudes")
    return rows.orderBy(F.col("moyenne_proba").desc_nulls_first(), F.col("client_id").asc()).limit(k)
