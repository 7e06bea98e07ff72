"""The four analyst views over the scored gold table.

Each is a single hash aggregate with map-side partial aggregation, so a hot client or city is
combined before the shuffle; the top-k view plans as ``TakeOrderedAndProject`` (per-partition
top 100, then a merge) rather than a global sort. Means are of exact sums, so they don't depend on the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.exact import exact_avg

TOP_CLIENTS = 100


def _frauds() -> Column:
    # sum(case ...) rather than count_if: NULL on empty input, as the SQL view defines it.
    return F.sum(F.when(F.col("label_pred") == 1, F.lit(1)).otherwise(F.lit(0)))


def global_fraud_rate(gold: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    s = _frauds()
    return gold.agg(
        n.alias("total_transactions"),
        s.alias("total_fraudes"),
        F.round(F.try_divide(F.lit(100.0) * s, n), 2).alias("taux_fraude_percent"),
    )


def fraud_by_city_state(gold: DataFrame) -> DataFrame:
    return gold.groupBy("merchant_state", "merchant_city").agg(
        F.count(F.lit(1)).alias("total_transactions"), _frauds().alias("nb_fraudes"))


def avg_amount_by_class(gold: DataFrame) -> DataFrame:
    return gold.groupBy(F.col("label_pred").alias("est_fraude")).agg(
        F.count(F.lit(1)).alias("nb_trans"), F.round(exact_avg("amount"), 2).alias("montant_moyen"))


def top_suspect_clients(gold: DataFrame, k: int = TOP_CLIENTS) -> DataFrame:
    """Clients by mean fraud probability, highest first; NULL means first, ties by client id."""
    agg = gold.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("nb_trans"),
        F.round(exact_avg("fraud_probability"), 4).alias("moyenne_proba"),
        _frauds().alias("nb_fraudes"),
    )
    return agg.orderBy(F.col("moyenne_proba").desc_nulls_first(), F.col("client_id").asc()).limit(k)


VIEW_NAMES = {
    "v_taux_fraude_global": global_fraud_rate,
    "v_fraude_par_ville_etat": fraud_by_city_state,
    "v_montant_moyen_par_type": avg_amount_by_class,
    "v_top_clients_suspects": top_suspect_clients,
}


def register_views(gold: DataFrame, prefix: str = "") -> list[str]:
    """CREATE OR REPLACE the four views (session temp views) over ``gold``; returns their names."""
    names = []
    for name, build in VIEW_NAMES.items():
        build(gold).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
