"""The four batch jobs, composed from the operators: bronze load, silver build, training, gold scoring.

Each job reads what the previous one published and publishes one thing, with overwrite
semantics, so any job can be re-run after a failure:

- ``bronze_job``: load the snapshot dates not yet in bronze (dynamic partition overwrite) and stamp
  the static datasets (users, cards, codes, labels) with every snapshot date;
- ``silver_job``: newest snapshot of each dataset -> joined, cleaned, labelled silver table;
- ``train_job``: prepare, split, fit a model variant, save it, append its metrics;
- ``gold_job``: score silver (with a model, or the rule scorer), export gold, register the views.

With a ``metrics_path`` a job stores its row counts there. They are observed while it writes, in the same pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch import schemas
from cardwatch.operators import evaluate, views
from cardwatch.operators.silver import build_silver
from cardwatch.plans import gold as gd
from cardwatch.plans import models, store
from cardwatch.sources import snapshots

STATIC = {
    "users_data": schemas.USERS,
    "cards_data": schemas.CARDS,
    "mcc_codes": schemas.MCC,
    "train_fraud_labels": schemas.LABELS,
}


def _with_date(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("date_insertion", T.DateType())])


def _store_counts(spark: SparkSession, metrics_path: str | None, run_id: str, counts: dict[str, int]) -> None:
    if metrics_path and counts:
        store.write_metrics(store.counts_long(spark, counts, run_id), metrics_path)


def bronze_job(spark: SparkSession, transactions: DataFrame, static: dict[str, DataFrame], root: str,
               metrics_path: str | None = None) -> list[str]:
    """Returns the transaction snapshot dates loaded by this run."""
    tx_path = f"{root}/transactions"
    loaded = snapshots.load_missing(spark, transactions, tx_path)
    dates = snapshots.committed_dates(spark, tx_path)
    for name, df in static.items():
        snapshots.write_static(spark, df, dates, f"{root}/{name}")
    rows = snapshots.published(spark, tx_path)
    _store_counts(spark, metrics_path, "bronze", {f"transactions {d}": rows[d]["rows"] for d in loaded})
    return loaded


def silver_job(spark: SparkSession, root: str, database: str, location: str, table: str = "transactions_cleaned",
               metrics_path: str | None = None, **silver_opts) -> DataFrame:
    def latest(name: str, schema: T.StructType) -> DataFrame:
        return snapshots.read_latest(spark, f"{root}/{name}", _with_date(schema))

    tx = snapshots.read_latest(spark, f"{root}/transactions", schemas.TRANSACTIONS)
    read, kept = Observation(), Observation()
    if metrics_path:
        tx = tx.observe(read, F.count(F.lit(1)).alias("transactions"))
    silver = build_silver(tx, latest("users_data", schemas.USERS), latest("cards_data", schemas.CARDS),
                          latest("mcc_codes", schemas.MCC), latest("train_fraud_labels", schemas.LABELS),
                          **silver_opts)
    if metrics_path:
        whole = F.lit(True)
        for c in schemas.KEY_FEATURES:
            whole = whole & F.col(c).isNotNull()
        silver = silver.observe(kept, F.count(F.lit(1)).alias("silver"), F.count_if(whole).alias("complete"))
    saved = store.save_table(spark, silver, database, table, location)
    _store_counts(spark, metrics_path, "silver", {**read.get, **kept.get} if metrics_path else {})
    return saved


def train_job(spark: SparkSession, silver: DataFrame, variant: str, model_path: str, metrics_path: str,
              run_id: str | None = None) -> DataFrame:
    """Fit, save and evaluate one variant; returns its metrics row."""
    model, scored = models.train(silver, variant)
    models.save(model, model_path)
    wide = evaluate.report(scored)
    store.write_metrics(store.metrics_long(wide, run_id or variant), metrics_path)
    return store.read_metrics(spark, metrics_path, run_id or variant)


def gold_job(spark: SparkSession, silver: DataFrame, out_path: str, model_path: str | None = None,
             num_files: int | None = None, view_prefix: str = "", metrics_path: str | None = None) -> DataFrame:
    """Score, export and register the four views over the exported gold table."""
    if model_path:
        gold = gd.gold_from_model(models.load(model_path), silver)
    else:
        gold = gd.gold_from_rules(silver)
    seen = Observation()
    if metrics_path:
        gold = gold.observe(seen, F.count(F.lit(1)).alias("gold"), F.count_if(F.col("label_pred") == 1).alias("hits"))
    store.export_parquet(gold, out_path, num_files)
    _store_counts(spark, metrics_path, "gold", seen.get if metrics_path else {})
    published = spark.read.schema(schemas.GOLD).parquet(out_path)
    views.register_views(published, view_prefix)
    return published
