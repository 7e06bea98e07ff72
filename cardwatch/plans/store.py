"""Tables the jobs publish: silver in the catalog, gold as Parquet, metrics keyed by run.

Everything is written under the shared folder (``session.shared_path``) with overwrite
semantics, so a retried or re-run job replaces its own output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.schemas import METRICS
from cardwatch.sources.files import path_is_missing

METRIC_NAMES = ("accuracy", "precision", "recall", "f1", "auc")
#: The confusion matrix is stored beside them.
COUNT_NAMES = ("tn", "fp", "fn", "tp")


def save_table(spark: SparkSession, df: DataFrame, database: str, table: str, location: str) -> DataFrame:
    """CREATE DATABASE IF NOT EXISTS + overwrite an external catalog table at ``location``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}/{database}.db'")
    df.write.mode("overwrite").option("path", f"{location}/{database}.db/{table}").saveAsTable(f"{database}.{table}")
    return spark.table(f"{database}.{table}")


def export_parquet(df: DataFrame, path: str, num_files: int | None = None) -> None:
    """Parquet export; ``num_files`` fixes the file count, otherwise AQE sizes the output."""
    out = df.repartition(num_files) if num_files else df
    out.write.mode("overwrite").parquet(path)


def metrics_long(metrics_row: DataFrame, run_id: str) -> DataFrame:
    """One wide metrics row -> (run_id, metric, value) rows."""
    cols = [c for c in METRIC_NAMES + COUNT_NAMES if c in metrics_row.columns]
    stack = "stack({}, {}) AS (metric, value)".format(
        len(cols), ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in cols))
    return metrics_row.select(F.expr(stack)).select(F.lit(run_id).alias("run_id"), "metric", "value")


def counts_long(spark: SparkSession, counts: dict[str, int], run_id: str) -> DataFrame:
    """Row counts that a job observed while it wrote, as (run_id, metric, value) rows."""
    return spark.createDataFrame([(run_id, k, float(n)) for k, n in counts.items()], "run_id string, metric string, value double")


def read_counts(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """(metric, value) of one run, whatever its metrics are called."""
    return spark.read.schema(METRICS).parquet(path).where(F.col("run_id") == run_id).select("metric", "value")


def write_metrics(df_long: DataFrame, path: str) -> None:
    """Replace the rows of the runs present in ``df_long`` (dynamic partition overwrite)."""
    (df_long.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(path))


def read_metrics(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Metrics and confusion matrix of one run as one wide row; no row when the run (or the table) does not exist."""
    try:
        df = spark.read.schema(METRICS).parquet(path)
    except AnalysisException as error:
        if not path_is_missing(error):
            raise
        return spark.createDataFrame([], ", ".join(f"{c} double" for c in METRIC_NAMES + COUNT_NAMES))
    one = df.where(F.col("run_id") == run_id)
    # Grouping by the run (not a global aggregate) yields no row at all for an unknown run.
    return one.groupBy("run_id").pivot("metric", [*METRIC_NAMES, *COUNT_NAMES]).agg(F.first("value")).select(*METRIC_NAMES, *COUNT_NAMES)
