"""Derive the card-transaction domain tables from the TPC-H-style test tables.

Every domain table is a lazy DataFrame over the given parquet files, so the work grows with
the input. The mapping is deliberately lossy in places (dangling users, cards and codes,
negative amounts, unlabelled transactions) so that the left joins and filters are exercised.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_SNAPSHOT = dt.date(2025, 1, 1)
SECOND_SNAPSHOT = dt.date(2025, 1, 2)
FIRST_SNAPSHOT_SHARE = Decimal("0.7")  # exact decimal, not a binary float


# Declared, not inferred: reading a footer to infer a schema is one extra Spark job per scan
# at plan time (and a footer read per file on a large input).
TEST_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TEST_TABLES[name]) if name in TEST_TABLES else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def transactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, money as text (``$1234.50``, ``$-77.50``), ids typed."""
    orders = table(spark, sf_dir, "orders")
    # nation (25 rows) and region (5 rows) have a fixed size at every scale factor, so the
    # broadcast is bounded; without the hint a small orders file could be broadcast instead.
    geo = F.broadcast(table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")
    ).selectExpr("n_nationkey", "n_name", "r_name"))
    # SQL expression text: one planner call per column instead of one per Column method.
    return orders.join(geo, F.expr("o_orderkey % 25 = n_nationkey")).selectExpr(
        "o_orderkey AS id",
        "o_orderdate AS date",
        "CAST(o_custkey AS STRING) AS client_id",
        "CAST(o_custkey AS STRING) AS card_id",
        "concat(CASE WHEN o_orderkey % 10 = 0 THEN '$-' ELSE '$' END, "
        "CAST(CAST(floor(o_totalprice / 100) AS BIGINT) AS STRING), '.50') AS amount_raw",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'No' ELSE 'Yes' END AS use_chip",
        "CAST(o_custkey % 1000 AS STRING) AS merchant_id",
        "n_name AS merchant_city",
        "r_name AS merchant_state",
        "CASE WHEN o_orderkey % 7 = 0 THEN 'nan' ELSE concat(CAST(10000 + o_orderkey % 80000 AS STRING), '.0') END AS zip",
        "CAST(o_orderkey % 30 AS STRING) AS mcc",
        "CASE WHEN o_orderkey % 50 = 0 THEN 'Bad PIN' WHEN o_orderkey % 3 = 0 THEN 'nan' END AS errors",
    )


def transactions_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw file with a line per line item: ids repeat, and some are no number, a fraction, beyond 2^53 or beyond
    any bigint. ``position`` is the line's place in the file."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CASE l_orderkey % 11 WHEN 0 THEN 'NaN' WHEN 1 THEN concat(CAST(l_orderkey AS STRING), '.75') "
        "WHEN 2 THEN CAST(9007199254740992 + l_orderkey AS STRING) WHEN 3 THEN '1e300' ELSE CAST(l_orderkey AS STRING) END AS id",
        "l_shipdate AS date",
        "CAST(l_suppkey AS STRING) AS client_id",
        "CAST(l_partkey AS STRING) AS card_id",
        "concat('$', CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING), '.00') AS amount_raw",
        "l_returnflag AS use_chip",
        "CAST(l_linenumber AS STRING) AS merchant_id",
        "l_linestatus AS merchant_city",
        "l_returnflag AS merchant_state",
        "concat(CAST(l_partkey AS STRING), '.0') AS zip",
        "CAST(l_linenumber AS STRING) AS mcc",
        "CAST(NULL AS STRING) AS errors",
        "l_partkey * 100000000 + l_suppkey * 1000 + CAST(l_quantity AS BIGINT) - l_linenumber * 10000000000000000 AS position",
    )


def transactions_snapshots_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dated full snapshots: the first holds ids below 70 % of the order count, the second all.

    Generated in one pass over orders (each order yields one or two snapshot rows), not as a
    union of two scans.
    """
    raw = transactions_raw(spark, sf_dir)
    n_orders = table(spark, sf_dir, "orders").agg(F.count(F.lit(1))).scalar()
    cutoff = F.floor(n_orders * F.lit(FIRST_SNAPSHOT_SHARE)).cast("bigint")
    both = F.array(F.lit(SECOND_SNAPSHOT), F.lit(FIRST_SNAPSHOT))
    only_second = F.array(F.lit(SECOND_SNAPSHOT))
    return raw.withColumn("date_insertion", F.explode(F.when(F.col("id") < cutoff, both).otherwise(only_second)))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed snapshot table: both dates, amount parsed from its money text."""
    from cardwatch.functions.scalar import missing_text_to_null, money_to_double, zip_text

    return transactions_snapshots_raw(spark, sf_dir).withColumns({
        "amount": money_to_double("amount_raw"), "zip": zip_text("zip"), "errors": missing_text_to_null("errors"),
    }).select("id", "date", "client_id", "card_id", "amount", "use_chip", "merchant_id", "merchant_city",
              "merchant_state", "zip", "mcc", "errors", "date_insertion")


def users_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_custkey % 20 <> 0").selectExpr(
        "c_custkey AS id",
        "CASE c_mktsegment WHEN 'MACHINERY' THEN 'Female' WHEN 'BUILDING' THEN 'Male' "
        "WHEN 'HOUSEHOLD' THEN 'Female' WHEN 'FURNITURE' THEN 'Male' ELSE 'Unknown' END AS gender",
        "CAST(300 + floor(abs(c_acctbal) / 20) AS BIGINT) AS credit_score",
        "CAST(c_custkey % 11 AS BIGINT) AS num_credit_cards",
        "CAST(20 + c_nationkey * 1.5D AS DOUBLE) AS latitude",
        "CAST(-120 + c_nationkey * 2 AS DOUBLE) AS longitude",
        "concat('$', CAST(20000 + c_custkey AS STRING)) AS per_capita_income",
        "concat('$', CAST(40000 + c_custkey AS STRING)) AS yearly_income",
        "concat('$1,', lpad(CAST(c_custkey % 1000 AS STRING), 3, '0'), '.25') AS total_debt",
    )


def cards_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_custkey % 10 <> 9").selectExpr(
        "c_custkey AS id",
        "c_custkey AS client_id",
        "CASE WHEN c_custkey % 3 = 0 THEN 'Visa' WHEN c_custkey % 3 = 1 THEN 'Mastercard' ELSE 'Amex' END "
        "AS card_brand",
        "CASE WHEN c_custkey % 2 = 0 THEN 'Debit' ELSE 'Credit' END AS card_type",
        "CASE WHEN c_custkey % 4 = 0 THEN 'NO' ELSE 'YES' END AS has_chip",
        "CAST(c_custkey % 7 AS BIGINT) AS num_cards_issued",
        "concat('$', CAST(1000 + c_custkey % 9000 AS STRING)) AS credit_limit",
    )


def mcc_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr("CAST(n_nationkey AS STRING) AS mcc_code",
                                                     "n_name AS description")


def train_fraud_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label per order that has line items: 'Yes' when any line is a large return."""
    # Grouped on the text key the label join uses, so the join reuses this partitioning.
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.expr("CAST(l_orderkey AS STRING) AS transaction_id"))
        .agg(F.expr("max(CASE WHEN l_returnflag = 'R' AND l_quantity >= 48 THEN 1 ELSE 0 END) AS m"))
        .selectExpr("transaction_id", "CASE WHEN m = 1 THEN 'Yes' ELSE 'No' END AS label")
    )


def domain(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "transactions": transactions(spark, sf_dir),
        "users": users_data(spark, sf_dir),
        "cards": cards_data(spark, sf_dir),
        "mcc": mcc_codes(spark, sf_dir),
        "labels": train_fraud_labels(spark, sf_dir),
    }
