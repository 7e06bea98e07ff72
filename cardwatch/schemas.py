"""Explicit StructTypes of the domain tables (no schema inference anywhere)."""

from pyspark.sql import types as T

# Raw transaction as it arrives from the operational source (money and ids still text).
TRANSACTIONS_RAW = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("client_id", T.StringType()),
    T.StructField("card_id", T.StringType()),
    T.StructField("amount_raw", T.StringType()),
    T.StructField("use_chip", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("merchant_city", T.StringType()),
    T.StructField("merchant_state", T.StringType()),
    T.StructField("zip", T.StringType()),
    T.StructField("mcc", T.StringType()),
    T.StructField("errors", T.StringType()),
])

# Typed transaction snapshot row (the operational table).
TRANSACTIONS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("client_id", T.StringType()),
    T.StructField("card_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("use_chip", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("merchant_city", T.StringType()),
    T.StructField("merchant_state", T.StringType()),
    T.StructField("zip", T.StringType()),
    T.StructField("mcc", T.StringType()),
    T.StructField("errors", T.StringType()),
    T.StructField("date_insertion", T.DateType()),
])

USERS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("gender", T.StringType()),
    T.StructField("credit_score", T.LongType()),
    T.StructField("num_credit_cards", T.LongType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("per_capita_income", T.StringType()),
    T.StructField("yearly_income", T.StringType()),
    T.StructField("total_debt", T.StringType()),
])

CARDS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("client_id", T.LongType()),
    T.StructField("card_brand", T.StringType()),
    T.StructField("card_type", T.StringType()),
    T.StructField("has_chip", T.StringType()),
    T.StructField("num_cards_issued", T.LongType()),
    T.StructField("credit_limit", T.StringType()),
])

MCC = T.StructType([
    T.StructField("mcc_code", T.StringType()),
    T.StructField("description", T.StringType()),
])

LABELS = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("label", T.StringType()),
])

# The scoring request: six numbers and five category strings, all required.
REQUEST = T.StructType([
    T.StructField("amount", T.DoubleType(), False),
    T.StructField("credit_score", T.DoubleType(), False),
    T.StructField("num_credit_cards", T.DoubleType(), False),
    T.StructField("num_cards_issued", T.DoubleType(), False),
    T.StructField("latitude", T.DoubleType(), False),
    T.StructField("longitude", T.DoubleType(), False),
    T.StructField("use_chip", T.StringType(), False),
    T.StructField("card_brand", T.StringType(), False),
    T.StructField("card_type", T.StringType(), False),
    T.StructField("has_chip", T.StringType(), False),
    T.StructField("gender", T.StringType(), False),
])

GOLD = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("client_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("merchant_city", T.StringType()),
    T.StructField("merchant_state", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("label_pred", T.DoubleType()),
    T.StructField("fraud_probability", T.DoubleType()),
])

METRICS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

# Model inputs, in the fixed assembly order.
NUMERIC_FEATURES = ["amount", "credit_score", "num_credit_cards", "num_cards_issued", "latitude", "longitude"]
CATEGORY_FEATURES = ["use_chip", "card_brand", "card_type", "has_chip", "gender"]
FEATURES = NUMERIC_FEATURES + [f"{c}_idx" for c in CATEGORY_FEATURES]
# Rows missing any of these are not used for training.
KEY_FEATURES = NUMERIC_FEATURES + ["label"]
