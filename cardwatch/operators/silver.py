"""Bronze -> silver: one wide, cleaned, labelled transaction table.

Plan shape (checked with ``explain``): the ``amount > 0`` and ``id IS NOT NULL`` filters are
pushed below the left joins into the fact scan; users, cards and codes are key-deduplicated
(so a duplicated dimension key cannot fan out transactions) and joined by
``joins.dimension_join``: the fact is read once, broadcast or sort-merge follows from measured
bytes, and AQE splits hot or NULL keys. The label table is fact-sized and keyed by transaction
id (no hot keys); it is aggregated on the same text key the join uses, so its side of the join
is not shuffled twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.scalar import label_to_int, money_to_double
from cardwatch.operators.dedupe import first_per_key
from cardwatch.operators.joins import dimension_join, unique_by_key

USER_MONEY = ["per_capita_income", "yearly_income", "total_debt"]
CARD_MONEY = ["credit_limit"]

SILVER_COLUMNS = [
    "id", "date", "client_id", "card_id", "amount", "use_chip", "merchant_id", "merchant_city", "merchant_state", "zip", "mcc", "errors",
    "description", "gender", "credit_score", "num_credit_cards", "latitude", "longitude",
    "per_capita_income", "yearly_income", "total_debt", "card_client_id", "card_brand", "card_type",
    "has_chip", "num_cards_issued", "credit_limit", "label",
]


def _users_keyed(users: DataFrame) -> DataFrame:
    return users.withColumnsRenamed({"id": "client_id"}).withColumn("client_id", F.col("client_id").cast("string"))


def _cards_keyed(cards: DataFrame) -> DataFrame:
    return cards.withColumnsRenamed({"id": "card_id", "client_id": "card_client_id"}).withColumn(
        "card_id", F.col("card_id").cast("string"))


def _mcc_keyed(mcc: DataFrame) -> DataFrame:
    return mcc.withColumnsRenamed({"mcc_code": "mcc"})


def labels_dim(labels: DataFrame, dedupe: bool = True) -> DataFrame:
    lab = labels.withColumnsRenamed({"transaction_id": "label_transaction_id"})
    return first_per_key(lab, ["label_transaction_id"]) if dedupe else lab


def _join_dim(tx: DataFrame, keyed: DataFrame, key: str, dedupe: bool, strategy: str | None) -> DataFrame:
    """``keyed`` has its key as text, as the fact does (comparing text avoids ANSI cast errors)."""
    return dimension_join(tx, unique_by_key(keyed, key) if dedupe else keyed, key, strategy)


def join_users(tx: DataFrame, users: DataFrame, dedupe: bool = True, strategy: str | None = None) -> DataFrame:
    return _join_dim(tx, _users_keyed(users), "client_id", dedupe, strategy)


def join_cards(tx: DataFrame, cards: DataFrame, dedupe: bool = True, strategy: str | None = None) -> DataFrame:
    return _join_dim(tx, _cards_keyed(cards), "card_id", dedupe, strategy)


def join_mcc(tx: DataFrame, mcc: DataFrame, dedupe: bool = True, strategy: str | None = None) -> DataFrame:
    return _join_dim(tx, _mcc_keyed(mcc), "mcc", dedupe, strategy)


def join_labels(tx: DataFrame, labels: DataFrame, dedupe: bool = True) -> DataFrame:
    lab = labels_dim(labels, dedupe)
    return tx.join(lab, tx["id"].cast("string") == lab["label_transaction_id"], "left").drop("label_transaction_id")


LABEL_KEY = "label_key"


def label_keyed(tx: DataFrame) -> DataFrame:
    """Transactions with their id as text, which a bronze table that is stored for the label join is bucketed by."""
    return tx.withColumn(LABEL_KEY, F.col("id").cast("string"))


def join_labels_stored(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """``join_labels`` of tables that are bucketed by ``label_key`` and ``label_transaction_id`` (``labels_dim`` of the labels,
    made when they were stored): neither side is shuffled or aggregated."""
    joined = tx.join(labels, F.col(LABEL_KEY) == F.col("label_transaction_id"), "left")
    return joined.drop(LABEL_KEY, "label_transaction_id")


def silver_join(tx: DataFrame, users: DataFrame, cards: DataFrame, mcc: DataFrame, labels: DataFrame,
                dedupe: bool = True, strategy: str | None = None) -> DataFrame:
    """The 5-table left-join chain, fact on the left and read once."""
    out = join_users(tx, users, dedupe, strategy)
    out = join_cards(out, cards, dedupe, strategy)
    out = join_mcc(out, mcc, dedupe, strategy)
    return join_labels(out, labels, dedupe)


def clean_money(df: DataFrame, columns=tuple(USER_MONEY + CARD_MONEY)) -> DataFrame:
    present = set(df.columns)
    return df.withColumns({c: money_to_double(c) for c in columns if c in present})


def encode_label(df: DataFrame) -> DataFrame:
    """'Yes' -> 1, else 0; unlabelled rows become 0 (kept, as the reference does)."""
    return df.withColumn("label", label_to_int("label")) if "label" in df.columns else df


def build_silver(tx: DataFrame, users: DataFrame, cards: DataFrame, mcc: DataFrame, labels: DataFrame,
                 dedupe: bool = True, unlabelled: str = "keep", strategy: str | None = None) -> DataFrame:
    """Silver table: joined, positive amounts only, money parsed, label encoded, id present.

    ``unlabelled="drop"`` removes transactions without a label row instead of calling them genuine.
    """
    out = silver_join(tx, users, cards, mcc, labels, dedupe, strategy)
    out = out.where(F.col("amount") > 0)
    out = clean_money(out)
    if unlabelled == "drop":
        out = out.where(F.col("label").isNotNull())
    out = encode_label(out)
    out = out.where(F.col("id").isNotNull())
    return out.select(*SILVER_COLUMNS)


def latest_snapshot(tx: DataFrame, date_col: str = "date_insertion") -> DataFrame:
    """Rows of the newest snapshot of any frame: the date is a scalar subquery over its date column.
    For a stored bronze table ``snapshots.read_latest`` takes the date from a listing instead."""
    newest = tx.agg(F.max(date_col)).scalar()
    return tx.where(F.col(date_col) == newest).drop(date_col)
