"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Each reads the given test tables through ``cardwatch.fixtures`` (so its work grows with them)
and runs the library operator on the whole input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import fixtures
from cardwatch.functions import rules
from cardwatch.operators import category_index, evaluate, features, sampling
from cardwatch.operators import silver as sv
from cardwatch.operators import views
from cardwatch.plans import gold as gd
from cardwatch.plans import predict as pr
from cardwatch.schemas import CATEGORY_FEATURES, KEY_FEATURES
from cardwatch.session import ensure_checkpoint_dir


def _dom(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fixtures.domain(spark, sf_dir)


def latest_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.latest_snapshot(fixtures.transactions(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    d = _dom(spark, sf_dir)
    return sv.build_silver(sv.latest_snapshot(d["transactions"]), d["users"], d["cards"], d["mcc"], d["labels"], **kw)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gd.gold_from_rules(silver(spark, sf_dir))


# ---- joins -------------------------------------------------------------------------------

def q_join_users(spark, sf_dir):
    return sv.join_users(latest_transactions(spark, sf_dir), fixtures.users_data(spark, sf_dir))


def q_join_cards(spark, sf_dir):
    return sv.join_cards(latest_transactions(spark, sf_dir), fixtures.cards_data(spark, sf_dir))


def q_join_mcc(spark, sf_dir):
    return sv.join_mcc(latest_transactions(spark, sf_dir), fixtures.mcc_codes(spark, sf_dir))


def q_join_labels(spark, sf_dir):
    return sv.join_labels(latest_transactions(spark, sf_dir), fixtures.train_fraud_labels(spark, sf_dir))


def q_silver_join(spark, sf_dir):
    d = _dom(spark, sf_dir)
    return sv.silver_join(sv.latest_snapshot(d["transactions"]), d["users"], d["cards"], d["mcc"], d["labels"])


def q_silver_positive_amount(spark, sf_dir):
    return latest_transactions(spark, sf_dir).where(F.col("amount") > 0)


def q_silver_clean_money(spark, sf_dir):
    u = sv.clean_money(fixtures.users_data(spark, sf_dir))
    c = sv.clean_money(fixtures.cards_data(spark, sf_dir))
    return u.select("id", "per_capita_income", "yearly_income", "total_debt").join(
        c.select("id", "credit_limit"), "id", "full")


def q_label_encode(spark, sf_dir):
    tx = latest_transactions(spark, sf_dir).select("id")
    return sv.encode_label(sv.join_labels(tx, fixtures.train_fraud_labels(spark, sf_dir)))


def q_silver_transactions(spark, sf_dir):
    return silver(spark, sf_dir)


# ---- gold and views ----------------------------------------------------------------------

def q_gold_scored(spark, sf_dir):
    return gold(spark, sf_dir)


def q_v_global_fraud_rate(spark, sf_dir):
    return views.global_fraud_rate(gold(spark, sf_dir))


def q_v_fraud_by_city_state(spark, sf_dir):
    return views.fraud_by_city_state(gold(spark, sf_dir))


def q_v_avg_amount_by_class(spark, sf_dir):
    return views.avg_amount_by_class(gold(spark, sf_dir))


def q_v_top_suspect_clients(spark, sf_dir):
    return views.top_suspect_clients(gold(spark, sf_dir))


def q_explain_rules(spark, sf_dir):
    s = silver(spark, sf_dir)
    return s.select("id", rules.rules_fired().alias("rules_fired"),
                    F.array_join(rules.reasons(), "; ").alias("explication"))


def q_predict_batch(spark, sf_dir):
    out = pr.predict(pr.requests_from(silver(spark, sf_dir)))
    return out.withColumn("explication", F.array_join("explication", "; "))


# ---- training data -----------------------------------------------------------------------

def complete(spark, sf_dir):
    return sampling.complete_rows(gd.labelled(silver(spark, sf_dir)))


def q_train_complete_rows(spark, sf_dir):
    return complete(spark, sf_dir)


def q_row_counts(spark, sf_dir):
    """Rows per stage, counted in one pass: what silver and the training set keep are conditions on the joined rows."""
    d = _dom(spark, sf_dir)
    joined = sv.silver_join(sv.latest_snapshot(d["transactions"]), d["users"], d["cards"], d["mcc"], d["labels"])
    kept = (F.col("amount") > 0) & F.col("id").isNotNull()
    whole = kept
    for c in KEY_FEATURES:
        if c != "label":  # silver encodes it, so it is never NULL there
            whole = whole & F.col(c).isNotNull()
    counts = joined.agg(F.count(F.lit(1)).alias("a"), F.count_if(kept).alias("b"), F.count_if(whole).alias("c"))
    return counts.selectExpr("stack(3, 'transactions', a, 'silver', b, 'complete', c) AS (stage, n)")


def q_class_counts(spark, sf_dir):
    return sampling.class_counts(complete(spark, sf_dir))


def q_class_weights(spark, sf_dir):
    return sampling.class_weights(complete(spark, sf_dir)).select("id", "label", "class_weight")


def balanced(spark, sf_dir, **limits):
    # only the columns the key returns travel through the sampling passes
    return sampling.undersample(complete(spark, sf_dir).select("id", "label"), **limits)


def q_undersample_balanced(spark, sf_dir):
    return balanced(spark, sf_dir)


def q_undersample_histogram(spark, sf_dir):
    """The same rows by histogram refinement, which the size limit would keep for large classes."""
    return balanced(spark, sf_dir, buckets=16, exact_limit=100)


def q_sample_large(spark, sf_dir):
    """The 30 % sample of a large input, whatever the table's size."""
    return sampling.sample_if_large(complete(spark, sf_dir), 0.3, threshold=100).select("id", "label")


def q_sample_fraction(spark, sf_dir):
    return sampling.sample_fraction(complete(spark, sf_dir), 0.1).select("id", "label")


def q_sample_if_large(spark, sf_dir):
    return sampling.sample_if_large(complete(spark, sf_dir), 0.3).select("id", "label")


def q_split_train(spark, sf_dir):
    return sampling.split(balanced(spark, sf_dir), 0.8)[0].select("id", "label")


def q_split_test(spark, sf_dir):
    return sampling.split(balanced(spark, sf_dir), 0.8)[1].select("id", "label")


def _indexed(spark, sf_dir, columns, **limits):
    ensure_checkpoint_dir(spark)
    rows = complete(spark, sf_dir).withColumn("id_text", F.col("id").cast("string")).select("id", *columns).checkpoint()
    return category_index.with_index(rows, category_index.category_index(rows, columns, **limits), columns).select("id", *[f"{c}_idx" for c in columns])


def q_string_index(spark, sf_dir):
    return _indexed(spark, sf_dir, CATEGORY_FEATURES)


def q_category_index_large(spark, sf_dir):
    """A column with as many values as rows, and one with many: ranked in parts, joined as a table."""
    return _indexed(spark, sf_dir, ["id_text", "client_id"], rows_per_part=500)


def q_feature_rows(spark, sf_dir):
    rows = complete(spark, sf_dir)
    indexed = features.index_categories(rows)
    assembled = features.assembler("error").transform(indexed)
    out = features.features_as_columns(assembled)
    return out.select("id", *[c for c in out.columns if c.startswith("f_")])


# ---- evaluation on the rule-scored gold table --------------------------------------------

def q_confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(gold(spark, sf_dir))


def q_classification_metrics(spark, sf_dir):
    return evaluate.classification_metrics(gold(spark, sf_dir))


def q_roc_auc(spark, sf_dir):
    return evaluate.roc_auc(gold(spark, sf_dir))


def q_roc_curve(spark, sf_dir):
    return evaluate.roc_points(gold(spark, sf_dir))


def q_roc_by_amount(spark, sf_dir):
    """ROC points and area for a score with many distinct values, so that the running totals take many parts."""
    g = gold(spark, sf_dir).select("label", "amount")
    points = evaluate.roc_points(g, "amount", rows_per_part=500)
    area = evaluate.roc_auc(g, "amount", rows_per_part=500).select("auc").scalar()
    return points.withColumn("auc", area)


def q_silver_join_merge(spark, sf_dir):
    """The join chain with sort-merge joins, as for dimensions too large to broadcast."""
    d = _dom(spark, sf_dir)
    return sv.silver_join(sv.latest_snapshot(d["transactions"]), d["users"], d["cards"], d["mcc"], d["labels"], strategy="merge")


REGISTRY = {
    "roc_by_amount": q_roc_by_amount,
    "silver_join_merge": q_silver_join_merge,
    "undersample_histogram": q_undersample_histogram,
    "sample_large": q_sample_large,
    "join_users": q_join_users,
    "join_cards": q_join_cards,
    "join_mcc": q_join_mcc,
    "join_labels": q_join_labels,
    "silver_join": q_silver_join,
    "silver_positive_amount": q_silver_positive_amount,
    "silver_clean_money": q_silver_clean_money,
    "label_encode": q_label_encode,
    "silver_transactions": q_silver_transactions,
    "gold_scored": q_gold_scored,
    "v_global_fraud_rate": q_v_global_fraud_rate,
    "v_fraud_by_city_state": q_v_fraud_by_city_state,
    "v_avg_amount_by_class": q_v_avg_amount_by_class,
    "v_top_suspect_clients": q_v_top_suspect_clients,
    "explain_rules": q_explain_rules,
    "predict_batch": q_predict_batch,
    "train_complete_rows": q_train_complete_rows,
    "row_counts": q_row_counts,
    "class_counts": q_class_counts,
    "class_weights": q_class_weights,
    "undersample_balanced": q_undersample_balanced,
    "sample_fraction": q_sample_fraction,
    "sample_if_large": q_sample_if_large,
    "split_train": q_split_train,
    "split_test": q_split_test,
    "string_index": q_string_index,
    "category_index_large": q_category_index_large,
    "feature_rows": q_feature_rows,
    "confusion_matrix": q_confusion_matrix,
    "classification_metrics": q_classification_metrics,
    "roc_auc": q_roc_auc,
    "roc_curve": q_roc_curve,
}


def registry() -> dict:
    """All registered keys (relational, I/O, model)."""
    from cardwatch.plans.keys_io import IO_REGISTRY
    from cardwatch.plans.keys_models import MODEL_REGISTRY

    from cardwatch.plans.keys_io import q_silver_labelled_table

    # silver_labelled scans the catalog table that silver_table publishes
    return {**REGISTRY, **IO_REGISTRY, **MODEL_REGISTRY, "silver_labelled": q_silver_labelled_table}
