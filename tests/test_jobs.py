from cardwatch import fixtures
from cardwatch.plans import jobs
from cardwatch.plans import keys as K


def test_jobs_end_to_end(spark, scratch, sf_small):
    root = scratch + "/bronze"
    static = {
        "users_data": fixtures.users_data(spark, sf_small),
        "cards_data": fixtures.cards_data(spark, sf_small),
        "mcc_codes": fixtures.mcc_codes(spark, sf_small),
        "train_fraud_labels": fixtures.train_fraud_labels(spark, sf_small),
    }
    tx = fixtures.transactions(spark, sf_small)
    assert jobs.bronze_job(spark, tx, static, root) == ["2025-01-01", "2025-01-02"]
    assert jobs.bronze_job(spark, tx, static, root) == []  # rerun: nothing new
    silver = jobs.silver_job(spark, root, "e2e_silver", scratch + "/warehouse")
    direct = K.silver(spark, sf_small)
    assert silver.exceptAll(direct).count() == 0 and direct.exceptAll(silver).count() == 0
    metrics = jobs.train_job(spark, silver, "rf_basic", scratch + "/model", scratch + "/metrics").first()
    assert 0.0 <= metrics["accuracy"] <= 1.0
    gold = jobs.gold_job(spark, silver, scratch + "/gold", model_path=scratch + "/model", view_prefix="e2e_")
    # every silver row is in gold; those with a NULL number (left-join misses) have no score
    from cardwatch.schemas import NUMERIC_FEATURES

    assert gold.count() == silver.count()
    assert gold.where("fraud_probability IS NOT NULL").count() == silver.dropna(subset=NUMERIC_FEATURES).count() < silver.count()
    assert gold.where("label_pred IS NULL AND fraud_probability IS NOT NULL").count() == 0
    assert gold.select("id", "amount").exceptAll(silver.select("id", "amount")).count() == 0
    assert spark.sql("SELECT total_transactions FROM e2e_v_taux_fraude_global").first()[0] == silver.count()


def test_static_snapshots_are_written_once(spark, scratch, sf_small):
    """The second day adds its own copy; the first day's rows stay as they were loaded."""
    from pyspark.sql import functions as F

    from cardwatch.schemas import MCC
    from cardwatch.sources import snapshots

    root = scratch + "/bronze"
    tx = fixtures.transactions(spark, sf_small)
    day = lambda d: tx.where(F.col("date_insertion") <= F.lit(d))
    codes = lambda text: {"mcc_codes": spark.createDataFrame([("1", text)], MCC)}
    assert jobs.bronze_job(spark, day(fixtures.FIRST_SNAPSHOT), codes("old"), root) == ["2025-01-01"]
    assert jobs.bronze_job(spark, day(fixtures.SECOND_SNAPSHOT), codes("new"), root) == ["2025-01-02"]
    assert jobs.bronze_job(spark, day(fixtures.SECOND_SNAPSHOT), codes("newer"), root) == []
    rows = snapshots.read_snapshots(spark, root + "/mcc_codes", jobs._with_date(MCC)).collect()
    assert sorted((str(r.date_insertion), r.description) for r in rows) == [("2025-01-01", "old"), ("2025-01-02", "new")]


def test_counts_are_observed_while_writing(spark, scratch, sf_small):
    """A job with counts runs as many Spark jobs as without them, and its figures equal the counting query's."""
    from cardwatch.plans import store

    root = scratch + "/bronze"
    d = fixtures.domain(spark, sf_small)
    static = {"users_data": d["users"], "cards_data": d["cards"], "mcc_codes": d["mcc"], "train_fraud_labels": d["labels"]}
    jobs.bronze_job(spark, d["transactions"], static, root, metrics_path=scratch + "/metrics")
    loaded = {r.metric: r.value for r in store.read_counts(spark, scratch + "/metrics", "bronze").collect()}
    assert loaded == {f"transactions {r.snapshot_date}": r.n for r in K.registry()["snapshot_bounds"](spark, sf_small).collect()}

    def run(group, name, **more):
        spark.sparkContext.setJobGroup(group, group)
        table = jobs.silver_job(spark, root, name, scratch + "/warehouse", **more)
        return table, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    run("warm", "counts_warm")
    _, plain = run("plain", "counts_plain")
    real, calls = store.write_metrics, []
    store.write_metrics = lambda df, path: calls.append(df.collect())  # the figures' own small table aside
    try:
        table, observed = run("observed", "counts_observed", metrics_path=scratch + "/metrics")
    finally:
        store.write_metrics = real
        spark.sparkContext.setJobGroup("rest", "rest")
    assert observed <= plain + 1  # the collect above
    figures = {r.metric: r.value for r in calls[0]}
    assert figures == {r.stage: r.n for r in K.registry()["row_counts"](spark, sf_small).collect()}
    jobs.gold_job(spark, table, scratch + "/gold", metrics_path=scratch + "/metrics", view_prefix="counts_")
    gold = {r.metric: r.value for r in store.read_counts(spark, scratch + "/metrics", "gold").collect()}
    assert gold["gold"] == table.count() and gold["hits"] == spark.sql("SELECT total_fraudes FROM counts_v_taux_fraude_global").first()[0]


def test_confusion_matrix_is_read_back(spark, scratch, sf_small):
    from cardwatch.operators import evaluate
    from cardwatch.plans import store

    wide = evaluate.report(K.gold(spark, sf_small))
    store.write_metrics(store.metrics_long(wide, "r"), scratch + "/m")
    got, expected = store.read_metrics(spark, scratch + "/m", "r").first(), wide.first()
    assert {c: got[c] for c in ("tn", "fp", "fn", "tp")} == {c: float(expected[c]) for c in ("tn", "fp", "fn", "tp")}
