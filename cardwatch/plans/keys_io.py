"""Registered queries for sources, snapshots, sinks, JDBC and streaming.

Queries that write do so under the shared folder (``spark.checkpoint.dir``'s parent), each run in a new
sub folder, so that nothing an earlier run or another input left behind is read; they then read their output back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch import fixtures
from cardwatch.operators import evaluate, views
from cardwatch.plans import keys as K
from cardwatch.operators import silver as sv
from cardwatch.plans import gold as gd
from cardwatch.plans import jobs, period_views, store
from cardwatch.schemas import CARDS, GOLD, TRANSACTIONS, TRANSACTIONS_RAW, USERS
from cardwatch.session import scope_of, shared_path
from cardwatch.sources import bucketed, files, ingest, jdbc, json_object, snapshots


def _p(spark, sf_dir, *parts):
    return shared_path(spark, scope_of(sf_dir), f"run-{uuid.uuid4().hex[:12]}", *parts)


# ---- snapshots ---------------------------------------------------------------------------

def q_snapshot_dates(spark, sf_dir):
    return snapshots.snapshot_dates(fixtures.transactions(spark, sf_dir))


def q_snapshot_bounds(spark, sf_dir):
    return snapshots.snapshot_bounds(fixtures.transactions(spark, sf_dir))


def q_bronze_write(spark, sf_dir):
    path = _p(spark, sf_dir, "bronze", "transactions")
    snapshots.write_snapshots(fixtures.transactions(spark, sf_dir), path)
    return snapshots.read_snapshots(spark, path, TRANSACTIONS)


def q_snapshot_latest(spark, sf_dir):
    path = _p(spark, sf_dir, "bronze_latest", "transactions")
    snapshots.write_snapshots(fixtures.transactions(spark, sf_dir), path)
    return snapshots.read_latest(spark, path, TRANSACTIONS)


def _half_written(tx, path):
    """The oldest snapshot is published; the newest has files of a job that died before it published them."""
    oldest = tx.agg(F.min("date_insertion")).scalar()
    snapshots.write_snapshots(tx.where(F.col("date_insertion") == oldest), path)
    newest = [snapshots.snapshot_dates(tx).agg(F.max("snapshot_date")).first()[0]]
    snapshots._write_run(tx.where("id % 2 = 0"), path, "date_insertion", None, newest)


def q_dates_to_load(spark, sf_dir):
    """Bronze holds the oldest snapshot and half of the newest; which source dates still need loading?"""
    tx = fixtures.transactions(spark, sf_dir)
    path = _p(spark, sf_dir, "bronze_partial", "transactions")
    _half_written(tx, path)
    return snapshots.dates_to_load(snapshots.snapshot_dates(tx), snapshots.committed_dates(spark, path))


def q_bronze_num_files(spark, sf_dir):
    """Rows and files of each date when the number of files is asked for."""
    path = _p(spark, sf_dir, "bronze_files", "transactions")
    snapshots.write_snapshots(fixtures.transactions(spark, sf_dir), path, num_files=3)
    found = [(d, m["rows"], len(m["files"])) for d, m in snapshots.published(spark, path).items()]
    return spark.createDataFrame(found, "snapshot_date string, n long, files long")


def q_snapshot_recovered(spark, sf_dir):
    """All snapshots after a load that follows a half-written one."""
    tx = fixtures.transactions(spark, sf_dir)
    path = _p(spark, sf_dir, "bronze_recovered", "transactions")
    _half_written(tx, path)
    snapshots.load_missing(spark, tx, path)
    return snapshots.read_snapshots(spark, path, TRANSACTIONS)


def q_snapshot_manifests(spark, sf_dir):
    """Rows of each published snapshot, as observed while it was written; ``sound``: its files still hold those rows."""
    tx = fixtures.transactions(spark, sf_dir)
    path = _p(spark, sf_dir, "bronze_manifests", "transactions")
    snapshots.load_missing(spark, tx, path)
    listed = spark.createDataFrame([(d, m["rows"]) for d, m in snapshots.published(spark, path).items()], "snapshot_date string, n long")
    damaged = snapshots.damaged_snapshots(spark, path, TRANSACTIONS).select("snapshot_date", F.lit(True).alias("damaged"))
    return listed.join(damaged, "snapshot_date", "left").selectExpr("snapshot_date", "n", "damaged IS NULL AS sound")


def q_static_snapshots(spark, sf_dir):
    """users copied to every snapshot date, written as a partitioned bronze dataset."""
    dates = snapshots.snapshot_dates(fixtures.transactions(spark, sf_dir))
    path = _p(spark, sf_dir, "bronze", "users_data")
    stamped = snapshots.replicate_static(fixtures.users_data(spark, sf_dir), dates)
    snapshots.write_snapshots(stamped, path)
    schema = T.StructType(USERS.fields + [T.StructField("date_insertion", T.DateType())])
    return snapshots.read_snapshots(spark, path, schema)


def q_snapshot_prefix_70(spark, sf_dir):
    valid = ingest.ingest_transactions(fixtures.transactions_raw(spark, sf_dir).withColumn(
        "id", F.col("id").cast("string")), fixtures.SECOND_SNAPSHOT)
    return snapshots.first_share_by_id(valid.select("id"), 0.7)


# ---- ingest ------------------------------------------------------------------------------

def q_ingest_transactions(spark, sf_dir):
    raw = fixtures.transactions_raw(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    return ingest.ingest_transactions(raw, fixtures.SECOND_SNAPSHOT)


def q_ingest_lines(spark, sf_dir):
    """A raw file with repeated ids and ids that are no number, a fraction, or too large for a double or a bigint."""
    return ingest.ingest_transactions(fixtures.transactions_file(spark, sf_dir), fixtures.SECOND_SNAPSHOT)


def q_ingest_files(spark, sf_dir):
    """Ids that repeat across files of unlike sizes: the first file by name wins, though it is the smallest and read last.

    A file's rows are those of one line number, the highest in the first file; they are sorted by ``position``."""
    path = _p(spark, sf_dir, "files", "raw_lines")
    lines = fixtures.transactions_file(spark, sf_dir).withColumn("part", F.expr("8 - CAST(merchant_id AS INT)"))
    dealt = lines.repartitionByRange("part", "position").sortWithinPartitions("part", "position")
    # a folder's parts are numbered in the order of their ranges, so names sort like rows
    dealt.drop("position").write.partitionBy("part").option("header", True).csv(path)
    raw = files.read_csv(spark, path, TRANSACTIONS_RAW)
    return ingest.ingest_transactions(raw, fixtures.SECOND_SNAPSHOT)


def q_ingest_prefix(spark, sf_dir):
    """The first rows by id, as many as 10 % of all lines of the file, valid or not; by histogram refinement."""
    lines = fixtures.transactions_file(spark, sf_dir)
    valid = ingest.ingest_transactions(lines, fixtures.SECOND_SNAPSHOT).select("id")
    return snapshots.first_share_by_id(valid, 0.1, of_rows=lines.count(), buckets=16, exact_limit=100)


def q_dedupe_first_wins(spark, sf_dir):
    return ingest.dedupe_first_wins(fixtures.transactions(spark, sf_dir))


# ---- file formats ------------------------------------------------------------------------

def q_csv_read(spark, sf_dir):
    path = _p(spark, sf_dir, "files", "users_data.csv")
    files.write_csv(fixtures.users_data(spark, sf_dir), path)
    return files.read_any(spark, path, USERS)


def q_mcc_from_json(spark, sf_dir):
    path = _p(spark, sf_dir, "files", "mcc_codes.objects")
    files.write_json_objects(fixtures.mcc_codes(spark, sf_dir), "mcc_code", "description", path)
    return files.read_json_objects(spark, path, "mcc_code", "description")


def q_mcc_from_one_object(spark, sf_dir):
    """The codes as one JSON object in one file. Their number is bounded; fact-sized tables are read line by line."""
    path = _p(spark, sf_dir, "files", "mcc_codes.json")
    files.write_json_objects(fixtures.mcc_codes(spark, sf_dir), "mcc_code", "description", path, entries_per_object=1 << 30)
    return files.read_json_objects(spark, path, "mcc_code", "description", whole_file=True)


def q_labels_from_json(spark, sf_dir):
    path = _p(spark, sf_dir, "files", "train_fraud_labels.objects")
    files.write_json_objects(fixtures.train_fraud_labels(spark, sf_dir), "transaction_id", "label", path,
                             wrap="target")
    return files.read_json_objects(spark, path, "transaction_id", "label", wrap="target")


def _label_objects(spark, sf_dir, path, entries=20_000):
    """Files that are one JSON object each, of about so many entries, with commas, quotes and braces in the values."""
    text = "concat(label, ', \"checked\" \\\\ {', transaction_id, '}, ', IF(label = 'Yes', 'é,\n', ''))"
    labels = fixtures.train_fraud_labels(spark, sf_dir).select("transaction_id", F.expr(text).alias("label"))
    objects = max(1, -(-labels.count() // entries))
    body = F.struct(F.map_from_entries(F.collect_list(F.struct("transaction_id", "label"))).alias("target"))
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(objects)).alias("part")
    labels.groupBy(part).agg(F.to_json(body).alias("value")).write.partitionBy("part").text(path)


def q_labels_from_object(spark, sf_dir):
    """Label files that are one object each, read by many tasks: each takes 64 kB, so entries are cut in strings too."""
    path = _p(spark, sf_dir, "files", "train_fraud_labels.json")
    _label_objects(spark, sf_dir, path)
    return json_object.read_object(spark, path, "transaction_id", "label", _p(spark, sf_dir, "scratch"), wrap="target", split_bytes=1 << 16)


def _damaged_cards(spark, sf_dir):
    """Card lines, some of them cut, of the wrong type, no object or no JSON."""
    path = _p(spark, sf_dir, "files", "cards_damaged.json")
    cards = fixtures.cards_data(spark, sf_dir)
    whole = F.to_json(F.struct(*cards.columns))
    cards.select(F.when(F.expr("id % 13 = 1"), F.expr("concat('{\"id\":', id, ',\"card_brand\":\"')"))
                 .when(F.expr("id % 13 = 2"), F.expr("concat('{\"id\":', id, ',\"client_id\":\"none\",\"num_cards_issued\":[1]}')"))
                 .when(F.expr("id % 13 = 3"), F.expr("concat('[', id, ']')")).when(F.expr("id % 13 = 4"), F.expr("concat('card ', id)")).otherwise(whole)).write.text(path)
    return files.split_json_lines(spark, path, CARDS, _p(spark, sf_dir, "scratch"))


def q_json_good(spark, sf_dir):
    return _damaged_cards(spark, sf_dir)[0]


def q_json_quarantine(spark, sf_dir):
    """What was put aside. Line numbers depend on how the file was written, so only their soundness is returned."""
    bad = _damaged_cards(spark, sf_dir)[1]
    return bad.select("record", "reason", ((F.col("line") > 0) & F.col("file").contains("cards_damaged")).alias("placed"))


def q_parquet_tolerant(spark, sf_dir):
    """A table with a damaged file, read with unreadable files left out."""
    path = _p(spark, sf_dir, "files", "users.parquet")
    fixtures.users_data(spark, sf_dir).write.parquet(path)
    place, fs = snapshots._folder(spark, f"{path}/part-damaged.parquet")
    stream = fs.create(place, True)
    stream.write(bytearray(b"no Parquet"))
    stream.close()
    return files.read_any(spark, path, USERS, ignore_corrupt=True)


def q_json_permissive(spark, sf_dir):
    path = _p(spark, sf_dir, "files", "cards_data.json")
    files.write_json_lines(fixtures.cards_data(spark, sf_dir), path)
    return files.read_any(spark, path, CARDS)


# ---- tables stored by key --------------------------------------------------------------------

def _bucketed(spark, sf_dir, df, name, key):
    run = uuid.uuid4().hex[:12]
    width = bucketed.bucket_count(spark, 0)
    return bucketed.save(spark, df, f"cardwatch_bucketed.{name}_{run}", shared_path(spark, scope_of(sf_dir), f"run-{run}", name), key, width), f"cardwatch_bucketed.{name}_{run}"


def q_silver_join_bucketed(spark, sf_dir):
    """The join chain over bronze tables that are bucketed for the label join."""
    tx, _ = _bucketed(spark, sf_dir, sv.label_keyed(K.latest_transactions(spark, sf_dir)), "transactions", sv.LABEL_KEY)
    labels, _ = _bucketed(spark, sf_dir, sv.labels_dim(fixtures.train_fraud_labels(spark, sf_dir)), "labels", "label_transaction_id")
    out = sv.join_labels_stored(tx, labels)
    out = sv.join_users(out, fixtures.users_data(spark, sf_dir))
    out = sv.join_cards(out, fixtures.cards_data(spark, sf_dir))
    return sv.join_mcc(out, fixtures.mcc_codes(spark, sf_dir))


def q_insert_absent(spark, sf_dir):
    """All snapshots' rows into a bucketed table that has the oldest snapshot's."""
    tx = fixtures.transactions(spark, sf_dir)
    oldest = tx.agg(F.min("date_insertion")).scalar()
    _, name = _bucketed(spark, sf_dir, tx.where(F.col("date_insertion") == oldest), "target", "id")
    bucketed.insert_absent(spark, name, tx, "id", _p(spark, sf_dir, "scratch"), ["date_insertion"])
    return spark.table(name)


# ---- views by period, counts of a job --------------------------------------------------------

def _periods(spark, sf_dir):
    """Partial results by month of a gold table in which one month has other amounts and scores; then that month is replaced."""
    scored = gd.score_with_rules(gd.labelled(K.silver(spark, sf_dir)))
    gold = scored.select(*gd.GOLD_COLUMNS, F.date_format("date", "yyyy-MM").alias(period_views.PERIOD))
    one = gold.agg(F.max(period_views.PERIOD)).scalar()
    changed = F.col(period_views.PERIOD) == one
    old = gold.withColumns({"amount": F.when(changed, F.col("amount") * 3 + 1).otherwise(F.col("amount")),
                            "label_pred": F.when(changed, 1 - F.col("label_pred")).otherwise(F.col("label_pred"))})
    path = _p(spark, sf_dir, "periods")
    period_views.write_periods(old, path)
    period_views.write_periods(gold.where(changed), path)
    return path


def q_periods_global(spark, sf_dir):
    return period_views.global_fraud_rate(spark, _periods(spark, sf_dir))


def q_periods_city(spark, sf_dir):
    return period_views.fraud_by_city_state(spark, _periods(spark, sf_dir))


def q_periods_class(spark, sf_dir):
    return period_views.avg_amount_by_class(spark, _periods(spark, sf_dir))


def q_periods_clients(spark, sf_dir):
    return period_views.top_suspect_clients(spark, _periods(spark, sf_dir))


def q_views_registered(spark, sf_dir):
    """The registered view of suspect clients, by its name."""
    path = _p(spark, sf_dir, "gold_views", "transactions_scored")
    store.export_parquet(K.gold(spark, sf_dir), path)
    prefix = f"run_{uuid.uuid4().hex[:12]}_"
    views.register_views(spark.read.schema(GOLD).parquet(path), prefix)
    return spark.sql(f"SELECT * FROM {prefix}v_top_clients_suspects")


def q_row_counts_observed(spark, sf_dir):
    """The counts of ``row_counts`` as the bronze and silver jobs observed them while they wrote."""
    root, run = _p(spark, sf_dir, "jobs"), uuid.uuid4().hex[:12]
    d = fixtures.domain(spark, sf_dir)
    static = {"users_data": d["users"], "cards_data": d["cards"], "mcc_codes": d["mcc"], "train_fraud_labels": d["labels"]}
    jobs.bronze_job(spark, d["transactions"], static, root + "/bronze")
    jobs.silver_job(spark, root + "/bronze", f"cardwatch_run_{run}", root + "/warehouse", metrics_path=root + "/metrics")
    return store.read_counts(spark, root + "/metrics", "silver").selectExpr("metric AS stage", "CAST(value AS BIGINT) AS n")


# ---- published tables --------------------------------------------------------------------

def q_silver_table(spark, sf_dir):
    db = "cardwatch_silver_" + scope_of(sf_dir).replace("-", "_").replace(".", "_")
    # the catalog knows the table by name: it is overwritten as a whole, so its place may stay
    return store.save_table(spark, K.silver(spark, sf_dir), db, "transactions_cleaned",
                            shared_path(spark, scope_of(sf_dir), "warehouse"))


def q_silver_labelled_table(spark, sf_dir):
    """Catalog scan of the published silver table, ``WHERE label IS NOT NULL``."""
    table = q_silver_table(spark, sf_dir)
    return table.where(F.col("label").isNotNull())


def q_gold_export(spark, sf_dir):
    path = _p(spark, sf_dir, "gold", "transactions_scored")
    store.export_parquet(K.gold(spark, sf_dir), path)
    return spark.read.schema(GOLD).parquet(path)


RULES_RUN = "rules"


def _write_rule_metrics(spark, sf_dir):
    wide = evaluate.report(K.gold(spark, sf_dir))
    path = _p(spark, sf_dir, "metrics")
    store.write_metrics(store.metrics_long(wide, RULES_RUN), path)
    return path


def q_metrics_write(spark, sf_dir):
    path = _write_rule_metrics(spark, sf_dir)
    return spark.read.parquet(path).where(F.col("run_id") == RULES_RUN).select("metric", "value")


def q_metrics_read(spark, sf_dir):
    path = _write_rule_metrics(spark, sf_dir)
    return store.read_metrics(spark, path, RULES_RUN)


# ---- JDBC (embedded Derby) ----------------------------------------------------------------

def _db(sf_dir):
    return jdbc.derby_url("cardwatch_" + scope_of(sf_dir).replace("-", "_").replace(".", "_"))


def q_jdbc_partitioned_read(spark, sf_dir):
    url = _db(sf_dir)
    jdbc.write_table(fixtures.transactions(spark, sf_dir), url, "TRANSACTIONS", driver=jdbc.DERBY_DRIVER)
    d = jdbc.quote("date_insertion")
    newest = jdbc.read_query(spark, url, f"SELECT MAX({d}) AS d FROM TRANSACTIONS",
                             driver=jdbc.DERBY_DRIVER).first()[0]
    df = jdbc.read_bounded(spark, url, "TRANSACTIONS", "id", where=f"{d} = DATE('{newest}')",
                           partitions=4, driver=jdbc.DERBY_DRIVER)
    return df.drop("date_insertion")


def q_gold_jdbc(spark, sf_dir):
    url = _db(sf_dir)
    jdbc.write_table(K.gold(spark, sf_dir), url, "GOLD_TRANSACTIONS_SCORED", driver=jdbc.DERBY_DRIVER)
    return jdbc.read_query(spark, url, "SELECT * FROM GOLD_TRANSACTIONS_SCORED", driver=jdbc.DERBY_DRIVER)


# ---- streaming ---------------------------------------------------------------------------

def q_predict_stream(spark, sf_dir):
    from cardwatch.plans.predict import requests_from
    from cardwatch.streaming import predict_stream as ps

    inbox, outbox, ckpt = (f"{_p(spark, sf_dir, 'stream')}/{name}" for name in ("inbox", "outbox", "checkpoint"))
    requests_from(K.silver(spark, sf_dir)).write.mode("errorifexists").parquet(inbox)
    out = ps.run_to_completion(spark, inbox, outbox, ckpt)
    return out.withColumn("explication", F.array_join("explication", "; "))


def q_predict_fitted(spark, sf_dir):
    """Requests scored by the fitted, saved and loaded pipeline, in batch and as a stream: explanations, whether the text and
    the probability of each are sound, and whether the stream gives what the batch gives."""
    from cardwatch.plans import models
    from cardwatch.plans.predict import predict, requests_from
    from cardwatch.streaming import predict_stream as ps

    silver = K.silver(spark, sf_dir)
    model, _ = models.train(silver, "gbt")
    path = _p(spark, sf_dir, "model")
    models.save(model, path)
    loaded = models.load(path)
    inbox, outbox, ckpt = (f"{_p(spark, sf_dir, 'stream')}/{name}" for name in ("inbox", "outbox", "checkpoint"))
    requests_from(silver).write.parquet(inbox)
    requests = spark.read.schema(ps.request_schema()).parquet(inbox)
    streamed = ps.run_to_completion(spark, inbox, outbox, ckpt, loaded).selectExpr("id AS sid", "prediction AS s_prediction", "fraude_probabilite AS s_p")
    batch = predict(requests, loaded).join(streamed, F.expr("id = sid"), "left")
    return batch.select(
        "id", F.array_join("explication", "; ").alias("explication"),
        F.expr("prediction = IF(fraude_probabilite > 0.5, 'FRAUDE', 'TRANSACTION NORMALE') OR fraude_probabilite = 0.5").alias("sound"),
        F.expr("prediction <=> s_prediction AND fraude_probabilite <=> s_p").alias("streamed"))


IO_REGISTRY = {
    "snapshot_dates": q_snapshot_dates,
    "snapshot_bounds": q_snapshot_bounds,
    "bronze_write": q_bronze_write,
    "snapshot_latest": q_snapshot_latest,
    "dates_to_load": q_dates_to_load,
    "snapshot_recovered": q_snapshot_recovered,
    "bronze_num_files": q_bronze_num_files,
    "parquet_tolerant": q_parquet_tolerant,
    "views_registered": q_views_registered,
    "snapshot_manifests": q_snapshot_manifests,
    "static_snapshots": q_static_snapshots,
    "snapshot_prefix_70": q_snapshot_prefix_70,
    "ingest_transactions": q_ingest_transactions,
    "ingest_lines": q_ingest_lines,
    "ingest_prefix": q_ingest_prefix,
    "ingest_files": q_ingest_files,
    "dedupe_first_wins": q_dedupe_first_wins,
    "silver_join_bucketed": q_silver_join_bucketed,
    "insert_absent": q_insert_absent,
    "periods_global": q_periods_global,
    "periods_city": q_periods_city,
    "periods_class": q_periods_class,
    "periods_clients": q_periods_clients,
    "row_counts_observed": q_row_counts_observed,
    "csv_read": q_csv_read,
    "mcc_from_json": q_mcc_from_json,
    "mcc_from_one_object": q_mcc_from_one_object,
    "labels_from_json": q_labels_from_json,
    "json_permissive": q_json_permissive,
    "labels_from_object": q_labels_from_object,
    "json_good": q_json_good,
    "json_quarantine": q_json_quarantine,
    "silver_table": q_silver_table,
    "gold_export": q_gold_export,
    "metrics_write": q_metrics_write,
    "metrics_read": q_metrics_read,
    "jdbc_partitioned_read": q_jdbc_partitioned_read,
    "gold_jdbc": q_gold_jdbc,
    "predict_stream": q_predict_stream,
    "predict_fitted": q_predict_fitted,
}
