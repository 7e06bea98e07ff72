"""Oracle SQL per key (DuckDB dialect)."""

from __future__ import annotations

from checks.oracle_sql import (BASE, GOLD, MAPPING, JOINED, NO_REASON, REASONS_EXPR, K_EXPR, money, with_)

ORACLE: dict[str, str] = {}

ORACLE["join_users"] = with_(MAPPING, body=f"""
SELECT t.*, u.gender, u.credit_score, u.num_credit_cards, u.latitude, u.longitude,
       u.per_capita_income, u.yearly_income, u.total_debt
FROM latest t LEFT JOIN users_data u ON t.client_id = CAST(u.id AS VARCHAR)""")

ORACLE["join_cards"] = with_(MAPPING, body="""
SELECT t.*, c.client_id AS card_client_id, c.card_brand, c.card_type, c.has_chip, c.num_cards_issued, c.credit_limit
FROM latest t LEFT JOIN cards_data c ON t.card_id = CAST(c.id AS VARCHAR)""")

ORACLE["join_mcc"] = with_(MAPPING, body="""
SELECT t.*, m.description FROM latest t LEFT JOIN mcc_codes m ON t.mcc = m.mcc_code""")

ORACLE["join_labels"] = with_(MAPPING, body="""
SELECT t.*, l.label FROM latest t LEFT JOIN train_fraud_labels l ON CAST(t.id AS VARCHAR) = l.transaction_id""")

ORACLE["silver_join"] = with_(MAPPING, JOINED, body="SELECT * FROM joined")

ORACLE["silver_positive_amount"] = with_(MAPPING, body="SELECT * FROM latest WHERE amount > 0")

ORACLE["silver_clean_money"] = with_(MAPPING, body=f"""
SELECT COALESCE(u.id, c.id) AS id, {money('u.per_capita_income')} AS per_capita_income,
       {money('u.yearly_income')} AS yearly_income, {money('u.total_debt')} AS total_debt,
       {money('c.credit_limit')} AS credit_limit
FROM users_data u FULL OUTER JOIN cards_data c ON u.id = c.id""")

ORACLE["label_encode"] = with_(MAPPING, body="""
SELECT t.id, CASE WHEN l.label = 'Yes' THEN 1 ELSE 0 END AS label
FROM latest t LEFT JOIN train_fraud_labels l ON CAST(t.id AS VARCHAR) = l.transaction_id""")

ORACLE["silver_transactions"] = with_(*BASE, body="SELECT * FROM silver")

ORACLE["gold_scored"] = with_(*GOLD, body="SELECT * FROM gold")

ORACLE["v_global_fraud_rate"] = with_(*GOLD, body="""
SELECT count(*) AS total_transactions,
       CAST(sum(CASE WHEN label_pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS total_fraudes,
       CAST(round(CAST(100 AS DOUBLE) * sum(CASE WHEN label_pred = 1 THEN 1 ELSE 0 END) / count(*), 2) AS DOUBLE)
         AS taux_fraude_percent
FROM gold""")

ORACLE["v_fraud_by_city_state"] = with_(*GOLD, body="""
SELECT merchant_state, merchant_city, count(*) AS total_transactions,
       CAST(sum(CASE WHEN label_pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS nb_fraudes
FROM gold GROUP BY merchant_state, merchant_city""")

ORACLE["v_avg_amount_by_class"] = with_(*GOLD, body="""
SELECT label_pred AS est_fraude, count(*) AS nb_trans, round(avg(amount), 2) AS montant_moyen
FROM gold GROUP BY label_pred""")

ORACLE["v_top_suspect_clients"] = with_(*GOLD, body="""
SELECT client_id, count(*) AS nb_trans, round(avg(fraud_probability), 4) AS moyenne_proba,
       CAST(sum(CASE WHEN label_pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS nb_fraudes
FROM gold GROUP BY client_id ORDER BY moyenne_proba DESC NULLS FIRST, client_id LIMIT 100""")

ORACLE["explain_rules"] = with_(*BASE, body=f"""
SELECT id, {K_EXPR} AS rules_fired, {REASONS_EXPR} AS explication FROM silver""")

from checks.oracle_sql import BALANCED, COMPLETE, hash_below  # noqa: E402

TRAIN = BASE + (COMPLETE,)
CATS = ["use_chip", "card_brand", "card_type", "has_chip", "gender"]

ORACLE["predict_batch"] = with_(*BASE, body=f"""
SELECT id,
       CASE WHEN ({K_EXPR}) >= 3 THEN 'FRAUDE' ELSE 'TRANSACTION NORMALE' END AS prediction,
       round(CAST({K_EXPR} AS DOUBLE) / 7.0, 4) AS fraude_probabilite,
       {REASONS_EXPR} AS explication
FROM (SELECT id, amount, CAST(credit_score AS DOUBLE) AS credit_score,
             CAST(num_credit_cards AS DOUBLE) AS num_credit_cards,
             CAST(num_cards_issued AS DOUBLE) AS num_cards_issued, latitude, longitude,
             use_chip, card_brand, card_type, has_chip, gender
      FROM silver) r
WHERE amount IS NOT NULL AND credit_score IS NOT NULL AND num_credit_cards IS NOT NULL
  AND num_cards_issued IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
  AND use_chip IS NOT NULL AND card_brand IS NOT NULL AND card_type IS NOT NULL
  AND has_chip IS NOT NULL AND gender IS NOT NULL""")

ORACLE["silver_labelled"] = with_(*BASE, body="SELECT * FROM silver WHERE label IS NOT NULL")

ORACLE["train_complete_rows"] = with_(*TRAIN, body="SELECT * FROM complete")

ORACLE["row_counts"] = with_(*TRAIN, body="""
SELECT 'transactions' AS stage, count(*) AS n FROM latest
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'complete', count(*) FROM complete""")

ORACLE["class_counts"] = with_(*TRAIN, body="""
SELECT count(*) FILTER (WHERE label = 0) AS count_0, count(*) FILTER (WHERE label = 1) AS count_1,
       least(count(*) FILTER (WHERE label = 0), count(*) FILTER (WHERE label = 1)) AS minority
FROM complete""")

ORACLE["class_weights"] = with_(*TRAIN, body="""
SELECT id, label,
       CAST(label AS DOUBLE) * (SELECT CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE)
                                       / count(*) FILTER (WHERE label = 1) FROM complete)
       + (CAST(1.0 AS DOUBLE) - CAST(label AS DOUBLE)) AS class_weight
FROM complete""")

ORACLE["undersample_balanced"] = with_(*TRAIN, BALANCED, body="SELECT id, label FROM balanced")

ORACLE["sample_fraction"] = with_(*TRAIN, body=f"""
SELECT id, label FROM complete WHERE {hash_below('s2:', '1999999a')}""")

ORACLE["sample_if_large"] = with_(*TRAIN, body=f"""
SELECT id, label FROM complete
WHERE (SELECT count(*) FROM complete) <= 50000 OR {hash_below('s3:', '4ccccccd')}""")

ORACLE["split_train"] = with_(*TRAIN, BALANCED, body=f"""
SELECT id, label FROM balanced WHERE {hash_below('', 'cccccccd')}""")

ORACLE["split_test"] = with_(*TRAIN, BALANCED, body=f"""
SELECT id, label FROM balanced WHERE NOT ({hash_below('', 'cccccccd')})""")

_IDX = ",".join(f"""
idx_{c} AS (SELECT {c} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS idx
            FROM complete WHERE {c} IS NOT NULL GROUP BY {c})""" for c in CATS)
_IDX_COLS = ", ".join(f"COALESCE(i_{c}.idx, (SELECT CAST(count(*) AS DOUBLE) FROM idx_{c})) AS {c}_idx"
                      for c in CATS)
_IDX_JOINS = " ".join(f"LEFT JOIN idx_{c} i_{c} ON s.{c} = i_{c}.v" for c in CATS)
INDEXED = f"""
indexed AS (SELECT s.*, {_IDX_COLS} FROM complete s {_IDX_JOINS})"""

ORACLE["string_index"] = with_(*TRAIN, _IDX, INDEXED, body=f"""
SELECT id, {", ".join(f"{c}_idx" for c in CATS)} FROM indexed""")

_LARGE = {"id_text": "CAST(id AS VARCHAR)", "client_id": "client_id"}
ORACLE["category_index_large"] = with_(*TRAIN, ",".join(f"""
idx_{c} AS (SELECT {t} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {t}) - 1 AS DOUBLE) AS idx
            FROM complete WHERE {t} IS NOT NULL GROUP BY 1)""" for c, t in _LARGE.items()), body="SELECT id, " + ", ".join(
    f"COALESCE(i_{c}.idx, (SELECT CAST(count(*) AS DOUBLE) FROM idx_{c})) AS {c}_idx" for c in _LARGE)
    + " FROM complete s " + " ".join(f"LEFT JOIN idx_{c} i_{c} ON {t} = i_{c}.v" for c, t in _LARGE.items()))

_FEATS = ["amount", "credit_score", "num_credit_cards", "num_cards_issued", "latitude", "longitude"] + \
    [f"{c}_idx" for c in CATS]
ORACLE["feature_rows"] = with_(*TRAIN, _IDX, INDEXED, body="SELECT id, " + ", ".join(
    f"CAST({f} AS DOUBLE) AS f_{f}" for f in _FEATS) + " FROM indexed")

ORACLE["confusion_matrix"] = with_(*GOLD, body="""
SELECT a.actual, a.predicted,
       (SELECT count(*) FROM gold g WHERE g.label = a.actual AND g.label_pred = a.predicted) AS n
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) a(actual, predicted)""")

_COUNTS = """
counts AS (
  SELECT CAST(count(*) FILTER (WHERE label = 0 AND label_pred = 0) AS DOUBLE) AS tn,
         CAST(count(*) FILTER (WHERE label = 0 AND label_pred = 1) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (WHERE label = 1 AND label_pred = 0) AS DOUBLE) AS fn,
         CAST(count(*) FILTER (WHERE label = 1 AND label_pred = 1) AS DOUBLE) AS tp
  FROM gold
), pr AS (
  SELECT tn, fp, fn, tp,
         CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END AS recall
  FROM counts
)"""

ORACLE["classification_metrics"] = with_(*GOLD, _COUNTS, body="""
SELECT CASE WHEN tp + tn + fp + fn = 0 THEN NULL ELSE (tp + tn) / (tp + tn + fp + fn) END AS accuracy,
       precision, recall,
       CASE WHEN precision + recall = 0 THEN NULL ELSE 2.0 * precision * recall / (precision + recall) END AS f1
FROM pr""")

_ROC = """
sg AS (SELECT fraud_probability AS s, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
       FROM gold GROUP BY 1),
cum AS (SELECT s, pos, neg,
               sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
               sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
               sum(pos) OVER () AS tp, sum(neg) OVER () AS tn
        FROM sg)"""

ORACLE["roc_auc"] = with_(*GOLD, _ROC, body="""
SELECT round(sum(CAST(neg AS DOUBLE) * (cp - pos / 2.0)) / (CAST(max(tp) AS DOUBLE) * CAST(max(tn) AS DOUBLE)), 6)
       AS auc FROM cum""")

ORACLE["roc_curve"] = with_(*GOLD, _ROC, body="""
SELECT s AS threshold, CAST(cn AS DOUBLE) / tn AS fpr, CAST(cp AS DOUBLE) / tp AS tpr FROM cum""")

# ---- sources, snapshots, sinks -------------------------------------------------------------

_DATE_TXT = "strftime(date_insertion, '%Y-%m-%d')"

ORACLE["snapshot_dates"] = with_(MAPPING, body=f"SELECT DISTINCT {_DATE_TXT} AS snapshot_date FROM transactions")

ORACLE["snapshot_bounds"] = with_(MAPPING, body=f"""
SELECT {_DATE_TXT} AS snapshot_date, min(id) AS lo, max(id) AS hi, count(*) AS n FROM transactions GROUP BY 1""")

ORACLE["bronze_write"] = with_(MAPPING, body="SELECT * FROM transactions")

ORACLE["bronze_num_files"] = with_(MAPPING, body=f"""
SELECT {_DATE_TXT} AS snapshot_date, count(*) AS n, CAST(3 AS BIGINT) AS files FROM transactions GROUP BY 1""")
ORACLE["parquet_tolerant"] = with_(MAPPING, body="SELECT * FROM users_data")
ORACLE["views_registered"] = ORACLE["v_top_suspect_clients"]
ORACLE["snapshot_recovered"] = ORACLE["bronze_write"]

ORACLE["snapshot_manifests"] = with_(MAPPING, body=f"""
SELECT {_DATE_TXT} AS snapshot_date, count(*) AS n, true AS sound FROM transactions GROUP BY 1""")

ORACLE["snapshot_latest"] = with_(MAPPING, body="SELECT * FROM latest")

ORACLE["dates_to_load"] = with_(MAPPING, body=f"""
SELECT DISTINCT {_DATE_TXT} AS snapshot_date FROM transactions
WHERE date_insertion <> (SELECT min(date_insertion) FROM transactions)""")

ORACLE["static_snapshots"] = with_(MAPPING, body="""
SELECT u.*, d.date_insertion FROM users_data u CROSS JOIN (SELECT DISTINCT date_insertion FROM transactions) d""")

ORACLE["snapshot_prefix_70"] = with_(MAPPING, body="""
SELECT id FROM (SELECT id, row_number() OVER (ORDER BY id) AS rn, count(*) OVER () AS c FROM transactions_all) x
WHERE rn <= floor(c * 0.7)""")

_NAN = "CASE WHEN lower(trim({0})) IN ('nan', '') THEN NULL ELSE {0} END AS {0}"
ORACLE["ingest_transactions"] = with_(MAPPING, body=f"""
SELECT CAST(TRY_CAST(CAST(id AS VARCHAR) AS DOUBLE) AS BIGINT) AS id, date,
       {_NAN.format('client_id')}, {_NAN.format('card_id')},
       {money('amount_raw')} AS amount,
       {_NAN.format('use_chip')}, {_NAN.format('merchant_id')}, {_NAN.format('merchant_city')}, {_NAN.format('merchant_state')},
       CASE WHEN lower(trim(zip)) IN ('nan', '') THEN NULL ELSE regexp_replace(zip, '[.]0+$', '') END AS zip,
       {_NAN.format('mcc')}, {_NAN.format('errors')},
       DATE '2025-01-02' AS date_insertion
FROM transactions_all WHERE TRY_CAST(CAST(id AS VARCHAR) AS DOUBLE) IS NOT NULL""")

ORACLE["dedupe_first_wins"] = with_(MAPPING, body="""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY date_insertion) AS rn FROM transactions) x WHERE rn = 1""")

ORACLE["csv_read"] = with_(MAPPING, body="SELECT * FROM users_data")
ORACLE["mcc_from_json"] = with_(MAPPING, body="SELECT * FROM mcc_codes")
ORACLE["labels_from_json"] = with_(MAPPING, body="SELECT * FROM train_fraud_labels")
ORACLE["json_permissive"] = with_(MAPPING, body="SELECT * FROM cards_data")
ORACLE["labels_from_object"] = with_(MAPPING, body="""
SELECT transaction_id, label || ', "checked" \\ {' || transaction_id || '}, ' || CASE WHEN label = 'Yes' THEN 'é,' || chr(10) ELSE '' END AS label
FROM train_fraud_labels""")
ORACLE["json_good"] = with_(MAPPING, body="SELECT * FROM cards_data WHERE id % 13 NOT IN (1, 2, 3, 4)")
ORACLE["json_quarantine"] = with_(MAPPING, body="""
SELECT CASE id % 13 WHEN 1 THEN '{"id":' || id || ',"card_brand":"' WHEN 2 THEN '{"id":' || id || ',"client_id":"none","num_cards_issued":[1]}'
                    WHEN 3 THEN '[' || id || ']' ELSE 'card ' || id END AS record,
       CASE id % 13 WHEN 2 THEN 'does not fit: client_id, num_cards_issued' WHEN 3 THEN 'not an object' ELSE 'not JSON' END AS reason, true AS placed
FROM cards_data WHERE id % 13 IN (1, 2, 3, 4)""")
ORACLE["silver_table"] = ORACLE["silver_transactions"]
ORACLE["gold_export"] = ORACLE["gold_scored"]

_AUC = """
, auc AS (SELECT round(sum(CAST(neg AS DOUBLE) * (cp - pos / 2.0)) / (CAST(max(tp) AS DOUBLE) * CAST(max(tn) AS DOUBLE)), 6)
          AS auc FROM cum)
, wide AS (
  SELECT CASE WHEN tp + tn + fp + fn = 0 THEN NULL ELSE (tp + tn) / (tp + tn + fp + fn) END AS accuracy,
         precision, recall,
         CASE WHEN precision + recall = 0 THEN NULL ELSE 2.0 * precision * recall / (precision + recall) END AS f1,
         (SELECT auc FROM auc) AS auc
  FROM pr)"""

ORACLE["metrics_write"] = with_(*GOLD, _COUNTS, _ROC + _AUC, body="""
SELECT 'accuracy' AS metric, accuracy AS value FROM wide
UNION ALL SELECT 'precision', precision FROM wide
UNION ALL SELECT 'recall', recall FROM wide
UNION ALL SELECT 'f1', f1 FROM wide
UNION ALL SELECT 'auc', auc FROM wide
UNION ALL SELECT 'tn', tn FROM pr UNION ALL SELECT 'fp', fp FROM pr UNION ALL SELECT 'fn', fn FROM pr UNION ALL SELECT 'tp', tp FROM pr""")

ORACLE["metrics_read"] = with_(*GOLD, _COUNTS, _ROC + _AUC, body="SELECT wide.*, tn, fp, fn, tp FROM wide, pr")

ORACLE["jdbc_partitioned_read"] = ORACLE["snapshot_latest"]
ORACLE["gold_jdbc"] = ORACLE["gold_scored"]
ORACLE["predict_stream"] = ORACLE["predict_batch"]
ORACLE["predict_fitted"] = with_(*BASE, body="SELECT id, explication, true AS sound, true AS streamed FROM (" + ORACLE["predict_batch"].split(BASE[-1])[-1] + ") p")

# ---- other plans for the same rows, and files with odd ids ------------------------------------

ORACLE["silver_join_merge"] = ORACLE["silver_join"]
ORACLE["silver_join_bucketed"] = ORACLE["silver_join"]
ORACLE["insert_absent"] = ORACLE["dedupe_first_wins"]
ORACLE["row_counts_observed"] = ORACLE["row_counts"]
ORACLE["periods_global"] = ORACLE["v_global_fraud_rate"]
ORACLE["periods_city"] = ORACLE["v_fraud_by_city_state"]
ORACLE["periods_class"] = ORACLE["v_avg_amount_by_class"]
ORACLE["periods_clients"] = ORACLE["v_top_suspect_clients"]
ORACLE["undersample_histogram"] = ORACLE["undersample_balanced"]
ORACLE["sample_large"] = with_(*TRAIN, body=f"""
SELECT id, label FROM complete WHERE (SELECT count(*) FROM complete) <= 100 OR {hash_below('s3:', '4ccccccd')}""")
ORACLE["mcc_from_one_object"] = ORACLE["mcc_from_json"]

_BY_AMOUNT = _ROC.replace("fraud_probability AS s", "amount AS s")
ORACLE["roc_by_amount"] = with_(*GOLD, _BY_AMOUNT, body="""
SELECT s AS threshold, CAST(cn AS DOUBLE) / tn AS fpr, CAST(cp AS DOUBLE) / tp AS tpr,
       (SELECT round(sum(CAST(neg AS DOUBLE) * (cp - pos / 2.0)) / (CAST(max(tp) AS DOUBLE) * CAST(max(tn) AS DOUBLE)), 6) FROM cum) AS auc
FROM cum""")

_LINES = """
lines AS (
  SELECT CASE l_orderkey % 11 WHEN 0 THEN 'NaN' WHEN 1 THEN concat(CAST(l_orderkey AS VARCHAR), '.75')
              WHEN 2 THEN CAST(9007199254740992 + l_orderkey AS VARCHAR) WHEN 3 THEN '1e300' ELSE CAST(l_orderkey AS VARCHAR) END AS id_text,
         l_partkey * 100000000 + l_suppkey * 1000 + CAST(l_quantity AS BIGINT) - l_linenumber * 10000000000000000 AS position, * FROM lineitem
), typed AS (
  SELECT CASE WHEN regexp_full_match(id_text, '[0-9]+') THEN CAST(id_text AS BIGINT)
              WHEN regexp_full_match(id_text, '[0-9]+[.][0-9]+') THEN CAST(split_part(id_text, '.', 1) AS BIGINT) END AS id, *
  FROM lines
), first_lines AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY position) AS rn FROM typed WHERE id IS NOT NULL) x WHERE rn = 1
)"""
ORACLE["ingest_lines"] = with_(_LINES, body="""
SELECT id, l_shipdate AS date, CAST(l_suppkey AS VARCHAR) AS client_id, CAST(l_partkey AS VARCHAR) AS card_id,
       CAST(floor(l_extendedprice) AS DOUBLE) AS amount, l_returnflag AS use_chip, CAST(l_linenumber AS VARCHAR) AS merchant_id,
       l_linestatus AS merchant_city, l_returnflag AS merchant_state, CAST(l_partkey AS VARCHAR) AS zip,
       CAST(l_linenumber AS VARCHAR) AS mcc, CAST(NULL AS VARCHAR) AS errors, DATE '2025-01-02' AS date_insertion
FROM first_lines""")
ORACLE["ingest_files"] = ORACLE["ingest_lines"].replace("ORDER BY position", "ORDER BY 8 - l_linenumber, position")
ORACLE["ingest_prefix"] = with_(_LINES, body="""
SELECT id FROM (SELECT id, row_number() OVER (ORDER BY id) AS r FROM first_lines) x
WHERE r <= (SELECT floor(count(*) * 0.1) FROM lines)""")

# ---- models: what can be counted ---------------------------------------------------------------


def _counts(prepared: str, variant: str, *ctes: str) -> str:
    inside = hash_below('', 'cccccccd')
    parts = ", ".join(f"count(*) FILTER (WHERE {'' if part == 'train' else 'NOT '}({inside}) AND label = {label}) AS {part}_{label}"
                      for part in ("train", "test") for label in (0, 1))
    return with_(*TRAIN, *ctes, body=f"""
SELECT {parts}, count(*) FILTER (WHERE NOT ({inside})) AS matrix_total, true AS auc_ok, true AS probabilities_ok, '{variant}' AS variant
FROM ({prepared}) p""")


ORACLE["train_gbt"] = _counts("SELECT * FROM balanced", "gbt", BALANCED)
ORACLE["train_rf_balanced"] = _counts("SELECT * FROM balanced", "rf_balanced", BALANCED)
ORACLE["train_rf_weighted"] = _counts(ORACLE["sample_fraction"].split("\n")[-1], "rf_medium")
ORACLE["train_rf_basic"] = _counts("\n".join(ORACLE["sample_if_large"].split("\n")[-2:]), "rf_basic")
ORACLE["model_roundtrip"] = with_(*BASE, body="""
SELECT id, client_id, amount, merchant_city, merchant_state, label,
       credit_score IS NOT NULL AND num_credit_cards IS NOT NULL AND num_cards_issued IS NOT NULL AND latitude IS NOT NULL
         AND longitude IS NOT NULL AND amount IS NOT NULL AS scored, true AS same, true AS probability_ok
FROM silver""")
