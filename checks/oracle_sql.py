"""DuckDB oracle SQL, one statement per registered query key.

The views ``region nation customer orders lineitem`` are registered by the checker. The CTE
chain below is the same domain mapping the Spark fixtures build with the DataFrame API.
"""

from __future__ import annotations

MAPPING = """
transactions_all AS (
  SELECT o_orderkey AS id, o_orderdate AS date,
         CAST(o_custkey AS VARCHAR) AS client_id, CAST(o_custkey AS VARCHAR) AS card_id,
         concat(CASE WHEN o_orderkey % 10 = 0 THEN '$-' ELSE '$' END,
                CAST(CAST(floor(o_totalprice / 100) AS BIGINT) AS VARCHAR), '.50') AS amount_raw,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'No' ELSE 'Yes' END AS use_chip,
         CAST(o_custkey % 1000 AS VARCHAR) AS merchant_id,
         n_name AS merchant_city, r_name AS merchant_state,
         CASE WHEN o_orderkey % 7 = 0 THEN 'nan' ELSE concat(CAST(10000 + o_orderkey % 80000 AS VARCHAR), '.0') END AS zip,
         CAST(o_orderkey % 30 AS VARCHAR) AS mcc,
         CASE WHEN o_orderkey % 50 = 0 THEN 'Bad PIN' WHEN o_orderkey % 3 = 0 THEN 'nan' END AS errors
  FROM orders
  JOIN nation ON n_nationkey = o_orderkey % 25
  JOIN region ON r_regionkey = n_regionkey
), transactions_raw AS (
  SELECT t.*, DATE '2025-01-02' AS date_insertion FROM transactions_all t
  UNION ALL
  SELECT t.*, DATE '2025-01-01' AS date_insertion FROM transactions_all t
  WHERE id < (SELECT CAST(floor(count(*) * 0.7) AS BIGINT) FROM orders)
), transactions AS (
  SELECT id, date, client_id, card_id,
         TRY_CAST(regexp_replace(amount_raw, '[$,]', '', 'g') AS DOUBLE) AS amount,
         use_chip, merchant_id, merchant_city, merchant_state,
         CASE WHEN lower(trim(zip)) IN ('nan', '') THEN NULL ELSE regexp_replace(zip, '[.]0+$', '') END AS zip, mcc,
         CASE WHEN lower(trim(errors)) IN ('nan', '') THEN NULL ELSE errors END AS errors, date_insertion
  FROM transactions_raw
), users_data AS (
  SELECT c_custkey AS id,
         CASE c_mktsegment WHEN 'MACHINERY' THEN 'Female' WHEN 'BUILDING' THEN 'Male' WHEN 'HOUSEHOLD' THEN 'Female' WHEN 'FURNITURE' THEN 'Male' ELSE 'Unknown' END AS gender,
         CAST(300 + floor(abs(c_acctbal) / 20) AS BIGINT) AS credit_score,
         CAST(c_custkey % 11 AS BIGINT) AS num_credit_cards,
         CAST(20 + c_nationkey * 1.5 AS DOUBLE) AS latitude,
         CAST(-120 + c_nationkey * 2 AS DOUBLE) AS longitude,
         concat('$', CAST(20000 + c_custkey AS VARCHAR)) AS per_capita_income,
         concat('$', CAST(40000 + c_custkey AS VARCHAR)) AS yearly_income,
         concat('$1,', lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0'), '.25') AS total_debt
  FROM customer WHERE c_custkey % 20 <> 0
), cards_data AS (
  SELECT c_custkey AS id, c_custkey AS client_id,
         CASE WHEN c_custkey % 3 = 0 THEN 'Visa' WHEN c_custkey % 3 = 1 THEN 'Mastercard' ELSE 'Amex' END AS card_brand,
         CASE WHEN c_custkey % 2 = 0 THEN 'Debit' ELSE 'Credit' END AS card_type,
         CASE WHEN c_custkey % 4 = 0 THEN 'NO' ELSE 'YES' END AS has_chip,
         CAST(c_custkey % 7 AS BIGINT) AS num_cards_issued,
         concat('$', CAST(1000 + c_custkey % 9000 AS VARCHAR)) AS credit_limit
  FROM customer WHERE c_custkey % 10 <> 9
), mcc_codes AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS mcc_code, n_name AS description FROM nation
), train_fraud_labels AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id,
         CASE WHEN max(CASE WHEN l_returnflag = 'R' AND l_quantity >= 48 THEN 1 ELSE 0 END) = 1 THEN 'Yes' ELSE 'No' END AS label
  FROM lineitem GROUP BY l_orderkey
), latest AS (
  SELECT * EXCLUDE (date_insertion) FROM transactions
  WHERE date_insertion = (SELECT max(date_insertion) FROM transactions)
)"""


def money(x: str) -> str:
    return f"TRY_CAST(regexp_replace({x}, '[$,]', '', 'g') AS DOUBLE)"


JOINED = """
joined AS (
  SELECT t.*, m.description,
    u.gender, u.credit_score, u.num_credit_cards, u.latitude, u.longitude,
    u.per_capita_income, u.yearly_income, u.total_debt,
    c.client_id AS card_client_id, c.card_brand, c.card_type, c.has_chip, c.num_cards_issued, c.credit_limit,
    l.label
  FROM latest t
  LEFT JOIN users_data u ON t.client_id = CAST(u.id AS VARCHAR)
  LEFT JOIN cards_data c ON t.card_id = CAST(c.id AS VARCHAR)
  LEFT JOIN mcc_codes m ON t.mcc = m.mcc_code
  LEFT JOIN train_fraud_labels l ON CAST(t.id AS VARCHAR) = l.transaction_id
)"""

SILVER = f"""
silver AS (
  SELECT id, date, client_id, card_id, amount, use_chip, merchant_id, merchant_city, merchant_state, zip, mcc, errors, description,
    gender, credit_score, num_credit_cards, latitude, longitude,
    {money('per_capita_income')} AS per_capita_income,
    {money('yearly_income')} AS yearly_income,
    {money('total_debt')} AS total_debt,
    card_client_id, card_brand, card_type, has_chip, num_cards_issued,
    {money('credit_limit')} AS credit_limit,
    CASE WHEN label = 'Yes' THEN 1 ELSE 0 END AS label
  FROM joined WHERE amount > 0 AND id IS NOT NULL
)"""

RULES = [
    ("amount > 2000", "Montant élevé"),
    ("credit_score < 400", "Score de crédit faible"),
    ("(latitude > 50 OR latitude < 35)", "Localisation inhabituelle"),
    ("lower(use_chip) = 'no'", "Transaction sans puce"),
    ("num_cards_issued > 5", "Beaucoup de cartes émises"),
    ("num_credit_cards > 8", "Trop de cartes de crédit"),
    ("lower(gender) NOT IN ('male', 'female')", "Genre non identifié"),
]
NO_REASON = "Aucune anomalie détectée dans les règles simples."

K_EXPR = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p, _ in RULES)
REASONS_EXPR = ("CASE WHEN (" + K_EXPR + ") = 0 THEN '" + NO_REASON + "' ELSE concat_ws('; ', "
                + ", ".join(f"CASE WHEN {p} THEN '{t}' END" for p, t in RULES) + ") END")

SCORED = f"""
scored AS (
  SELECT s.*, {K_EXPR} AS k FROM silver s WHERE label IS NOT NULL
), gold AS (
  SELECT id, client_id, amount, merchant_city, merchant_state, label,
         CAST(CASE WHEN k >= 3 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS label_pred,
         CAST(k AS DOUBLE) / 7.0 AS fraud_probability
  FROM scored
)"""

COMPLETE = """
complete AS (
  SELECT * FROM silver
  WHERE amount IS NOT NULL AND credit_score IS NOT NULL AND num_credit_cards IS NOT NULL
    AND num_cards_issued IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL AND label IS NOT NULL
)"""


def hash_below(salt: str, fraction_hex: str, id_col: str = "id") -> str:
    return f"substr(md5(concat('{salt}', CAST({id_col} AS VARCHAR))), 1, 8) < '{fraction_hex}'"


BALANCED = """
balanced AS (
  SELECT * EXCLUDE (rn, mn) FROM (
    SELECT c.*, row_number() OVER (PARTITION BY label ORDER BY md5(concat('s1:', CAST(id AS VARCHAR))), id) AS rn,
           least(sum(label) OVER (), sum(1 - label) OVER ()) AS mn
    FROM complete c) x
  WHERE rn <= mn
)"""


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


BASE = (MAPPING, JOINED, SILVER)
GOLD = BASE + (SCORED,)
