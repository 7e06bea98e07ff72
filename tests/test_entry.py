import duckdb
import pytest

import __spark_entry__ as E

FAST_ORACLE_KEYS = ["silver_transactions", "gold_scored", "v_global_fraud_rate", "v_fraud_by_city_state",
                    "v_avg_amount_by_class", "v_top_suspect_clients", "undersample_balanced", "roc_auc",
                    "string_index", "snapshot_prefix_70", "dedupe_first_wins", "labels_from_json"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["client_id", "nb_trans", "moyenne_proba", "nb_fraudes"]
    assert df.count() > 0


def test_every_oracle_key_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def _norm(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("key", FAST_ORACLE_KEYS)
def test_matches_duckdb(spark, duck, sf_small, key):
    df = E.queries()[key](spark, sf_small)
    res = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(ocols)
    want = sorted(tuple(str(_norm(r[ocols.index(c)])) for c in order) for r in res.fetchall())
    got = sorted(tuple(str(_norm(r[c])) for c in order) for r in df.collect())
    assert got == want


def test_declared_test_table_schemas_match_files(spark, sf_small):
    """The fixtures declare the test-table schemas instead of inferring them; they must agree."""
    from cardwatch import fixtures

    for name in fixtures.TEST_TABLES:
        declared = fixtures.table(spark, sf_small, name).schema
        inferred = spark.read.parquet(f"{sf_small}/{name}.parquet").schema
        assert [(f.name, f.dataType) for f in declared] == [(f.name, f.dataType) for f in inferred], name
