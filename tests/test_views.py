from cardwatch.operators import views

GOLD = "id bigint, client_id string, amount double, merchant_city string, merchant_state string, " \
       "label int, label_pred double, fraud_probability double"


def test_empty_gold(spark):
    r = views.global_fraud_rate(spark.createDataFrame([], GOLD)).first()
    assert (r["total_transactions"], r["total_fraudes"], r["taux_fraude_percent"]) == (0, None, None)


def test_top_clients_null_first_and_ties(spark):
    rows = [(1, "b", 1.0, "c", "s", 0, 0.0, 0.5), (2, "a", 1.0, "c", "s", 0, 0.0, 0.5),
            (3, "z", 1.0, "c", "s", 0, 1.0, None), (4, "c", 1.0, "c", "s", 0, 0.0, 0.1)]
    out = [r["client_id"] for r in views.top_suspect_clients(spark.createDataFrame(rows, GOLD), k=3).collect()]
    assert out == ["z", "a", "b"]


def test_views_group_null_keys(spark):
    rows = [(1, "a", 10.0, None, None, 0, 1.0, 0.5), (2, "a", 30.0, None, None, 0, 0.0, 0.5)]
    g = spark.createDataFrame(rows, GOLD)
    r = views.fraud_by_city_state(g).first()
    assert (r["merchant_city"], r["total_transactions"], r["nb_fraudes"]) == (None, 2, 1)
    by = {r["est_fraude"]: r["montant_moyen"] for r in views.avg_amount_by_class(g).collect()}
    assert by == {1.0: 10.0, 0.0: 30.0}


def test_register_views(spark):
    rows = [(1, "a", 10.0, "c", "s", 1, 1.0, 0.9)]
    names = views.register_views(spark.createDataFrame(rows, GOLD), prefix="t_")
    assert spark.sql(f"SELECT total_transactions FROM {names[0]}").first()[0] == 1
    assert spark.sql("SELECT client_id FROM t_v_top_clients_suspects").first()[0] == "a"
