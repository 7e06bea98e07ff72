import itertools
import random

from cardwatch.operators import evaluate


def _from_matrix(spark, tn, fp, fn, tp):
    rows = [(0, 0.0)] * tn + [(0, 1.0)] * fp + [(1, 0.0)] * fn + [(1, 1.0)] * tp
    return spark.createDataFrame(rows, "label int, label_pred double")


def test_published_matrix_reproduces_metrics(spark):
    m = evaluate.classification_metrics(_from_matrix(spark, 2198, 331, 724, 1836)).first()
    assert round(m["accuracy"], 4) == 0.7927
    assert round(m["precision"], 4) == 0.8473
    assert round(m["recall"], 4) == 0.7172
    assert round(m["f1"], 4) == 0.7768


def test_no_predicted_positive(spark):
    m = evaluate.classification_metrics(_from_matrix(spark, 5, 0, 3, 0)).first()
    assert m["precision"] is None and m["recall"] == 0.0 and m["f1"] is None


def test_confusion_matrix_long_form(spark):
    cm = {(r["actual"], r["predicted"]): r["n"] for r in
          evaluate.confusion_matrix(_from_matrix(spark, 3, 0, 2, 1)).collect()}
    assert cm == {(0, 0): 3, (0, 1): 0, (1, 0): 2, (1, 1): 1}


def test_exact_auc_matches_pair_count(spark):
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 20))) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, fraud_probability double")
    pos = [s for lab, s in rows if lab == 1]
    neg = [s for lab, s in rows if lab == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    want = round(wins / (len(pos) * len(neg)), 6)
    assert evaluate.roc_auc(df).first()["auc"] == want


def test_roc_points_end_at_one(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "label int, fraud_probability double")
    pts = sorted((r["threshold"], r["fpr"], r["tpr"]) for r in evaluate.roc_points(df).collect())
    assert pts[0] == (0.1, 1.0, 1.0) and pts[-1] == (0.9, 0.0, 0.5)
