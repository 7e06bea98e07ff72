import numpy as np
import pytest

from cardwatch.llm import quality


def make(n, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        w = ["".join(rng.choice(list("abcdeimnorst"), rng.integers(2, 9))) for _ in range(rng.integers(5, 80))]
        bad = i % 4 == 0
        rows.append((i, " ".join(x + "!!" if bad else x for x in w), int(not bad)))
    return rows


@pytest.fixture()
def tables(spark, docs):
    rows = make(400)
    return rows, docs([(i, t) for i, t, _ in rows]), spark.createDataFrame([(i, q, 0) for i, _, q in rows if i % 5], "doc_id long, quality int, toxic int")


def test_held_out_accuracy(tables):
    rows, table, labels = tables
    model = quality.train(table, labels, metadata=("n_chars",))
    got = {r.doc_id: r.score for r in quality.score(table, model, ("n_chars",)).collect()}
    held = [(got[i] >= 0.3, q == 1) for i, _, q in rows if i % 5 == 0]
    assert np.mean([a == b for a, b in held]) > 0.97


def test_sum_of_squares_is_all_pairs():
    rng = np.random.default_rng(1)
    m = quality.Model(0.3, weights=rng.normal(size=9), factors=rng.normal(size=(9, 4)))
    row, value = np.array([1, 4, 6, 8]), rng.normal(size=4)
    pairs = sum(m.factors[row[i]] @ m.factors[row[j]] * value[i] * value[j] for i in range(4) for j in range(i))
    assert np.isclose(m.raw(np.zeros(4, dtype=int), row, value, 1)[0], 0.3 + m.weights[row] @ value + pairs)


def test_same_fit_whatever_the_partitions(tables):
    _, table, labels = tables
    a, b = (quality.train(table.repartition(n), labels.repartition(n), sample=100) for n in (2, 7))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.factors, b.factors)


def test_odd_rows(docs, odd, tables):
    _, table, labels = tables
    model = quality.train(table, labels, metadata=("n_chars",))
    out = quality.score(docs(odd).withColumnRenamed("lang", "score").withColumnRenamed("source", "__label"), model, ("n_chars",)).collect()
    assert len(out) == len(odd) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id == 4}) == 1  # repeated rows
    assert quality.score(docs([]), model, ("n_chars",)).collect() == []


def test_without_labels(spark, docs):
    table = docs([(1, "a"), (2, None)])
    kind = "doc_id long, quality int"
    none = quality.score(table, quality.train(table, spark.createDataFrame([], kind))).collect()
    assert [round(r.score, 6) for r in none] == [0.5, 0.5]
    nulls = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], kind)
    assert all(r.score > 0.99 for r in quality.score(table, quality.train(table, nulls)).collect())


def test_held_out_rows_of_the_table(spark):
    """Labels of held-out rows, which the fit hasn't seen."""
    sf_small = "/root/testdata/sf0.01"
    from cardwatch.llm.queries import op1_quality

    rows = op1_quality(spark, sf_small).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf_small}/documents.parquet").count()
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    held = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean(held) > 0.9


def test_one_row_for_each_id_is_learnt_from(spark, tables):
    """Repeated rows of labelled ids change nothing, and only one of an id's texts counts."""
    _, table, labels = tables
    once = quality.train(table, labels)
    again = quality.train(table.unionByName(table.where("doc_id < 20").crossJoin(spark.range(30)).drop("id")), labels)
    assert np.array_equal(once.weights, again.weights) and np.array_equal(once.factors, again.factors)
    other = table.where("doc_id = 1").selectExpr("doc_id", "concat(text, ' more') AS text", "lang", "source", "n_chars")
    a, b = (quality.train(t, labels) for t in (table.unionByName(other), other.unionByName(table.repartition(5))))
    assert np.array_equal(a.weights, b.weights)


def test_eight_thousand_rows_are_learnt_from(spark, docs, monkeypatch):
    got = []
    monkeypatch.setattr(quality, "fit", lambda *a: got.append(a))
    table = docs([(i, f"a text {i} of words" * (i % 3)) for i in range(9000)])
    quality.train(table, spark.range(9000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality"))
    of, bucket, count, stats, label = got[0]
    assert len(label) == len(stats) == 8000 and len(of) == len(bucket) == len(count)
    assert {of.dtype, bucket.dtype, count.dtype} == {np.dtype("int32")}
