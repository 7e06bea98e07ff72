import math

import corpus_pipeline
from cardwatch.llm.common import stage
from tests.llm.test_exact_dedup import brute as exact
from tests.llm.test_near_dedup import brute as near
from tests.llm.test_packing import check


def test_stages_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    columns, before = docs.columns, None
    for name, function in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(function(spark, docs, sf_small), name)
        if name != "best_fit_packing":
            assert docs.columns == columns
            after = {r.doc_id: r.text for r in docs.collect()}
            assert after and all(before[i] == t for i, t in after.items())
        if name == "quality_filter":
            dropped = [labels[i] for i in before if i not in after and i in labels]
            assert dropped and not sum(dropped)  # clean documents stay
        if name == "exact_dedup":
            assert {*after} == {keep for _, keep, _, _ in exact([*before.items()])}
        if name == "near_dedup":
            assert sorted(after) == sorted(min(c) for c in near([*before.items()]))
    rows = docs.collect()
    assert {r.doc_id for r in rows} == {*before}
    n = check(rows, 1024)
    least = math.ceil(sum(r.length for r in rows) / 1024)
    assert n <= least * 1.02 + 1


def test_quality_filter_rejects(spark):
    """With more labels than the smallest table has, nearly all bad documents go and clean ones stay."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.quality_filter(spark, docs, sf).select("doc_id").collect()}
    bad, clean = ([i in kept for i, q in labels.items() if q == x] for x in (0, 1))
    assert sum(bad) <= 0.05 * len(bad) and sum(clean) >= 0.99 * len(clean)


def test_odd_rows(spark, docs, odd, sf_small):
    """Nulls, empty and long texts, repeated rows and clashing names pass through every stage."""
    table = docs(odd).selectExpr("*", "1 AS quality_score", "2 AS node", "3 AS __own_hash", "4 AS bucket")
    for name, function in corpus_pipeline.STAGES:
        out = stage(function(spark, table, sf_small), name)
        if name != "best_fit_packing":
            assert out.columns == table.columns
        assert out.count()


def test_empty_table(spark, docs, sf_small):
    table = docs([])
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, table, sf_small).collect() == []


def test_registered():
    import __spark_entry__

    keys = __spark_entry__.queries()
    assert "pipeline" in keys and [sum(k.startswith(f"op{n}_") for k in keys) for n in range(1, 14)] == [1] * 13


def test_a_worker_drops_what_other_work_kept():
    """Python workers go from stage to stage: the tables of one stage don't stay beside the next one's."""
    import public_tokenizers

    from cardwatch.llm import bpe
    from cardwatch.llm.common import kept

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        file = f.read()
    first = bpe.loaded(file)
    ids = first[1].encode(["a text, twice a text"])[0].tolist()
    assert bpe.loaded(file) is first and len(kept("bpe")) == 1
    assert kept("near_dedup") == {} and kept("bpe") == {}
    again = bpe.loaded(file)
    assert again is not first and again[1].encode(["a text, twice a text"])[0].tolist() == ids
