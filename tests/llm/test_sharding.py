import collections
import math
import struct
import zlib

import xxhash

from cardwatch.llm import sharding


def draw(key, path, i, weight):
    h = xxhash.xxh64_intdigest(str(key).encode() if key is not None else b"", 42) if key is not None else 42
    h = xxhash.xxh64_intdigest(path.encode(), h)
    h = xxhash.xxh64_intdigest(struct.pack("<i", i), h)
    return -math.log(((h >> 11) + 0.5) * 2.0 ** -53) / weight


def brute(shape, key):
    level, path = shape, ""
    while True:
        i = min(range(len(level)), key=lambda k: (draw(key, path, k, sharding._weight(level[k])), k))
        if isinstance(level[i], tuple):
            return level[i][0]
        level, path = level[i], f"{path}/{i}" if path else str(i)


def check_slots(rows):
    for rows_ in collections.defaultdict(list, {s: [r for r in rows if r.shard == s] for s in {r.shard for r in rows}}).values():
        assert sorted(r.slot for r in rows_) == list(range(len(rows_)))


def test_whole_table(spark, sf_small):
    from cardwatch.llm.queries import op3_sharding

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = op3_sharding(spark, sf_small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check_slots(rows)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert r.shard == brute(sharding.tree(24), r.doc_id)
        assert r.grown_shard == brute(sharding.tree(24, 1), r.doc_id)
        assert r.grown_shard in (r.shard, 24)


def test_odd_rows(docs, odd):
    rows = sharding.shard(docs(odd).withColumnRenamed("lang", "shard").withColumnRenamed("source", "lane")).collect()
    assert len(rows) == len(odd)
    check_slots(rows)
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id == 1} == {(8, 0)}


def test_hot_key_is_numbered_in_many_buckets(docs, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 16)
    rows = sharding.shard(docs([(7, "copy")] * 900 + [(i, "t") for i in range(100)])).collect()
    check_slots(rows)


def test_shares_follow_weights(spark):
    shape = [[[(0, 1.0), (1, 3.0)]], [[(2, 2.0)], [(3, 2.0)]]]
    more = [[[(0, 1.0), (1, 3.0)]], [[(2, 2.0)], [(3, 6.0)]]]
    ids = spark.range(20_000)
    rows = ids.selectExpr(f"{sharding.shard_of(shape, 'id')} AS a", f"{sharding.shard_of(more, 'id')} AS b").collect()
    share = collections.Counter(r.a for r in rows)
    for s, w in ((0, 1), (1, 3), (2, 2), (3, 2)):
        assert abs(share[s] / 20_000 - w / 8) < 0.015
    # nothing moves between shards of the subtree whose weights stay
    assert all(r.a == r.b or r.b in (2, 3) for r in rows)


def test_empty_table(docs):
    assert sharding.shard(docs([])).collect() == []


def test_plan_has_no_python(docs):
    plan = sharding.shard(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
