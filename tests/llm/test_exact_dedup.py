import hashlib
import re

from cardwatch.llm import exact_dedup as ex
from cardwatch.llm.common import keep_rows


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    out = []
    for content, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(i, keep, len(members), hashlib.sha256(content.encode()).hexdigest()) for i, _ in members]
    return sorted(out, key=str)


def result(df):
    rows = df.collect()
    return rows, sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str)


def test_odd_rows(docs, odd):
    rows, got = result(ex.exact_dedup(docs(odd).withColumnRenamed("lang", "key").withColumnRenamed("source", "content")))
    assert got == brute(odd)
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})  # one row of each group, repeated rows too


def test_groups_over_many_tasks(docs):
    """A third of all rows in one group, read by many tasks; blanks decide which row stays."""
    data = [(i, "same text" + " " * (i == 77)) if i % 3 == 0 or i == 77 else (i, f"text {i // 2}") for i in range(600)]
    rows, got = result(ex.exact_dedup(docs(data).repartition(16)))
    assert got == brute(data)
    assert {r.keep_id for r in rows if r.group_size > 100} == {77}


def test_directory_doubles(docs):
    entries = ex._entries(docs([(i, f"{i} " * 50) for i in range(400)] + [(1000 + i, "hot") for i in range(50)]))
    out = ex.with_buckets(entries, 2000)
    sizes = {}
    for r in out.select("key", "size", "bucket").collect():
        depth = r.bucket.bit_length() - 1
        assert r.bucket == 1 << depth | (r.key % (1 << 64)) >> (64 - depth)  # a prefix of the key
        sizes.setdefault(r.bucket, []).append((r.key, r.size))
    assert len({b.bit_length() for b in sizes}) > 1  # some buckets are deeper than others
    for rows in sizes.values():
        assert sum(s for _, s in rows) <= 2000 or len({k for k, _ in rows}) == 1


def test_equal_keys_of_unequal_texts(docs, monkeypatch):
    class Same:
        def __init__(self, *_, **__):
            pass

        def digest(self):
            return bytes(8)

    import types

    fake = types.SimpleNamespace(blake2b=Same, sha256=hashlib.sha256)
    monkeypatch.setattr(ex, "hashlib", fake)
    data = [(i, f"t{i % 5}") for i in range(20)]
    # the functions run here in the driver's process, so that the patch holds
    import pyarrow as pa

    class Frame:
        def __init__(self, df):
            self.schema, self.df = df.schema, df

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):  # noqa: N802
            self.run = run
            return self

    f = ex._entries(Frame(docs(data)))
    monkeypatch.setattr(ex, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in data], "text": [t for _, t in data]})
    entries = list(f.run(iter([batch, ])))
    assert len({k for b in entries for k in b.column("key").to_pylist()}) == 1
    own = ex._own(Frame(docs(data)), docs(data).schema["doc_id"].dataType)
    out = [r for b in own.run(iter(entries * 2)) for r in b.to_pylist()]
    assert sorted(r["group_size"] for r in out if r["kind"] == "total") == [8] * 5  # each text twice four times


def test_keep_rows(docs, odd):
    table = docs(odd).withColumnRenamed("lang", "__own_hash").withColumnRenamed("source", "__keep_id")
    kept = keep_rows(table, ex.exact_dedup(table).where("kept"))
    assert kept.columns == table.columns
    got = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept.collect()]
    assert sorted(got) == sorted({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in odd})


def test_empty_table(docs):
    assert ex.exact_dedup(docs([])).collect() == []


def test_text_ids(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x "), (None, "y")], "doc_id string, text string")
    assert sorted((r.doc_id or "", r.keep_id or "", r.group_size) for r in ex.exact_dedup(df).collect()) == [("", "", 1), ("a", "a", 2), ("b", "a", 2)]


def test_one_join_however_deep(docs):
    """The entries meet the directory once; the depth is decided on counts."""
    entries = ex._entries(docs([(i, f"{i} " * 50) for i in range(900)]))
    depths = {}
    for size in (200_000, 500):
        out = ex.with_buckets(entries, size)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join LeftOuter") == 1
        depths[size] = max(r.bucket.bit_length() for r in out.select("bucket").collect())
    assert depths[500] > depths[200_000] + 3


def test_prefixes_beyond_the_counted_ones(spark, monkeypatch):
    """Keys that share more bits than are counted at once, and a key alone that overfills a bucket."""
    monkeypatch.setattr(ex, "FINER", 2)
    keys = [1 << 20, (1 << 20) + 1, (1 << 20) + (1 << 12), -5] * 3 + [7] * 40
    entries = spark.createDataFrame([(k, 100) for k in keys], "key long, size long")
    rows = ex.with_buckets(entries, 900, ex.directory(entries, 900, 300)).collect()
    sizes = {}
    for r in rows:
        depth = r.bucket.bit_length() - 1
        assert r.bucket == 1 << depth | (r.key % (1 << 64)) >> (64 - depth)
        sizes.setdefault(r.bucket, []).append(r.key)
    assert all(100 * len(ks) <= 900 or len({*ks}) == 1 or b.bit_length() - 1 == ex.DEEPEST + 1 for b, ks in sizes.items())
    assert {r.groups for r in rows if r.key == 7} == {7} and {r.groups for r in rows if r.key != 7} == {None}
    assert ex.owners(0) == 1 and ex.owners(10 * ex.OWNER_BYTES + 1) == 11


def test_hot_text_over_many_tasks(docs, spark):
    """A long text that every task reads travels to its owner once for each group of tasks."""
    hot = "hot text " * 300
    data = [(i, hot + " " * (i == 41)) if i % 2 else (i, f"t {i}") for i in range(200)] + [(None, hot)]
    table = docs(data).repartition(40)
    entries = ex.stage(ex._entries(table), "entries")
    placed = ex.with_buckets(entries, 4000)
    thin = ex._thin(placed.where("groups IS NOT NULL")).collect()
    assert len(thin) > 30 and 1 <= sum(r.content is not None for r in thin) <= 7
    rows, got = result(ex.exact_dedup(table, bucket_bytes=4000))
    assert got == brute(data) and {r.keep_id for r in rows if r.group_size > 1} == {41}
    assert sum(r.kept for r in rows) == 101
