import json
import os

import pytest
from pyspark.sql import functions as F

from cardwatch.schemas import CARDS, TRANSACTIONS_RAW, USERS
from cardwatch.sources import files, ingest, snapshots


def test_format_dispatch_rejects_unknown(spark):
    with pytest.raises(ValueError):
        files.format_of("/x/data.xlsx")
    assert files.format_of("/x/users_data.csv") == "csv"


def test_json_permissive_drops_corrupt_and_accepts_clean(spark, scratch):
    p = os.path.join(scratch, "cards.json")
    os.makedirs(p)
    with open(os.path.join(p, "part-0.json"), "w") as f:
        f.write('{"id": 1, "client_id": 1, "card_brand": "Visa"}\n{not json\n{"id": 2, "card_brand": "Amex"}\n')
    got = files.read_json_lines(spark, p, CARDS).orderBy("id").collect()
    assert [r["id"] for r in got] == [1, 2]
    clean = os.path.join(scratch, "clean.json")
    os.makedirs(clean)
    with open(os.path.join(clean, "part-0.json"), "w") as f:
        f.write('{"id": 3}\n')
    assert files.read_json_lines(spark, clean, CARDS).count() == 1


def test_whole_file_json_object(spark, scratch):
    p = os.path.join(scratch, "labels")
    os.makedirs(p)
    with open(os.path.join(p, "train_fraud_labels.json"), "w") as f:
        json.dump({"target": {"1": "Yes", "2": "No", "3": "No"}}, f, indent=2)
    got = files.read_json_objects(spark, p, "transaction_id", "label", wrap="target", whole_file=True)
    assert sorted(tuple(r) for r in got.collect()) == [("1", "Yes"), ("2", "No"), ("3", "No")]


def test_json_object_writer_splits(spark, scratch):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v"))
    p = os.path.join(scratch, "objs")
    files.write_json_objects(df, "k", "v", p, entries_per_object=100)
    lines = spark.read.text(p).count()
    assert lines == 10
    assert files.read_json_objects(spark, p, "k", "v").count() == 1000


def test_csv_roundtrip(spark, scratch):
    df = spark.createDataFrame([(1, "Male", 700, 2, 40.0, 1.0, "$1,000", "$2", "$3")], USERS)
    p = os.path.join(scratch, "users.csv")
    files.write_csv(df, p)
    assert files.read_any(spark, p, USERS).first()["per_capita_income"] == "$1,000"


def test_snapshot_rewrite_is_idempotent(spark, scratch):
    p = os.path.join(scratch, "bronze")
    df = spark.createDataFrame([(1, "2025-01-01"), (2, "2025-01-02")], "id bigint, d string").select(
        "id", F.to_date("d").alias("date_insertion"))
    snapshots.write_snapshots(df, p)
    snapshots.write_snapshots(df.where("id = 2"), p)  # rerun of one date replaces only that date
    from pyspark.sql import types as T

    schema = T.StructType(CARDS.fields + [T.StructField("date_insertion", T.DateType())])
    assert snapshots.read_snapshots(spark, p, schema).count() == 2
    committed = snapshots.committed_dates(spark, p)
    wanted = spark.createDataFrame([("2025-01-02",), ("2025-01-03",)], "snapshot_date string")
    assert [r[0] for r in snapshots.dates_to_load(wanted, committed).collect()] == ["2025-01-03"]
    missing = snapshots.committed_dates(spark, os.path.join(scratch, "none"))
    assert missing.count() == 0


def test_ingest_and_first_wins(spark):
    raw = spark.createDataFrame([
        ("12", None, "1", "1", "$10.00", "Yes", "5", "nan", "S", "58523.0", "1", "nan"),
        ("x", None, "1", "1", "$10.00", "Yes", "5", "C", "S", "1", "1", None),
        (None, None, "1", "1", "$10.00", "Yes", "5", "C", "S", "1", "1", None),
    ], TRANSACTIONS_RAW)
    import datetime as dt

    typed = ingest.ingest_transactions(raw, dt.date(2025, 1, 1)).collect()
    assert [(r["id"], r["amount"], r["merchant_city"], r["zip"], r["errors"]) for r in typed] == [(12, 10.0, None, "58523", None)]
    dup = spark.createDataFrame([(1, "b", "2025-01-02"), (1, "a", "2025-01-01"), (2, "c", "2025-01-02")],
                                "id bigint, v string, d string").withColumn("date_insertion", F.to_date("d"))
    first = {r["id"]: r["v"] for r in ingest.dedupe_first_wins(dup).collect()}
    assert first == {1: "a", 2: "c"}
    existing = spark.createDataFrame([(2,)], "id bigint")
    assert [r["id"] for r in ingest.append_new(existing, dup).collect()] == [1]


def test_load_missing_writes_only_new_dates(spark, scratch):
    p = os.path.join(scratch, "bronze")
    src = spark.createDataFrame([(1, "2025-01-01"), (2, "2025-01-02"), (3, "2025-01-02")],
                                "id bigint, d string").select("id", F.to_date("d").alias("date_insertion"))
    assert snapshots.load_missing(spark, src.where("id = 1"), p) == ["2025-01-01"]
    assert snapshots.load_missing(spark, src, p) == ["2025-01-02"]
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("date_insertion", T.DateType())])
    got = sorted(r["id"] for r in snapshots.read_snapshots(spark, p, schema).collect())
    assert got == [1, 2, 3]
    assert snapshots.load_missing(spark, src, p) == []  # a rerun loads nothing and duplicates nothing
    assert sorted(r["id"] for r in snapshots.read_snapshots(spark, p, schema).collect()) == [1, 2, 3]


def test_odd_ids_and_file_order(spark, scratch):
    """Ids beyond 2^53 stay apart, what is no bigint goes without failing the job, and the first line of an id wins."""
    import datetime as dt

    ids = ["9007199254740993", "9007199254740992", "NaN", "1e300", "7.9", "7", "-3", "99999999999999999999", "", "9007199254740993"]
    with open(os.path.join(scratch, "t.csv"), "w") as f:
        f.write(",".join(c.name for c in TRANSACTIONS_RAW) + "\n")
        for n, i in enumerate(ids):
            f.write(f"{i},,z{9 - n},1,$1.00,Yes,1,C,S,1,1,\n")
    raw = files.read_csv(spark, os.path.join(scratch, "t.csv"), TRANSACTIONS_RAW)
    rows = ingest.ingest_transactions(raw, dt.date(2025, 1, 1)).collect()
    # the line with the alphabetically larger client came first
    assert sorted((r.id, r.client_id) for r in rows) == [(-3, "z3"), (7, "z5"), (9007199254740992, "z8"), (9007199254740993, "z9")]


def test_damaged_object_is_not_lost_silently(spark, scratch):
    p = os.path.join(scratch, "objects")
    os.makedirs(p)
    with open(os.path.join(p, "part-0"), "w") as f:
        f.write('{"target": {"1": "Yes", "2": "No"}}\n{"target": {"3": "Yes", "4": \n\n')
    with pytest.raises(Exception, match="malformed JSON object"):
        files.read_json_objects(spark, p, "id", "label", wrap="target").collect()
    assert files.read_json_objects(spark, p, "id", "label", wrap="target", on_malformed="drop").count() == 2
    assert tuple(files.malformed_objects(spark, p, wrap="target").first()) == (2, 1)


def test_only_a_missing_path_means_nothing_there(spark, scratch):
    from pyspark.errors import AnalysisException

    from cardwatch.plans import store

    assert store.read_metrics(spark, os.path.join(scratch, "none"), "r").collect() == []
    with pytest.raises(Exception):  # a file that is no Parquet is an error, not an empty table
        os.makedirs(os.path.join(scratch, "m", "run_id=r"))
        with open(os.path.join(scratch, "m", "run_id=r", "part-0.parquet"), "w") as f:
            f.write("damaged")
        store.read_metrics(spark, os.path.join(scratch, "m"), "r").collect()
    assert not files.path_is_missing(AnalysisException("other"))


def test_share_of_all_lines(spark):
    df = spark.range(50).select("id")
    assert sorted(r.id for r in snapshots.first_share_by_id(df, 0.3, of_rows=100).collect()) == list(range(30))


def test_ignored_files(spark, scratch):
    """Unreadable files stop a read unless that is asked for."""
    p = os.path.join(scratch, "t.parquet")
    spark.range(5).coalesce(1).write.parquet(p)
    with open(os.path.join(p, "part-9.parquet"), "w") as f:
        f.write("damaged")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.LongType())])
    with pytest.raises(Exception):
        files.read_any(spark, p, schema).collect()
    assert files.read_any(spark, p, schema, ignore_corrupt=True).count() == 5


DATED = "id bigint, v string, d string"


def dated(spark, rows):
    return spark.createDataFrame(rows, DATED).select("id", "v", F.to_date("d").alias("date_insertion"))


def dated_schema():
    from pyspark.sql import types as T

    return T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("date_insertion", T.DateType())])


def test_half_written_date_is_loaded_again(spark, scratch):
    """Files that no manifest names don't make a date loaded, and are never read."""
    p = os.path.join(scratch, "bronze")
    src = dated(spark, [(1, "a", "2025-01-01"), (2, "b", "2025-01-02"), (3, "c", "2025-01-02")])
    snapshots.load_missing(spark, src.where("id = 1"), p)
    snapshots._write_run(src.where("id = 2"), p, "date_insertion", None, ["2025-01-02"])  # died before it published
    os.makedirs(p + "/_published/2025-01-02")
    with open(p + "/_published/2025-01-02/_0-draft.json", "w") as f:
        f.write('{"snapshot_date": "2025-')  # or while it wrote the manifest
    assert snapshots.listed_dates(spark, p) == ["2025-01-01"]
    assert [r.id for r in snapshots.read_snapshots(spark, p, dated_schema()).collect()] == [1]
    assert [r.id for r in snapshots.read_latest(spark, p, dated_schema()).collect()] == [1]
    assert snapshots.load_missing(spark, src, p) == ["2025-01-02"]
    assert sorted(r.id for r in snapshots.read_snapshots(spark, p, dated_schema()).collect()) == [1, 2, 3]
    assert snapshots.load_missing(spark, src, p) == []


def test_replaced_date_shows_one_run(spark, scratch):
    p = os.path.join(scratch, "bronze")
    snapshots.write_snapshots(dated(spark, [(1, "old", "2025-01-01"), (2, "old", "2025-01-01")]), p)
    before = snapshots.read_snapshots(spark, p, dated_schema())
    snapshots.write_snapshots(dated(spark, [(1, "new", "2025-01-01")]), p)
    assert [r.v for r in snapshots.read_snapshots(spark, p, dated_schema()).collect()] == ["new"]
    assert [r.v for r in before.collect()] == ["old", "old"]  # a reader that began earlier keeps what it saw


def test_manifest_tells_damage(spark, scratch):
    p = os.path.join(scratch, "bronze")
    rows = [(k, "x" * (k % 5), f"2025-01-0{1 + k % 3}") for k in range(60)] + [(None, None, "2025-01-01")] * 2
    snapshots.write_snapshots(dated(spark, rows), p)
    found = snapshots.published(spark, p)
    assert {d: m["rows"] for d, m in found.items()} == {"2025-01-01": 22, "2025-01-02": 20, "2025-01-03": 20}
    assert snapshots.damaged_snapshots(spark, p, dated_schema()).collect() == []
    m = dict(found["2025-01-02"], rows=21)
    snapshots.publish(spark, p, m)
    assert [r.snapshot_date for r in snapshots.damaged_snapshots(spark, p, dated_schema()).collect()] == ["2025-01-02"]
    folder = f"{p}/snapshot_date=2025-01-03/run={found['2025-01-03']['run']}"
    spark.range(1).selectExpr("id", "'y' AS v").coalesce(1).write.mode("append").parquet(folder)  # a file that was not written with it
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshots(spark, p, dated_schema())


def test_many_dates_in_few_jobs(spark, scratch, monkeypatch):
    monkeypatch.setattr(snapshots, "DATES_A_JOB", 2)
    p = os.path.join(scratch, "bronze")
    src = dated(spark, [(k, "v", f"2025-01-0{1 + k % 5}") for k in range(50)])
    assert len(snapshots.load_missing(spark, src, p)) == 5
    assert snapshots.read_snapshots(spark, p, dated_schema()).exceptAll(src).count() == 0
    assert {m["rows"] for m in snapshots.published(spark, p).values()} == {10}


def test_first_row_in_file_order(spark, scratch, monkeypatch):
    """Of two files with one id the first by name wins, though the other one is larger and read first; in a file, the first line."""
    import datetime as dt

    p = os.path.join(scratch, "raw")
    os.makedirs(p)
    head = ",".join(c.name for c in TRANSACTIONS_RAW) + "\n"

    def line(i, client):
        return f"{i},,{client},1,$1.00,Yes,1,C,S,1,1,\n"

    with open(p + "/a.csv", "w") as f:
        f.write(head + line(5, "z") + line(5, "b") + line(6, "y"))
    with open(p + "/b.csv", "w") as f:
        f.write(head + line(6, "a") + line(5, "a") + "".join(line(100 + k % 500, f"{9 - k // 500}") for k in range(3000)))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for size in (before, "2000"):  # one task, and many splits
            spark.conf.set(key, size)
            raw = files.read_csv(spark, p, TRANSACTIONS_RAW)
            got = {r.id: r.client_id for r in ingest.ingest_transactions(raw, dt.date(2025, 1, 1)).collect()}
            assert (got.pop(5), got.pop(6)) == ("z", "y") and got == {100 + k: "9" for k in range(500)}
    finally:
        spark.conf.set(key, before)


def test_line_numbers_over_splits(spark, scratch):
    from cardwatch.sources.positions import numbered, with_place, written

    p = os.path.join(scratch, "t")
    os.makedirs(p)
    for name, n in (("a", 700), ("b", 3), ("c", 5000)):
        with open(f"{p}/{name}.txt", "w") as f:
            f.writelines(f"{name} {k} {'x' * (k % 7)}\n" for k in range(1, n + 1))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "500")
    try:
        rows = numbered(written(with_place(spark.read.text(p)), scratch + "/w")).collect()
    finally:
        spark.conf.set(key, before)
    assert len(rows) == 5703
    assert all(r.value.split()[:2] == [os.path.basename(r.file)[0], str(r.line)] for r in rows)


def objects(spark, scratch, texts, wrap=None, **opts):
    import uuid

    from cardwatch.sources.json_object import read_object

    p = os.path.join(scratch, uuid.uuid4().hex)
    os.makedirs(p)
    for k, t in enumerate(texts):
        with open(f"{p}/f{k}.json", "w") as f:
            f.write(t)
    return sorted(map(tuple, read_object(spark, p, "k", "v", p + ".scratch", wrap=wrap, split_bytes=200, **opts).collect()))


@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False, "indent": 1}])
def test_one_object_in_many_tasks(spark, scratch, style):
    """Separators, quotes, escapes and braces inside keys and values; entries cut at every split."""
    import random

    rng = random.Random(3)
    some = lambda: "".join(rng.choice('ab,,"\\{}:, \né日') for _ in range(rng.randrange(12)))
    made = [{f"{some()}{k}": some() for k in range(80)} for _ in range(3)]
    expected = sorted((k, v) for o in made for k, v in o.items())
    assert objects(spark, scratch, [json.dumps(o, **style) for o in made]) == expected
    assert objects(spark, scratch, [json.dumps({"target": o}, **style) + "\n" for o in made], wrap="target") == expected


def test_object_scalars_and_empty_objects(spark, scratch):
    made = ["{}", '{"a,b": 1, "c": null}', ' { "d" : true ,\n"e":"x,\\"y" } ', '{"f": ","}', "{ }"]
    assert objects(spark, scratch, made) == [("a,b", "1"), ("c", None), ("d", "true"), ("e", 'x,"y'), ("f", ",")]
    assert objects(spark, scratch, ['{"target": {}}'], wrap="target") == []


@pytest.mark.parametrize("bad", ['{"a":"b"', '{"a":"b","c" "d"}', '{"a":"b","c":"d', '{"a":{"b":"c"}}', '"a":"b"}', '{"a":[1,2]}', '{"a":"b"}}', '{"a":"b",}'])
def test_damaged_object_raises(spark, scratch, bad):
    with pytest.raises(Exception, match="malformed entry|string is open"):
        objects(spark, scratch, [bad])


def test_damaged_entries_can_be_dropped(spark, scratch):
    assert objects(spark, scratch, ['{"a":"b","c" "d","e":"f"}'], on_malformed="drop") == [("a", "b"), ("e", "f")]


def test_object_broadcasts_no_pieces(spark, scratch, monkeypatch):
    """Strings with separators: pieces are counted by blocks of lines, and only the blocks' counts are joined with them."""
    from cardwatch.sources import json_object

    monkeypatch.setattr(json_object, "BLOCK", 50)
    made = [{f"{n},{k}": f"a, {{{k}}}, " for k in range(300)} for n in range(3)]
    folder = os.path.join(scratch, "in")
    os.makedirs(folder)
    for k, o in enumerate(made):
        with open(f"{folder}/f{k}.json", "w") as f:
            json.dump(o, f)
    got = json_object.read_object(spark, folder, "k", "v", scratch + "/s", split_bytes=500)
    assert sorted(map(tuple, got.collect())) == sorted((k, v) for o in made for k, v in o.items())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    pieces = spark.read.parquet(scratch + "/s/pieces").count()
    assert pieces >= 3 * 900 and spark.read.parquet(scratch + "/s/blocks").count() <= pieces // 50 + 2 * len(made)


def test_quarantine_holds_what_good_rows_lack(spark, scratch):
    lines = ['{"id": 1, "card_brand": "Visa"}', "{not json", "", '{"id": "x", "num_cards_issued": [1]}', "[1]", "7", '{"id": 2}', "null", '{"id": 3, "extra": {"a": 1}}', '"text"', "{}"]
    p = os.path.join(scratch, "in")
    os.makedirs(p)
    with open(p + "/a.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    good, bad = files.split_json_lines(spark, p, CARDS, scratch + "/q")
    assert good.columns == [f.name for f in CARDS.fields]
    rows = sorted(map(tuple, bad.select("line", "reason", "record").collect()))
    assert rows == [(2, "not JSON", "{not json"), (4, "does not fit: id, num_cards_issued", lines[3]), (5, "not an object", "[1]"), (6, "not an object", "7"),
                    (8, "not an object", "null"), (10, "not an object", '"text"')]
    kept = sorted((r.id is None, r.id) for r in good.collect())
    assert good.count() + bad.count() == sum(x != "" for x in lines) and kept[:3] == [(False, 1), (False, 2), (False, 3)]


def test_asked_files_are_written_without_a_sort(spark, scratch, monkeypatch):
    """With few tasks for all rows, each keeps a file for each date open; the session's setting stays as it was."""
    from pyspark.sql import DataFrameWriter

    before, seen = spark.conf.get(snapshots.OPEN_FILES), []
    plain = DataFrameWriter.parquet

    def recorded(self, *args, **kw):
        seen.append(int(spark.conf.get(snapshots.OPEN_FILES)))
        return plain(self, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    df = spark.range(400).selectExpr("id DIV 2 AS id", "date_add(DATE '2025-01-01', CAST(id % 4 AS INT)) AS date_insertion")
    snapshots.write_snapshots(df, scratch + "/b", num_files=3)
    assert seen == [4] and spark.conf.get(snapshots.OPEN_FILES) == before
    assert {d: (m["rows"], len(m["files"])) for d, m in snapshots.published(spark, scratch + "/b").items()} == {f"2025-01-0{k}": (100, 3) for k in range(1, 5)}
    back = snapshots.read_snapshots(spark, scratch + "/b", df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
