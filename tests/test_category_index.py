import collections
import random

from cardwatch.operators import features
from cardwatch.operators.category_index import category_index, with_index

COLUMNS = ["a", "b", "c"]


def test_against_the_indexer(spark):
    rng = random.Random(1)
    data = [(k, rng.choice("xyz"), str(rng.randrange(300)), str(k)) for k in range(900)]
    df = spark.createDataFrame(data, "id long, a string, b string, c string").repartition(5)
    for part in (10_000, 70):  # in one part, and in many
        mine = with_index(df, category_index(df, COLUMNS, rows_per_part=part), COLUMNS)
        library = features.category_indexer(COLUMNS).fit(df).transform(df)
        assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, library.select(mine.columns).collect()))


def test_nulls_and_unseen_values(spark):
    seen = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "a string")
    index = category_index(seen, ["a"])
    got = {r.a: r.a_idx for r in with_index(spark.createDataFrame([("x",), ("y",), ("new",), (None,)], "a string"), index, ["a"]).collect()}
    assert got == {"x": 0.0, "y": 1.0, "new": 2.0, None: 2.0}
    empty = category_index(seen.limit(0), ["a"])
    assert empty.count() == 0 and with_index(seen, empty, ["a"]).select("a_idx").distinct().collect() == [(0.0,)]


def test_ties_are_alphabetical(spark):
    rng = random.Random(2)
    values = [f"v{rng.randrange(10 ** 6)}" for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "a string")
    got = {r.value: r.idx for r in category_index(df, ["a"], rows_per_part=30).collect()}
    counts = collections.Counter(values)
    assert got == {v: float(k) for k, v in enumerate(sorted(counts, key=lambda v: (-counts[v], v)))}


def test_small_parts_are_bounded_in_number(spark, monkeypatch):
    """Each range partition sends samples to the driver: there aren't as many of them as values."""
    from cardwatch.operators.prefix import MOST_PARTS, ROWS_PER_PART, part_count, running_totals

    assert [part_count(n, 500) for n in (0, 1, 501, 10 ** 8)] == [1, 1, 2, MOST_PARTS]
    assert part_count(10 ** 9, 500) == part_count(10 ** 9, ROWS_PER_PART) == 1000
    df = spark.createDataFrame([(f"v{k}", k % 3 + 1) for k in range(MOST_PARTS + 50)], "a string, n long").selectExpr("a", "explode(sequence(1L, n))").select("a")
    parts, plain = [], type(df).repartitionByRange

    def recorded(self, n, *cols):
        parts.append(n)
        return plain(self, n, *cols)

    monkeypatch.setattr(type(df), "repartitionByRange", recorded)
    got = {r.value: r.idx for r in category_index(df, ["a"], rows_per_part=1).collect()}
    counts = collections.Counter(r.a for r in df.collect())
    assert got == {v: float(k) for k, v in enumerate(sorted(counts, key=lambda v: (-counts[v], v)))}
    sums = running_totals(spark.range(MOST_PARTS + 50), "id", ["id"], descending=False, rows_per_part=1)
    assert [r.cum_id for r in sums.orderBy("id").collect()] == [k * (k + 1) // 2 for k in range(MOST_PARTS + 50)]
    assert parts == [MOST_PARTS, MOST_PARTS]
