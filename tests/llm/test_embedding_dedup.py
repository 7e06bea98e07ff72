import math

import numpy as np
import pytest

from cardwatch.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int, node string, block int"


def brute(rows):
    n = len(rows)
    vec = [np.array(e, dtype=float) if label is not None and ed.usable(e) else None for _, e, label, *_ in rows]
    links = [[False] * n for _ in range(n)]
    for i in range(n):
        for j in range(n):
            if i != j and vec[i] is not None and vec[j] is not None and rows[i][2] == rows[j][2] and len(vec[i]) == len(vec[j]):
                links[i][j] = vec[i] @ vec[j] / (math.sqrt(vec[i] @ vec[i]) * math.sqrt(vec[j] @ vec[j])) >= 0.98
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            x = todo.pop()
            new = {j for j in range(n) if links[x][j]} - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], sum(links[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def result(spark, rows):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in ed.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def test_clusters(spark, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK", 1024)
    rng = np.random.default_rng(1)
    rows = []
    for c in range(30):
        centre = rng.normal(size=20)
        for _ in range(rng.integers(1, 12)):
            rows.append((len(rows), (centre + rng.normal(size=20) * 0.15).astype(np.float32).tolist(), int(c % 3), None, None))
    hot = rng.normal(size=20).astype(np.float32)
    rows += [(len(rows) + k, hot.tolist(), 1, None, None) for k in range(80)]  # copies
    rows += [(len(rows) + k, (hot * (k + 1)).tolist(), 1, None, None) for k in range(5)]  # and multiples
    assert result(spark, rows) == brute(rows)


def test_odd_rows(spark):
    x = [1.0, 2.0, 3.0]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 2.0], 1), (5, [1.0, float("nan"), 0.0], 1), (6, [1.0, float("inf"), 0.0], 1),
            (7, x, None), (8, x, 1), (8, x, 1), (9, x, 2), (10, [1.0, 2.0], 1), (11, [1e-38, 2e-38, 3e-38], 1), (12, [1e38, 2e38, 3e38], 1), (None, x, 2), (None, None, 2)]
    rows = [(*r, None, None) for r in rows]
    assert result(spark, rows) == brute(rows)
    assert ed.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("d", [3, 16, 40])
def test_bounds_lose_no_pair(d):
    rng = np.random.default_rng(d)
    centres = rng.normal(size=(20, d))
    a, b = (centres[rng.integers(0, 20, 150)] + rng.normal(size=(150, d)) * 0.12 for _ in range(2))
    turn = ed.axes(np.vstack([a, b]).tolist())
    i, j = ed.linked(a, b, turn, 0.98)
    cosine = ed.unit(a) @ ed.unit(b).T
    assert {*zip(i.tolist(), j.tolist(), strict=True)} == {*zip(*(x.tolist() for x in np.nonzero(cosine >= 0.98)), strict=True)}


def test_query(spark, sf_small):
    from cardwatch.llm.queries import op6_embedding_dedup

    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in op6_embedding_dedup(spark, sf_small).collect()), key=str)
    assert got == brute(rows)


def test_boxes_of_boxes_lose_no_pair(spark, monkeypatch):
    """Levels of boxes over many partitions and labels give the pairs that all boxes of a label compared give."""
    rng = np.random.default_rng(5)
    rows = []
    for part in range(9):
        for k in range(1, int(rng.integers(2, 60))):
            low = np.cumsum(rng.normal(size=3)) * 0.3 + part
            rows.append((1 if part < 7 else int(rng.integers(2, 4)), 3 + part % 2 * (part > 6), (part << 32) + k, low.tolist(), (low + rng.random(3) * 0.2).tolist()))
    boxes = spark.createDataFrame(rows, "label int, dim int, id long, low array<double>, high array<double>")
    expected = set()
    for la, da, a, low, high in rows:
        for lb, db, b, low_b, high_b in rows:
            gap = np.maximum(0, np.maximum(np.array(low) - high_b, np.array(low_b) - high))
            if (la, da) == (lb, db) and a <= b and (gap ** 2).sum() <= 0.04:
                expected.add((a, b))
    for top in (256, 16, 1):
        monkeypatch.setattr(ed, "TOP", top)
        got = [(r.id, r.id_b) for r in ed.near_boxes(boxes, 0.04).collect()]
        assert len(got) == len(expected) and {*got} == expected
    assert ed.near_boxes(boxes.limit(0), 0.04).collect() == []


def test_one_label_on_all_rows(spark, monkeypatch):
    """Small blocks, so that there are boxes of boxes."""
    monkeypatch.setattr(ed, "BLOCK", 4)
    monkeypatch.setattr(ed, "TOP", 3)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(60, 12))
    rows = [(k, (centres[k % 60] + rng.normal(size=12) * 0.1).astype(np.float32).tolist(), 7, None, None) for k in range(360)]
    assert result(spark, rows) == brute(rows)
