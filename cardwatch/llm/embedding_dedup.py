"""Embedding near-duplicates by a PCA-ordered tiled comparison.

Vectors of one label are compared with each other. A rotation to principal axes (fitted on a sample of at most
``SAMPLE`` vectors; any rotation is exact, a good one is fast) puts the dimensions that tell vectors apart first.
Rows are ordered by label and by the interleaved bits of the leading coordinates and cut into blocks. Two blocks
form a tile unless their bounding boxes on the leading axes are too far apart. Boxes are put into boxes of neighbours until
a label has few; pairs of these that are near enough are opened level by level, so the work follows the near pairs, and a
label on all rows is dealt by pairs of boxes. In a tile, dimensions are added up
a slice at a time; a pair is dropped when its sum so far plus the product of the two suffix norms can't reach the
threshold. What is left is decided on the unrotated vectors in double precision.

Equal vectors count once, with their number as weight. A tile returns its vectors' link counts and, for the
components, one edge per linked vector to its group's root in the tile, so its output grows with its rows, not
with its links. No caps anywhere.

A vector that is null, empty or zero, or has null or non-finite components, and a row with a null label has no
links and is its own component. Vectors of different lengths don't link. Rows that repeat are copies. An empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import need, shuffle_width, small_batches, stage
from cardwatch.llm.graph import components

THRESHOLD = 0.98
#: Vectors on which the rotation is fitted.
SAMPLE = 4096
BLOCK = 1024
#: Leading coordinates in boxes and in the order of rows; dimensions that are added up at a time.
LEAD, SLICE = 8, 16
#: Bits of a box's number that it shares with its neighbours in a box of boxes; boxes of a label that are compared with all.
FAN, TOP = 4, 256
#: Room for rounding in bounds; pairs this near the threshold go to the exact check.
ROUNDING = 1e-9


def usable(x: list | None) -> bool:
    return bool(x) and all(v is not None and math.isfinite(v) for v in x) and any(v != 0 for v in x)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, scaled first so that huge or tiny components neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def axes(sample: list[list[float]]) -> dict[int, np.ndarray]:
    """For each length of vector, its principal axes as columns, the strongest first."""
    out = {}
    for d, rows in groupby(sorted(sample, key=len), key=len):
        x = unit(np.array(list(rows), dtype=np.float64))
        x = x - x.mean(axis=0)
        out[d] = np.linalg.eigh(x.T @ x)[1][:, ::-1].copy()
    return out


def rotated(x: np.ndarray, turn: dict[int, np.ndarray]) -> np.ndarray:
    return unit(x) @ turn[x.shape[1]] if x.shape[1] in turn else unit(x)


def interleaved(x: np.ndarray, bits: int = 7) -> np.ndarray:
    """Order key: the bits of the leading coordinates (-1 to 1) in turn."""
    x = x[:, :LEAD]
    cell = np.clip((x + 1) / 2 * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
    key = np.zeros(len(x), dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for k in range(x.shape[1]):
            key = key << 1 | (cell[:, k] >> b & 1)
    return key


def _keyed(df: DataFrame) -> DataFrame:
    """Every row with a number; usable vectors as doubles in ``vec``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = TaskContext.get().partitionId() << 40
        for batch in batches:
            labels = batch.column("label").to_pylist()
            vec = [np.array(x, dtype="<f8").tobytes() if label is not None and usable(x) else None
                   for x, label in zip(batch.column("embedding").to_pylist(), labels, strict=True)]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(np.arange(node, node + n)), pa.array(vec, pa.binary())],
                                             names=["vec_id", "label", "node", "vec"])
            node += n

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.select("vec_id", "label", "embedding").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, node long, vec binary")


def _ordered(reps: DataFrame, turn) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column("vec").to_pylist()
            key = np.zeros(len(vecs), dtype=np.int64)
            for size in {len(v) for v in vecs}:
                at = [i for i, v in enumerate(vecs) if len(v) == size]
                key[at] = interleaved(rotated(np.frombuffer(b"".join(vecs[i] for i in at), "<f8").reshape(len(at), -1), turn.value))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=[*batch.schema.names, "place"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in reps.schema)
    return reps.mapInArrow(run, f"{kinds}, place long")


def _blocks(rows: DataFrame, turn) -> DataFrame:
    """Cut rows that come in order into blocks of one label and length."""
    label = rows.schema["label"].dataType.simpleString()
    names = ["block", "label", "dim", "nodes", "weights", "vecs", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, of = TaskContext.get().partitionId() << 32, [], None

        def made(label_type: pa.DataType) -> pa.RecordBatch:
            nonlocal number
            number += 1
            x = np.frombuffer(b"".join(v for _, _, v in held), "<f8").reshape(len(held), -1)
            lead = rotated(x, turn.value)[:, :LEAD]
            row = [number, of[0], x.shape[1], [n for n, _, _ in held], [w for _, w, _ in held], x.tobytes(), lead.min(axis=0).tolist(), lead.max(axis=0).tolist()]
            types = [pa.int64(), label_type, pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)

        kind = None
        for batch in batches:
            kind = batch.column("label").type
            for lab, node, weight, vec in zip(*(batch.column(c).to_pylist() for c in ("label", "node", "weight", "vec")), strict=True):
                if held and (of != (lab, len(vec)) or len(held) == BLOCK):
                    yield made(kind)
                    held = []
                of = (lab, len(vec))
                held.append((node, weight, vec))
        if held:
            yield made(kind)

    return rows.mapInArrow(run, f"block long, label {label}, dim int, nodes array<long>, weights array<long>, vecs binary, low array<double>, high array<double>")


def linked(a: np.ndarray, b: np.ndarray, turn: dict[int, np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs whose cosine reaches the threshold."""
    p, q = rotated(a, turn), rotated(b, turn)
    tail = [np.sqrt(np.maximum(0, np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1])) for x in (p, q)]
    need_ = threshold - ROUNDING
    d = p.shape[1]
    part = p[:, :SLICE] @ q[:, :SLICE].T
    if d > SLICE:
        i, j = np.nonzero(part + np.outer(tail[0][:, SLICE], tail[1][:, SLICE]) >= need_)
    else:
        i, j = np.nonzero(part >= need_)
    total = part[i, j]
    for k in range(SLICE, d, SLICE):
        end = min(d, k + SLICE)
        total = total + np.einsum("ij,ij->i", p[i, k:end], q[j, k:end])
        rest = tail[0][i, end] * tail[1][j, end] if end < d else 0.0
        stays = total + rest >= need_
        i, j, total = i[stays], j[stays], total[stays]
    near = total < threshold + ROUNDING
    if near.any():  # the exact rule: dot product over the product of the norms
        x, y = a[i[near]], b[j[near]]
        ok = np.ones(len(i), dtype=bool)
        ok[near] = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))) >= threshold
        i, j = i[ok], j[ok]
    return i, j


def _compare(tiles: DataFrame, turn, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in range(batch.num_rows):
                dim, nodes_a, nodes_b, weight_a, weight_b, vecs_a, vecs_b, same = (
                    batch.column(c)[t].as_py() for c in ("dim", "nodes_a", "nodes_b", "weights_a", "weights_b", "vecs_a", "vecs_b", "same"))
                nodes = np.array(nodes_a if same else nodes_a + nodes_b)
                weight = np.array(weight_a if same else weight_a + weight_b)
                a, b = (np.frombuffer(v, "<f8").reshape(-1, dim) for v in (vecs_a, vecs_b))
                i, j = linked(a, b, turn.value, threshold)
                if same:
                    i, j = i[i < j], j[i < j]
                else:
                    j = j + len(nodes_a)
                n = np.bincount(i, weight[j], len(nodes)) + np.bincount(j, weight[i], len(nodes))
                root = np.arange(len(nodes))
                while True:  # smallest member of each group of linked rows
                    low = np.minimum(root[i], root[j])
                    now = root.copy()
                    np.minimum.at(now, i, low)
                    np.minimum.at(now, j, low)
                    now = now[now]
                    if (now == root).all():
                        break
                    root = now
                has = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[has]), pa.array(n[has].astype(np.int64)), pa.array(nodes[root[has]])], names=["node", "n", "root"])

    return tiles.mapInArrow(run, "node long, n long, root long")


def _above(boxes: DataFrame, within: bool) -> DataFrame:
    """Boxes with ``up``, the number of their box of boxes: of one partition, or (one box is left of each) of several."""
    part = f"shiftleft(shiftright(id, 32), 32) | shiftright(id & 4294967295, {FAN})" if within else f"shiftleft(shiftright(id, {32 + FAN}), 32)"
    return boxes.withColumn("up", F.expr(part))


def near_boxes(boxes: DataFrame, limit: float) -> DataFrame:
    """Pairs (id <= id_b) of the boxes (label, dim, id, low, high) of one label and dim whose squared distance is at most ``limit``."""
    near = f"aggregate(arrays_zip(low, high, low_b, high_b), 0D, (s, z) -> s + pow(greatest(0D, z.low - z.high_b, z.low_b - z.high), 2)) <= {limit!r}"
    levels = []
    while True:
        most = boxes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"), F.max(F.expr("id & 4294967295")).alias("i")).agg(F.max("n"), F.max("i")).first()
        if (most[0] or 0) <= TOP:
            break
        levels.append(stage(_above(boxes, most[1] > 0), "boxes"))
        edge = lambda f, c: f"transform({c}[0], (x, k) -> {f}(transform({c}, y -> y[k])))"
        # at most 2^FAN boxes in each
        boxes = stage(levels[-1].groupBy("label", "dim", "up").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs")).selectExpr(
            "label", "dim", "up AS id", f"{edge('array_min', 'lows')} AS low", f"{edge('array_max', 'highs')} AS high"), "boxes")
    other = boxes.selectExpr("label", "dim", "id AS id_b", "low AS low_b", "high AS high_b")
    pairs = boxes.join(other, ["label", "dim"]).where(f"id <= id_b AND {near}").select("label", "dim", "id", "id_b")
    for level in reversed(levels):
        kids = level.selectExpr("label", "dim", "up", "id", "low", "high")
        again = level.selectExpr("label", "dim", "up AS up_b", "id AS id_b", "low AS low_b", "high AS high_b")
        open_ = stage(pairs.withColumnsRenamed({"id": "up", "id_b": "up_b"}), "pairs")
        pairs = open_.join(kids, ["label", "dim", "up"]).join(again, ["label", "dim", "up_b"]).where(f"id <= id_b AND {near}").select("label", "dim", "id", "id_b")
    return pairs.select("id", "id_b")


def near_vectors(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``df`` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    need(df, "vec_id", "embedding", "label")
    spark = df.sparkSession
    small_batches(spark)
    rows = stage(_keyed(df), "vectors").withColumn("copy", F.expr("CASE WHEN vec IS NOT NULL THEN md5(vec) END"))
    valid = rows.where("vec IS NOT NULL")
    reps = valid.groupBy("label", "copy").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("weight"))
    sample = valid.orderBy(F.xxhash64("node")).limit(SAMPLE).select("vec").collect()  # bounded by SAMPLE
    turn = spark.sparkContext.broadcast(axes([np.frombuffer(r.vec, "<f8").tolist() for r in sample]))
    full = reps.join(valid.select("node", "vec"), "node").select("label", "node", "weight", "vec")
    placed = _ordered(full, turn).repartitionByRange(shuffle_width(spark), "label", F.length("vec"), "place").sortWithinPartitions("label", F.length("vec"), "place")
    blocks = stage(_blocks(placed, turn), "blocks")
    boxes = blocks.selectExpr("label", "dim", "block AS id", "low", "high")
    pairs = near_boxes(boxes, 2 - 2 * threshold + ROUNDING).selectExpr("id AS block", "id_b AS block_b")
    side = lambda s: blocks.selectExpr(f"block AS block{s}", "dim", f"nodes AS nodes{s or '_a'}", f"weights AS weights{s or '_a'}", f"vecs AS vecs{s or '_a'}")
    # dealt out anew: one block may be in very many tiles
    pairs = stage(pairs, "tiles")
    tiles = pairs.join(side(""), "block").join(side("_b").drop("dim"), "block_b").withColumn("same", F.expr("block = block_b"))
    found = stage(_compare(tiles, turn, threshold), "links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    parts = components(found.selectExpr("node AS a", "root AS b"))
    named = (valid.select("vec_id", "node", "label", "copy").join(reps.withColumnRenamed("node", "rep"), ["label", "copy"])
             .select("vec_id", "rep", F.col("node").alias("own"), "weight")
             .join(counts.withColumnRenamed("node", "rep"), "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
             .selectExpr("vec_id", "coalesce(n, 0L) + weight - 1 AS n_links", "coalesce(component, rep) AS part"))
    named = stage(named, "named")
    low = named.groupBy("part").agg(F.min("vec_id").alias("component_id"))
    alone = rows.where("vec IS NULL").selectExpr("vec_id", "0L AS n_links", "vec_id AS component_id")
    return named.join(low, "part").select("vec_id", "n_links", "component_id").unionByName(alone).withColumn("kept", F.expr("vec_id <=> component_id"))
