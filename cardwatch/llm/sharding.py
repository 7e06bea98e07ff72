"""Sharding by a hierarchical weighted hash tree, in SQL expressions only.

A row descends region, rack and shard. On each level every child draws -ln(u) / weight, with u from a hash of the
row's key and the child's path, and the least draw wins: children get rows in proportion to their weights, and when
a weight grows, rows move only into that subtree. Nothing but the key and the tree decides.

Within a shard, rows get gapless slots: they are dealt into buckets by a hash, counted, and numbered within their
bucket behind the buckets before it. A shard is never numbered in one task.

A null key is a key of its own (all such rows share a shard); a null text has no bytes and the checksum 0. Rows with
equal keys share a shard and have slots of their own. An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import need, stage

#: A tree: regions of racks of shards; each shard is (number, weight).
Tree = list[list[list[tuple[int, float]]]]
RACK, REGION = 2, 4
#: Rows that are numbered together, and the least number of buckets of a shard.
BUCKET_ROWS, LEAST_BUCKETS = 4096, 8


def tree(base: int, more: int = 0) -> Tree:
    """``base`` shards of weight 1, ``RACK`` to a rack and ``REGION`` racks to a region. Each further shard is a
    region of its own, so that rows move only into it."""
    racks = [[(s, 1.0) for s in range(a, min(a + RACK, base))] for a in range(0, base, RACK)]
    return [racks[a:a + REGION] for a in range(0, len(racks), REGION)] + [[[(base + k, 1.0)]] for k in range(more)]


def _weight(x) -> float:
    return x[1] if isinstance(x, tuple) else sum(map(_weight, x))


def shard_of(shape: Tree, key: str) -> str:
    """SQL expression of the shard of the column ``key``."""
    regions = ", ".join(
        f"named_struct('w', {_weight(r)}D, 'c', array(" + ", ".join(
            f"named_struct('w', {_weight(k)}D, 'c', array(" + ", ".join(f"named_struct('w', {float(w)}D, 's', {s})" for s, w in k) + "))" for k in r) + "))" for r in shape)
    whole = f"array({regions})"

    def pick(children: str, path: str) -> str:
        # the child's number is part of its path; ties of equal draws go to the first
        draw = f"-ln((shiftrightunsigned(xxhash64(CAST({key} AS STRING), {path}, i), 11) + 0.5D) * 1.1102230246251565E-16D) / x.w"
        return f"array_min(transform({children}, (x, i) -> named_struct('d', {draw}, 'i', i))).i"

    # each level's choice is bound by a lambda, so that it is computed once
    shard = f"element_at(transform(array({pick('c2', 'concat(r, chr(47), k)')}), z -> c2[z].s), 1)"
    rack = f"element_at(transform(array({pick('c1', 'CAST(r AS STRING)')}), k -> element_at(transform(array(c1[k].c), c2 -> {shard}), 1)), 1)"
    region = f"element_at(transform(array({pick('t', chr(39) + chr(39))}), r -> element_at(transform(array(t[r].c), c1 -> {rack}), 1)), 1)"
    return f"element_at(transform(array({whole}), t -> {region}), 1)"


def with_slots(rows: DataFrame, shards: int) -> DataFrame:
    """Replace ``lane`` (any number that tells rows apart) of stored rows by ``slot``: 0, 1, 2... in each shard."""
    need(rows, "shard", "lane")
    buckets = max(LEAST_BUCKETS, -(-rows.count() // (shards * BUCKET_ROWS)))
    dealt = rows.withColumn("bucket", F.expr(f"pmod(xxhash64(lane), {buckets})"))
    counts = dealt.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "bucket").orderBy("lane")
    numbered = dealt.withColumn("at", F.row_number().over(inside))
    return numbered.join(starts, ["shard", "bucket"]).withColumn("slot", F.expr("start + at - 1")).drop("bucket", "lane", "start", "at")


def shard(df: DataFrame, base: int = 24) -> DataFrame:
    """Rows (doc_id, size, text_crc32, law, shard, slot, grown_shard) of ``df`` (doc_id, text)."""
    need(df, "doc_id", "text")
    placed = df.selectExpr(
        "doc_id", "CAST(coalesce(octet_length(text), 0) + 8 AS BIGINT) AS size", "coalesce(crc32(text), 0L) AS text_crc32", "'key' AS law",
        f"{shard_of(tree(base), 'doc_id')} AS shard", f"{shard_of(tree(base, 1), 'doc_id')} AS grown_shard", "monotonically_increasing_id() AS lane")
    return with_slots(stage(placed, "placed"), base).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
