"""Exact deduplication by an extendible-hash index on shared files.

1. Each task collapses the equal texts it reads to one entry (key, text, members), written to shared files.
2. A directory over key prefixes starts at the depth that the total size asks for; as long as a bucket is
   overfull and has more than one key, it is split by the next bit of the key (directory doubling). Splits are
   decided on counts of key prefixes; the entries meet the finished directory in one join, however deep it is.
3. A key whose entries overfill a bucket by themselves (a text that very many tasks read) can't be split. Its
   entries are first dealt in about sqrt(n) groups; each group keeps a text once, the other entries refer to it.
4. Owner tasks read the entries of their buckets, each a range of keys, in key order. Entries with one key
   form a chain, and bytes are compared with each text in the chain, so equal keys of unequal texts do no
   harm. An owner holds one key's distinct texts at a time; there are as many owners as the bytes ask for.
5. Classes with one entry are complete; entries of the others meet their class totals in a join.

A text with very many copies costs one entry per reading task, whose members stay packed in an array.

Texts are equal if identical after deleting the characters [\\x20\\x09-\\x0D]; null counts as empty, so null,
empty and blank texts are one group. The row with the most code points stays, then the smallest id (null
last), then the first read: exactly one row of each group, also if rows repeat. An empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cardwatch.llm.common import kept, need, small_batches, stage, text_hash

BLANKS = bytes([0x20, *range(0x09, 0x0E)])
#: Bytes of distinct text in a bucket before it is split.
BUCKET_BYTES = 1 << 20
#: Bytes of entries that an owner task gets.
OWNER_BYTES = 32 << 20
#: Bits of a key by which prefixes are counted beyond the directory's depth, and the deepest prefix.
FINER, DEEPEST = 8, 60
#: Bytes of distinct text that a reading task collapses at a time.
TASK_BYTES = 64 << 20


def _entries(df: DataFrame) -> DataFrame:
    id_type = df.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("key", T.LongType()), T.StructField("content", T.BinaryType()), T.StructField("size", T.LongType()),
        T.StructField("text_sha256", T.StringType()), T.StructField("chars", T.LongType()), T.StructField("keep_id", id_type),
        T.StructField("keep_pos", T.LongType()), T.StructField("keep_hash", T.LongType()),
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("places", T.ArrayType(T.LongType())),
        T.StructField("same_as", T.LongType()),  # the entry that has the text: itself
    ])
    arrow_id = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("exact_dedup")
        found: dict[bytes, list] = {}
        held, pos = 0, TaskContext.get().partitionId() << 40

        def flush() -> Iterator[pa.RecordBatch]:
            rows = list(found.items())
            for at in range(0, len(rows), 2000):
                part = rows[at:at + 2000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([int.from_bytes(hashlib.blake2b(c, digest_size=8).digest(), "big", signed=True) for c, _ in part], pa.int64()),
                    pa.array([c for c, _ in part], pa.binary()),
                    pa.array([len(c) + 64 for c, _ in part], pa.int64()),
                    pa.array([hashlib.sha256(c).hexdigest() for c, _ in part]),
                    pa.array([-e[0][0] for _, e in part], pa.int64()),
                    pa.array([e[0][2] for _, e in part], arrow_id),
                    pa.array([e[0][3] for _, e in part], pa.int64()),
                    pa.array([e[1] for _, e in part], pa.int64()),
                    pa.array([e[2] for _, e in part], pa.list_(arrow_id)),
                    pa.array([e[3] for _, e in part], pa.list_(pa.int64())),
                    pa.array([e[0][3] for _, e in part], pa.int64()),
                ], names=schema.fieldNames())

        for batch in batches:
            texts = batch.column("text").to_pylist()
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                raw = (text or "").encode()
                content = raw.translate(None, BLANKS)
                rank = (-len(text or ""), doc is None, doc, pos)
                entry = found.get(content)
                if entry is None:
                    found[content] = [rank, text_hash(raw), [doc], [pos]]
                    held += len(content) + 200
                else:
                    if _before(rank, entry[0]):
                        entry[:2] = rank, text_hash(raw)
                    entry[2].append(doc)
                    entry[3].append(pos)
                    held += 64
                pos += 1
                if held > TASK_BYTES:
                    yield from flush()
                    found.clear()
                    held = 0
        yield from flush()

    return df.select("doc_id", "text").mapInArrow(run, schema)


def _before(a: tuple, b: tuple) -> bool:
    """Order of ranks (-chars, id is null, id, place); two null ids aren't compared."""
    return (a[0], a[1]) < (b[0], b[1]) or a[:2] == b[:2] and (a[3] < b[3] if a[1] or a[2] == b[2] else a[2] < b[2])


def _prefix(depth: str | int, key: str = "key") -> str:
    """SQL: a 1 and then the key's first bits."""
    return f"((1L << CAST({depth} AS INT)) | shiftrightunsigned({key}, 64 - CAST({depth} AS INT)))"


def directory(entries: DataFrame, bucket_bytes: int, total: int) -> tuple[int, DataFrame]:
    """The first depth, and for each bucket of that depth that is overfull: ``splits`` (depth, bucket), what is split, and
    ``lone`` (key, groups), the keys that overfill a bucket by themselves."""
    first = depth = min(40, max(1, math.ceil(math.log2(max(1, total / bucket_bytes)))))
    left, parts = entries.select("key", "size"), []
    sums = [F.sum("size").alias("size"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")]
    while True:
        fine = min(DEEPEST, depth + FINER)
        cells = left.groupBy(F.expr(_prefix(fine)).alias("cell")).agg(
            F.sum("size").alias("size"), F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("n"))
        levels = cells.withColumn("depth", F.explode(F.expr(f"sequence({depth}, {fine})")))
        nodes = levels.groupBy("depth", F.expr(f"shiftrightunsigned(cell, {fine} - depth)").alias("bucket")).agg(*sums)
        # a lone key is found where its bucket has no other one; deeper buckets say the same
        full = nodes.where(f"size > {bucket_bytes}").selectExpr(
            "depth", "bucket", "low < high AS splits", "IF(low = high, low, NULL) AS lone", "CAST(ceil(sqrt(n)) AS INT) AS groups",
            f"{_prefix(first, 'low')} AS start")
        parts.append(stage(full, "overfull"))
        more = parts[-1].where(f"splits AND depth = {fine}").select("bucket")
        if fine == DEEPEST or more.isEmpty():
            break
        left = left.withColumn("bucket", F.expr(_prefix(fine))).join(more, "bucket", "left_semi").select("key", "size")
        depth = fine + 1
    out = functools.reduce(DataFrame.unionByName, parts)
    return first, out.groupBy("start").agg(
        F.expr("collect_list(struct(depth, bucket)) FILTER (WHERE splits)").alias("splits"),
        F.expr("collect_set(struct(lone AS key, groups)) FILTER (WHERE lone IS NOT NULL AND groups > 1)").alias("lone"))


def with_buckets(entries: DataFrame, bucket_bytes: int, found: tuple[int, DataFrame] | None = None) -> DataFrame:
    """Add ``bucket``: a 1 and then the key's first bits, as many as the directory has there; and ``groups``: null, or in
    how many groups the entries of a lone key are collapsed first."""
    first, splits = found or directory(entries, bucket_bytes, total_size(entries))
    mine = f"filter(splits, s -> s.bucket = {_prefix('s.depth')})"
    # a bucket is split at every depth down to its own, so the number of splits on a key's path is its bucket's further depth
    return entries.join(splits, F.expr(f"{_prefix(first)} = start"), "left").withColumns({
        "bucket": F.expr(_prefix(f"({first} + IF(splits IS NULL, 0, size({mine})))")),
        "groups": F.expr("get(filter(lone, x -> x.key = key), 0).groups")}).drop("start", "splits", "lone")


def total_size(entries: DataFrame) -> int:
    return entries.agg(F.sum("size")).first()[0] or 0


def _thin(entries: DataFrame) -> DataFrame:
    """Entries in order of key and group: a text that comes again in its group becomes null, ``same_as`` names the first."""
    schema = entries.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("exact_dedup")
        last, seen = None, {}
        for batch in batches:
            content, same = batch.column("content").to_pylist(), batch.column("same_as").to_pylist()
            for i, group in enumerate(zip(batch.column("key").to_pylist(), batch.column("group").to_pylist(), strict=True)):
                if group != last:
                    last, seen = group, {}
                first = seen.setdefault(content[i], same[i])
                if first != same[i]:
                    content[i], same[i] = None, first
            columns = {n: batch.column(n) for n in schema.names} | {"content": pa.array(content, pa.binary()), "same_as": pa.array(same, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[n] for n in schema.names], names=schema.names)

    dealt = entries.withColumn("group", F.expr("pmod(xxhash64(keep_pos), groups)")).repartition("key", "group").sortWithinPartitions("key", "group")
    return dealt.mapInArrow(run, schema)


def _own(entries: DataFrame, id_type: T.DataType) -> DataFrame:
    """Compare bytes along each key's chain; rows: entries (complete or not) and class totals."""
    kinds = [("key", T.LongType()), ("chain", T.IntegerType()), ("kind", T.StringType()), ("text_sha256", T.StringType()),
             ("group_size", T.LongType()), ("keep_id", id_type), ("keep_pos", T.LongType()), ("keep_hash", T.LongType()),
             ("ids", T.ArrayType(id_type)), ("places", T.ArrayType(T.LongType()))]
    schema = T.StructType([T.StructField(n, t) for n, t in kinds])
    arrow_id = to_arrow_type(id_type)
    types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), arrow_id, pa.int64(), pa.int64(),
             pa.list_(arrow_id), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("exact_dedup")
        out: list[tuple] = []
        key, chain, named = None, [], {}

        def end() -> None:
            for k, (_, rank, keep_hash, size, sha, first) in enumerate(chain):
                keep = (rank[2], rank[3], keep_hash)
                out.append((key, k, "whole" if first else "total", sha, size, *keep, *(first or (None, None))))

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=schema.fieldNames())

        for batch in batches:
            columns = [batch.column(c) for c in ("key", "content", "chars", "keep_id", "keep_pos", "keep_hash", "text_sha256", "ids", "places", "same_as")]
            for i in range(batch.num_rows):
                k, content, chars, keep_id, pos, keep_hash, sha, ids, places, same = (c[i].as_py() for c in columns)
                if k != key:
                    end()
                    key, chain, named = k, [], {}
                rank = (-chars, keep_id is None, keep_id, pos)
                if content is None:
                    at = named[same]
                else:
                    at = next((n for n, c in enumerate(chain) if c[0] == content), None)
                    named[same] = len(chain) if at is None else at
                if at is None:
                    chain.append([content, rank, keep_hash, len(ids), sha, (ids, places)])
                    continue
                c = chain[at]
                if c[5]:
                    out.append((key, at, "part", sha, None, None, None, None, *c[5]))
                    c[5] = None
                out.append((key, at, "part", sha, None, None, None, None, ids, places))
                c[3] += len(ids)
                if _before(rank, c[1]):
                    c[1], c[2] = rank, keep_hash
            if len(out) > 2000:
                yield packed()
                out.clear()
        end()
        if out:
            yield packed()

    return entries.mapInArrow(run, schema)


def owners(total: int) -> int:
    """Tasks that the entries are dealt to."""
    return max(1, -(-total // OWNER_BYTES))


def exact_dedup(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``df`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256, keep_hash.

    ``keep_hash`` is xxhash64 of the text that stays; with ``keep_id`` it names the row (``common.keep_rows``).
    """
    need(df, "doc_id", "text")
    small_batches(df.sparkSession)
    entries = stage(_entries(df), "entries")
    total = total_size(entries)
    found = directory(entries, bucket_bytes, total)
    placed = with_buckets(entries, bucket_bytes, found)
    if not found[1].where("size(lone) > 0").isEmpty():
        placed = placed.where("groups IS NULL").unionByName(_thin(placed.where("groups IS NOT NULL")))
    dealt = placed.repartition(owners(total), "bucket")
    # what refers to a text comes behind it
    dealt = dealt.sortWithinPartitions("bucket", "key", F.isnull("content"))
    index = stage(_own(dealt, df.schema["doc_id"].dataType), "index")
    whole = index.where("kind = 'whole'").drop("kind", "key", "chain")
    totals = index.where("kind = 'total'").select("key", "chain", "group_size", "keep_id", "keep_pos", "keep_hash")
    parts = index.where("kind = 'part'").select("key", "chain", "text_sha256", "ids", "places").join(totals, ["key", "chain"])
    return whole.unionByName(parts.drop("key", "chain")).select("*", F.explode(F.arrays_zip("ids", "places")).alias("row")).selectExpr(
        "row.ids AS doc_id", "keep_id", "group_size", "row.places = keep_pos AS kept", "text_sha256", "keep_hash")
