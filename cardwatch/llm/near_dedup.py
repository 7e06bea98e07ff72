"""Near-duplicate documents by BagMinHash over the multiset of five-word shingles.

A shingle with count w stands for the weights 0 to w, cut into the levels [0,1), [1,2), [2,4), [4,8) and so on.
Each level of each shingle has its own Poisson process (rate: slots times width); a point falls into a random
slot and at a random weight of its level, and counts if that weight is below w. The first point of a slot over all
shingles is the slot's signature value, so two documents agree in a slot with the probability of their weighted
Jaccard similarity. Points are drawn in order of time, and a shingle stops as soon as its time is beyond the last
slot's first point: the work is about linear in the shingles plus the slots.

Signatures are cut into bands; documents with an equal band meet in a bucket. Copies (equal words in order)
count once. In a bucket one document, the head, is compared with the others, unless a longer signature rules a pair out
(weighted Jaccard of the whole multisets, from the texts and by their words, not by hashes); who matches joins its component, the head leaves the bucket, and the bucket goes on
with sixteen times the heads while it has members of different components; once few comparisons match, the rest of
each bucket is compared at once. So a group of n near copies costs about n
comparisons, not n squared, and no link between different components is left out. Pairs within one component aren't
compared, as they can't change the classes.

Words are lower-cased runs between white space; a text of one to four words is one shingle. Texts without words
(null, empty, blank) are copies of each other. The smallest id (null last) stays, then the first row read: one
row of each class, also if rows repeat. Other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm.common import chunks, kept, mix, need, number_spans, small_batches, space_spans, span_hashes, stage, text_hash
from cardwatch.llm.graph import merged

SHINGLE, THRESHOLD = 5, 0.8
#: 26 bands of 5 slots miss a pair of similarity 0.8 with a probability of 0.00003.
BANDS, ROWS = 26, 5
SLOTS = BANDS * ROWS
#: Members of buckets get a second signature of so many slots, four bits each. A pair whose second signatures agree in
#: fewer slots than the threshold's mean less ``DEVIATIONS`` standard deviations isn't compared (one pair in 300 000 at
#: the threshold, fewer above it).
WIDE, DEVIATIONS = 1024, 4.5
#: Characters of text that a worker takes apart at once; a longer text is taken by itself.
CHUNK = 300_000
#: Members of a bucket that one task compares with the bucket's heads.
PART_ROWS = 2048
#: Members of buckets of at most this number are broadcast (8 bytes each, 16 with a label): to pick texts, to label.
BROADCAST_NODES = 2_000_000
_G = np.uint64(0x9E3779B97F4A7C15)


def _places(doc: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of texts whose words are numbered through: (text, first word, words) of each, and each text's number of shingles."""
    n_words = np.bincount(doc, minlength=n_texts)
    size = np.minimum(n_words, SHINGLE)
    first = np.cumsum(n_words) - n_words
    total = np.where(n_words > 0, n_words - size + 1, 0)
    of = np.repeat(np.arange(n_texts), total)
    at = np.repeat(first - (np.cumsum(total) - total), total) + np.arange(len(of))
    return of, at, size[of], total


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (text index, hash, count), and each text's number of shingles."""
    points, starts, ends, doc = space_spans([t.lower() for t in texts])
    word = span_hashes(points, starts, ends)
    of, at, size, total = _places(doc, len(texts))
    value = np.zeros(len(of), dtype=np.uint64)
    for k in range(SHINGLE):
        has = size > k
        value[has] = mix(value[has] * _G + word[at[has] + k])
    own, index, count = np.unique(value ^ mix(of.astype(np.uint64) + _G), return_index=True, return_counts=True)
    order = np.argsort(index)
    index = index[order]
    return of[index], value[index], count[order], total


def signatures(doc: np.ndarray, value: np.ndarray, count: np.ndarray, n_docs: int, slots: int = SLOTS) -> np.ndarray:
    """BagMinHash values (n_docs, slots); infinite where a document has no shingles."""
    levels = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, 1)
    who = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(who)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.where(level == 0, 1, low)
    seed = mix(value[who] + mix(level.astype(np.uint64) + _G))
    doc, below = doc[who], (count[who] - low) / width
    rate = (width * slots).astype(np.float64)
    time = np.zeros(len(doc))
    sig = np.full(n_docs * slots, np.inf)
    step, at_once = 0, 1
    while len(doc):
        k = (np.arange(step, step + at_once, dtype=np.uint64) + np.uint64(1)) * _G
        draw = mix(seed[:, None] + k)
        gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
        when = time[:, None] + np.cumsum(gap, axis=1) / rate[:, None]
        other = mix(draw ^ _G)
        slot = (other >> np.uint64(40)) % np.uint64(slots)
        weight = (other & np.uint64(0xFFFFFFFFFF)).astype(np.float64) * 2.0 ** -40
        hit = weight < below[:, None]
        np.minimum.at(sig, ((doc * slots)[:, None] + slot.astype(np.int64))[hit], when[hit])
        time = when[:, -1]
        goes = time < sig.reshape(n_docs, slots).max(axis=1)[doc]
        seed, doc, below, rate, time = seed[goes], doc[goes], below[goes], rate[goes], time[goes]
        step += at_once
        at_once = 1 if step < 3 else min(64, step)
    return sig.reshape(n_docs, slots)


def bands(sig: np.ndarray, n_bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band, its number included."""
    bits = sig.view(np.uint64).reshape(len(sig), n_bands, -1)
    key = np.broadcast_to(np.arange(n_bands, dtype=np.uint64) + _G, (len(sig), n_bands))
    for k in range(bits.shape[2]):
        key = mix(key * _G + bits[:, :, k])
    return key.view(np.int64)


def codes(sig: np.ndarray) -> np.ndarray:
    """Four bits of each slot, 16 slots to a number: (n_docs, numbers)."""
    bits = mix(sig.view(np.uint64)) >> np.uint64(60)
    wide = np.zeros((len(sig), -(-sig.shape[1] // 16) * 16), dtype=np.uint64)
    wide[:, : sig.shape[1]] = bits
    shift = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return np.bitwise_or.reduce(wide.reshape(len(sig), -1, 16) << shift, axis=2).view(np.int64)


def _alike(a: str, b: str, threshold: float) -> str:
    """SQL: enough slots agree. A slot differs if any of its four bits does; equal by chance: one in 16."""
    mean = threshold + (1 - threshold) / 16

    def within(slots: int) -> str:
        most = slots - int((mean - DEVIATIONS * (mean * (1 - mean) / slots) ** 0.5) * slots)
        differing = f"zip_with(slice({a}, 1, {slots // 16}), slice({b}, 1, {slots // 16}), (x, y) -> x ^ y)"
        counts = f"transform({differing}, z -> bit_count((z | (z >> 1) | (z >> 2) | (z >> 3)) & 1229782938247303441L))"
        return f"aggregate({counts}, 0, (n, z) -> n + z) <= {most}"

    return f"{within(WIDE // 8)} AND {within(WIDE)}"  # an eighth of the slots rules most pairs out


def _wide(texts: DataFrame) -> DataFrame:
    """(node, code, bands): the second signatures of stored texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("near_dedup")
        for batch in batches:
            nodes = batch.column("node")
            for first, part in chunks(batch.column("text").to_pylist(), CHUNK):
                doc, value, count, _ = shingles(part)
                code = codes(signatures(doc, value, count, len(part), WIDE))
                at = pa.array(np.arange(len(part) + 1, dtype=np.int32) * code.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [nodes.slice(first, len(part)), pa.ListArray.from_arrays(at, pa.array(code.reshape(-1))), batch.column("bands").slice(first, len(part))],
                    names=["node", "code", "bands"])

    return texts.mapInArrow(run, "node long, code array<long>, bands array<long>")


def _sketch(df: DataFrame) -> DataFrame:
    schema = T.StructType([
        df.schema["doc_id"], T.StructField("text", T.StringType()), T.StructField("node", T.LongType()), T.StructField("keep_hash", T.LongType()),
        T.StructField("copy", T.StringType()), T.StructField("total", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("near_dedup")
        node = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, texts in chunks([t or "" for t in batch.column("text").to_pylist()], CHUNK):
                doc, value, count, total = shingles(texts)
                keys = bands(signatures(doc, value, count, len(texts)))
                copy = [hashlib.blake2b(" ".join(t.lower().split()).encode(), digest_size=16).hexdigest() for t in texts]
                n = len(texts)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, n), pa.array(texts, pa.string()), pa.array(np.arange(node, node + n)),
                    pa.array([text_hash(t.encode()) for t in texts], pa.int64()), pa.array(copy), pa.array(total),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1)))],
                    names=schema.fieldNames())
                node += n

    return df.select("doc_id", "text").mapInArrow(run, schema)


def overlap(a: tuple[np.ndarray, np.ndarray, int], b: tuple[np.ndarray, np.ndarray, int]) -> float:
    """Weighted Jaccard similarity of two multisets (sorted numbers, counts, total)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / (a[2] + b[2] - common) if a[2] + b[2] else 1.0


def bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Multiset of each text's shingles: (numbers, counts, total). Words, and then ever longer runs of words, are numbered by
    what they are, not by a hash: equal numbers mean equal words."""
    points, starts, ends, doc = space_spans([t.lower() for t in texts])
    _, word = number_spans(points, starts, ends)
    of, at, size, total = _places(doc, len(texts))
    number = word[at]
    for k in range(1, SHINGLE):
        more = np.where(size > k, word[np.minimum(at + k, max(len(word) - 1, 0))] + 1, 0) if len(at) else number
        number = np.unique(number * (len(word) + 1) + more, return_inverse=True)[1]
    edge = np.concatenate([[0], np.cumsum(total)])
    return [(*np.unique(number[edge[i]:edge[i + 1]], return_counts=True), int(total[i])) for i in range(len(texts))]


def _verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts' multisets overlap enough. The text of b travels to a, which may be hot."""
    member = pairs.join(texts.selectExpr("node AS b", "text AS text_b"), "b")
    joined = member.join(texts.selectExpr("node AS a", "text AS text_a"), "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("near_dedup")
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            text_a, found = batch.column("text_a"), []
            for first, part in chunks(batch.column("text_b").to_pylist(), CHUNK):
                own = {x: k for k, x in enumerate(dict.fromkeys(a[first:first + len(part)]))}
                heads = {x: text_a[k].as_py() for k, x in enumerate(a[first:first + len(part)], first)}
                both = bags([*(heads[x] for x in own), *part])
                found += [first + k for k in range(len(part)) if overlap(both[own[a[first + k]]], both[len(own) + k]) >= threshold]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for k in found], pa.int64()) for x in (a, b)], names=["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def _meet(members: DataFrame, wide: DataFrame, first: bool, threshold: float) -> DataFrame:
    """Pairs (a, b) of each bucket's heads with all its members of other components.

    A pair is left out if the totals or the signatures say that it can't be similar enough."""
    # a large bucket is dealt over several tasks; its heads go to all of them
    parts = f"CAST(ceil(n / {PART_ROWS}) AS INT)"
    coded = members.join(wide, "node").withColumn("salt", F.expr(f"CAST(pmod(xxhash64(node), {parts}) AS INT)"))
    left = coded.where("is_head").withColumn("salt", F.explode(F.expr(f"sequence(0, {parts} - 1)"))).selectExpr("bucket AS bucket_a", "salt AS salt_a", "node AS a", "comp AS comp_a", "total AS total_a", "code AS code_a", "bands AS bands_a")
    # two heads meet once; the totals bound the similarity
    may = (f"bucket = bucket_a AND salt = salt_a AND comp <> comp_a AND (NOT is_head OR a < node) AND least(total, total_a) >= {threshold} * greatest(total, total_a) "
           f"AND {_alike('code', 'code_a', threshold)}")
    if not first:  # a pair that shares many buckets meets in the first of them
        may += " AND get(filter(zip_with(bands, bands_a, (x, y) -> IF(x = y, x, NULL)), z -> z IS NOT NULL), 0) = bucket"
    # dealt out here: a split at run time would cut both sides of a bucket and run every pair of cuts; small parts may be put together
    pairs = coded.repartition("bucket", "salt").join(left.repartition("bucket_a", "salt_a"), F.expr(may)).selectExpr("a", "node AS b")
    return pairs.distinct() if first else pairs


def _next(members: DataFrame, heads: int | None) -> DataFrame:
    """Members of buckets with several components, with ``n`` (the bucket's members) and ``is_head``: the smallest rank of
    each of ``heads`` hashed parts of the bucket (None: all). Minima are combined before the shuffle."""
    spread = [F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"), F.collect_list("top").alias("tops")]
    part = F.expr(f"pmod(xxhash64(node), {heads or 1})").alias("part")
    tops = members.groupBy("bucket", part).agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("n"), F.min("rank").alias("top"))
    state = tops.groupBy("bucket").agg(*spread) if heads and heads > 1 else tops.selectExpr("bucket", "low", "high", "n", "array(top) AS tops")
    is_head = "array_contains(tops, rank)" if heads else "true"
    return members.join(state.where("low < high").select("bucket", "n", "tops"), "bucket").selectExpr("node", "total", "bucket", "n", "rank", "comp", f"{is_head} AS is_head")


def near_dedup(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``df`` (doc_id, text): doc_id, class_id (smallest id), class_size, kept, keep_hash."""
    need(df, "doc_id", "text")
    small_batches(df.sparkSession)
    docs = stage(_sketch(df), "sketch")
    first = stage(docs.groupBy("copy").agg(F.min(F.struct("node", "total", "bands")).alias("rep")).select("copy", "rep.*").withColumnRenamed("node", "rep"), "copies")
    rows = first.where("total > 0").select(F.col("rep").alias("node"), "total", F.explode("bands").alias("bucket"))
    first = first.select("copy", "rep")
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    # heads are documents that share many buckets, as the middle of a group does; ties by a hash. A document has at most BANDS rows
    of = Window.partitionBy("node")
    ranked = rows.join(shared, "bucket").withColumns({"shares": F.count(F.lit(1)).over(of), "once": F.row_number().over(of.orderBy("bucket")) == 1})
    rank = f"(({BANDS} - shares) << 58) | (xxhash64(node) & 288230376151711743L) AS rank"
    members = stage(ranked.selectExpr("node", "total", "bucket", rank, "node AS comp", "once"), "members")

    nodes = members.where("once").select("node")
    small = nodes.count() <= BROADCAST_NODES
    hint = F.broadcast if small else (lambda df: df)
    texts = stage(docs.select("node", "text", "bands").join(hint(nodes), "node", "left_semi"), "texts")
    wide = stage(_wide(texts), "wide")
    labels, heads, members = None, 1, stage(_next(members, 1), "members")
    while not members.isEmpty():
        pairs = stage(_meet(members, wide, labels is None, threshold), "pairs")
        found = stage(_verify(pairs, texts, threshold), "links")
        matched = found.count()
        labels = merged(labels, found, small)
        if heads is None:
            break
        # when few comparisons match, what is left is mostly unlike: the rest meets at once
        heads = heads * 16 if 10 * matched >= pairs.count() else None
        rest = members.where("NOT is_head").drop("comp", "n").join(hint(labels.withColumnRenamed("component", "comp")), "node", "left")
        members = stage(_next(rest.withColumn("comp", F.coalesce("comp", "node")), heads), "members")
    named = docs.select("doc_id", "node", "keep_hash", "copy").join(first, "copy").select("doc_id", "node", "keep_hash", "rep")
    if labels is not None:
        named = named.join(hint(labels.withColumnRenamed("node", "rep")), "rep", "left").selectExpr("doc_id", "node", "keep_hash", "coalesce(component, rep) AS class")
    else:
        named = named.withColumnRenamed("rep", "class")
    named = stage(named, "named")
    best = named.groupBy("class").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "node", "keep_hash")).alias("best"), F.count(F.lit(1)).alias("class_size"))
    return named.drop("keep_hash").join(best, "class").selectExpr(
        "doc_id", "best.doc_id AS class_id", "class_size", "node = best.node AS kept", "best.doc_id AS keep_id", "best.keep_hash AS keep_hash")
