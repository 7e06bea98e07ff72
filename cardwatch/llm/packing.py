"""Best-fit packing with swap-based local search.

``pieces`` turns documents into token pieces of at most ``capacity``; ``pack`` puts pieces into sequences.
Pieces are dealt at random into groups of a fixed size, so no task grows with the data and a hot source
or repeated rows change nothing. In a group, best fit (longest first) gives a first packing; then local
search takes an underfull sequence and moves its documents, exchanges one of them for one elsewhere, or two
of them for one, whenever that raises the sum of squared fills, until the sequence is empty. What lies in
sequences that stay open goes to the next round, where groups from everywhere meet; rounds end when one
group holds the rest or a round no longer helps.

Null or empty text is a document of just the end id. Ties and repeated rows are packed one by one (by row,
not by id); an empty table gives an empty table; null ids are carried. ``pieces`` returns only its own
columns, so extra columns can't clash; ``pack`` replaces columns with the names of its results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import bpe
from cardwatch.llm.common import mix, need, small_batches, stage

#: Pieces that one task packs at a time.
GROUP = 4096
#: Sequences filled to this share stay closed between rounds.
CLOSED = 0.97

PIECES = "doc_id {kind}, piece int, start long, length long, ids_crc32 long, lane long"


def pieces(df: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Tokenize ``doc_id``, ``text``; documents longer than ``capacity`` are cut so that only the first piece is short.

    ``lane`` is a scrambled row number that deals rows out evenly.
    """
    need(df, "doc_id", "text")
    small_batches(df.sparkSession)
    file = bpe.read_tokenizer(df, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = bpe.loaded(file.value)
        seen = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part, texts in bpe._slices(batch, "text"):
                ids, at = encoder.encode(texts)
                ids = np.insert(ids, at[1:], end_id).astype("<u4")
                total = np.diff(at) + 1
                count = -(-total // capacity)
                row = np.repeat(np.arange(len(texts)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                short = total - (count - 1) * capacity
                length = np.where(piece == 0, short[row], capacity)
                start = np.where(piece == 0, 0, short[row] + (piece - 1) * capacity)
                begin = (np.cumsum(total) - total)[row] + start
                crc = [zlib.crc32(ids[b:e].data) for b, e in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
                lane = (mix(np.arange(seen, seen + len(row))) >> np.uint64(1)).astype(np.int64)
                seen += len(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(lane)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "lane"])

    return df.select("doc_id", "text").mapInArrow(run, PIECES.format(kind=df.schema["doc_id"].dataType.simpleString()))


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Longest first, each into the fullest sequence that has room."""
    bins: list[list[int]] = []
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit s: a sequence with s left
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        size = lengths[i]
        fits = rooms >> size
        if fits:
            space = (fits & -fits).bit_length() - 1 + size
            b = by_space[space].pop()
            if not by_space[space]:
                rooms ^= 1 << space
            bins[b].append(i)
        else:
            space, b = capacity, len(bins)
            bins.append([i])
        by_space[space - size].append(b)
        rooms |= 1 << (space - size)
    return bins


def local_search(lengths: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Empty underfull sequences by moves and swaps, each of which raises the sum of squared fills."""
    bins = [list(b) for b in bins]
    fill = np.array([sum(lengths[i] for i in b) for b in bins], dtype=np.int64)
    least = -(-int(fill.sum()) // capacity)
    live = len(bins)
    for target in np.argsort(fill, kind="stable").tolist():
        if live <= least or fill[target] >= CLOSED * capacity:
            break
        # every place for documents of the target: (sequence, what it gives back or -1)
        others = np.flatnonzero((fill < capacity) & (fill > 0) & (np.arange(len(bins)) != target))
        places = [(b, i) for b in others.tolist() for i in (-1, *bins[b])]
        while bins[target] and places:
            where = np.array([b for b, _ in places])
            back = np.array([lengths[i] if i >= 0 else 0 for _, i in places])
            room = capacity - fill[where]
            own = bins[target]
            offers = [(i,) for i in own] + [(i, j) for n, i in enumerate(own) for j in own[n + 1:]]
            best = (0, None, None)
            for offer in offers:
                more = sum(lengths[i] for i in offer) - back
                gain = np.where((more > 0) & (more <= room), 2 * more * (fill[where] - fill[target] + more), 0)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (int(gain[k]), offer, k)
            if best[1] is None:
                break
            b, given = places[best[2]]
            moved = sum(lengths[i] for i in best[1]) - (lengths[given] if given >= 0 else 0)
            bins[target] = [i for i in own if i not in best[1]] + ([given] if given >= 0 else [])
            bins[b] = [i for i in bins[b] if i != given] + list(best[1])
            fill[b] += moved
            fill[target] -= moved
            places = [p for p in places if p[0] != b] + [(b, i) for i in (-1, *bins[b]) if fill[b] < capacity]
        if not bins[target]:
            live -= 1
    return [b for b in bins if b]


def _pack_group(capacity: int, level: int, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("lane", ignore_index=True)
    lengths = rows["length"].tolist()
    bins = local_search(lengths, best_fit(lengths, capacity), capacity)
    sequence, offset, open_ = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), np.zeros(len(rows), bool)
    base = (level << 56) + (int(rows["bucket"].iloc[0]) << 20)
    for k, b in enumerate(bins):
        at = 0
        for i in b:
            sequence[i], offset[i] = base + k, at
            at += lengths[i]
        open_[b] = at < CLOSED * capacity
    return rows.drop(columns="bucket").assign(sequence_id=sequence, offset=offset, is_open=open_)


def pack(items: DataFrame, capacity: int = 1024, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored rows that have ``length`` (1 to capacity) and ``lane``."""
    need(items, "length", "lane")
    items = items.drop("bucket", "sequence_id", "offset", "is_open")
    schema = T.StructType([*items.schema.fields, *(T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")), T.StructField("is_open", T.BooleanType())])
    # A full piece is a sequence of its own; these have negative numbers.
    done = items.where(F.col("length") == capacity).selectExpr("*", "-1 - monotonically_increasing_id() AS sequence_id", "0L AS offset")
    rest = items.where(F.col("length") < capacity)
    n, level = rest.count(), 0
    while n:
        buckets = -(-n // group)
        dealt = rest.withColumn("bucket", F.expr(f"pmod(xxhash64(lane, {level}), {buckets})"))
        packed = dealt.groupBy("bucket").applyInPandas(partial(_pack_group, capacity, level), schema)
        packed = stage(packed, f"packed{level}")
        left = packed.where("is_open").count() if buckets > 1 else 0
        last = buckets == 1 or left > 0.8 * n
        done = done.unionByName((packed if last else packed.where("NOT is_open")).drop("is_open"))
        if last:
            break
        rest, n, level = packed.where("is_open").select(*items.columns), left, level + 1
    return done
