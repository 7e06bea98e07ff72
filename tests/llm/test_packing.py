import math
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cardwatch.llm import packing
from cardwatch.llm.common import stage

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, capacity):
    """Every sequence is filled without gaps, and none is too long."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces(docs, odd):
    library = Tokenizer.from_file(PATH)
    rows = packing.pieces(docs(odd).withColumnRenamed("lang", "lane"), PATH, capacity=64).collect()
    expected = []
    for i, t in odd:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids), 64), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            expected.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(expected, key=str)
    assert len({r.lane for r in rows}) == len(rows)


def test_words_with_one_hash(docs):
    from tests.llm.test_near_dedup import mirror

    library = Tokenizer.from_file(PATH)
    texts = [t for n in (512, 1024, 2048, 4096, 8192) for t in mirror(n)]
    rows = packing.pieces(docs([*enumerate(texts)]).coalesce(1), PATH, capacity=100_000).collect()
    expected = [(k, zlib.crc32(np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes())) for k, t in enumerate(texts)]
    assert sorted((r.doc_id, r.ids_crc32) for r in rows) == expected


def test_few_sequences(spark):
    rng = random.Random(4)
    lengths = [rng.choice([rng.randrange(1, 1025), 1024, 700, 300]) for _ in range(12_000)]
    items = stage(spark.createDataFrame([(n, k * 7919 + 3) for k, n in enumerate(lengths)], "length long, lane long"), "t")
    rows = packing.pack(items, group=2048).collect()
    assert sorted(r.length for r in rows) == sorted(lengths)
    best = len(packing.best_fit(lengths, 1024))  # best fit with all in one task
    assert math.ceil(sum(lengths) / 1024) <= check(rows, 1024) <= best * 1.005


def test_repeated_rows_and_clashing_names(docs):
    table = docs([(1, "same words here")] * 500 + [(2, None)])
    items = stage(packing.pieces(table, PATH, capacity=50), "t").selectExpr("*", "1 AS bucket", "2 AS offset", "3 AS sequence_id")
    rows = packing.pack(items, capacity=50, group=64).collect()
    assert len(rows) == 501
    check(rows, 50)


def test_empty_table(docs):
    assert packing.pack(stage(packing.pieces(docs([]), PATH), "t")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=40))
def test_local_search_keeps_all_and_raises_fill(lengths):
    first = packing.best_fit(lengths, 40)
    after = packing.local_search(lengths, first, 40)
    assert sorted(i for b in after for i in b) == list(range(len(lengths)))
    fills = [[sum(lengths[i] for i in b) for b in bins] for bins in (first, after)]
    assert all(f <= 40 for f in fills[1]) and len(after) <= len(first)
    assert sum(f * f for f in fills[1]) >= sum(f * f for f in fills[0])


def test_swaps_empty_a_sequence():
    """Three sequences that moves alone can't make two."""
    lengths = [6, 3, 5, 4, 2]  # capacity 10, all in all 20
    after = packing.local_search(lengths, [[0, 1], [2, 3], [4]], 10)
    assert len(after) == 2
