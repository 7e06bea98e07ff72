import collections
import random

import numpy as np

from cardwatch.llm import near_dedup as nd
from cardwatch.llm.common import keep_rows
from cardwatch.llm.graph import components, merged


def bag(text):
    w = (text or "").lower().split()
    return collections.Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else collections.Counter()


def jaccard(a, b):
    common = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - common
    return common / total if total else 1.0


def brute(rows):
    bags = [bag(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(bags[i], bags[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    members = collections.defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    return sorted(sorted(m, key=str) for m in members.values()) if all(i is not None for i, _ in rows) else sorted((sorted(m, key=str) for m in members.values()), key=str)


def classes(df):
    rows = df.collect()
    out = collections.defaultdict(list)
    for r in rows:
        out[(r.class_id, r.keep_hash)].append(r)
    for members in out.values():
        assert sum(r.kept for r in members) == 1
        assert {r.class_size for r in members} == {len(members)}
        ids = [r.doc_id for r in members if r.doc_id is not None]
        assert members[0].class_id == (min(ids) if ids else None)
    return sorted((sorted((r.doc_id for r in m), key=str) for m in out.values()), key=str)


def text(rng, n=80):
    return " ".join(rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(n))


def edited(rng, t, k):
    w = t.split()
    for _ in range(k):
        w[rng.randrange(len(w))] = "new" + str(rng.randrange(10_000))
    return " ".join(w)


def test_groups_chains_and_copies(docs):
    rng = random.Random(5)
    base = text(rng, 200)
    rows = [(i, edited(rng, base, 2)) for i in range(60)]  # a large group; two members may be below 0.8
    rows += [(100 + i, text(rng)) for i in range(30)]
    chain = text(rng, 120)
    for i in range(8):  # each like the one before, the ends unlike
        rows.append((200 + i, chain))
        chain = edited(rng, chain, 2)
    rows += [(300 + i, rows[0][1].upper()) for i in range(20)]
    assert classes(nd.near_dedup(docs(rows).repartition(7))) == sorted(brute(rows), key=str)


def test_repeats_count(docs):
    """Multisets differ though the sets of shingles are equal."""
    line = "one two three four five six seven eight"
    rows = [(1, f"{line} " * 40), (2, f"{line} " * 38), (3, f"{line} " * 10), (4, line)]
    assert classes(nd.near_dedup(docs(rows))) == sorted(brute(rows), key=str) == [[1, 2], [3], [4]]


def test_odd_rows(docs, odd):
    table = docs(odd).withColumnRenamed("lang", "node").withColumnRenamed("source", "bucket")
    result = nd.near_dedup(table)
    assert classes(result) == sorted(brute(odd), key=str)
    kept = keep_rows(table, result.where("kept"))
    assert kept.columns == table.columns and kept.count() == len(brute(odd))


def test_empty_table(docs):
    assert nd.near_dedup(docs([])).collect() == []


def test_signature_is_unbiased():
    """Agreement of slots estimates the weighted Jaccard similarity, heavy weights too."""
    rng = np.random.default_rng(3)
    n = 300
    value = rng.integers(1, 1 << 62, n).astype(np.uint64)
    for scale in (1, 5, 60):
        a = rng.integers(1, scale + 1, n)
        b = np.where(rng.random(n) < 0.7, a, rng.integers(1, scale + 1, n))
        s = nd.signatures(np.repeat([0, 1], n), np.concatenate([value, value]), np.concatenate([a, b]), 2, slots=4000)
        assert np.isfinite(s).all()
        true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((s[0] == s[1]).mean() - true) < 0.035


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 7), (7, 5), (9, 9), (1, 200)] + [(500, 500 + rng.randrange(1, 50)) for _ in range(80)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and got[5] == got[7] == 5 and 9 not in got and got[200] == 1
    assert {c for n, c in got.items() if n >= 500} == {500}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_go_on(spark):
    """Links that come in turns give the components of all links."""
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)]
    labels = None
    for k in range(0, 260, 65):
        labels = merged(labels, spark.createDataFrame(edges[k:k + 65], "a long, b long"))
        whole = components(spark.createDataFrame(edges[:k + 65], "a long, b long"))
        assert sorted(map(tuple, labels.collect())) == sorted(map(tuple, whole.collect()))


def mirror(n):
    """A word of a and b and its complement: polynomials modulo 2^64 don't tell them apart from 1024 letters on."""
    w = "a"
    while len(w) < n:
        w += w.translate(str.maketrans("ab", "ba"))
    return w, w.translate(str.maketrans("ab", "ba"))


def test_words_with_one_hash(docs, monkeypatch):
    rows = [(10 * n + k, f"{w} and some more words here") for n in (512, 1024, 2048, 4096, 8192) for k, w in enumerate([*mirror(n), mirror(n)[0]])]
    rows += [(1 + k, w) for k, w in enumerate(mirror(2048))]
    assert classes(nd.near_dedup(docs(rows))) == sorted(brute(rows), key=str)


def test_bags_are_exact(monkeypatch):
    """Also when all hashes of spans are equal."""
    from cardwatch.llm import common

    rng = random.Random(9)
    texts = [text(rng, rng.randrange(0, 40)) for _ in range(30)] + [*mirror(1024), "", "a", "a a", "A a a a a a a"]
    for quick in (common._quick_hashes, lambda p, s, e: np.zeros(len(s), dtype=np.uint64)):
        monkeypatch.setattr(common, "_quick_hashes", quick)
        found = nd.bags(texts)
        for i, a in enumerate(texts):
            for j in range(i, len(texts)):
                assert nd.overlap(found[i], found[j]) == jaccard(bag(a), bag(texts[j]))
    assert nd.bags([]) == []
