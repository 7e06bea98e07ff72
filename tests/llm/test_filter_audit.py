import itertools
import re
from collections import Counter

from cardwatch.llm.filter_audit import FILTERS, audit, cells, orders

DOCS, LABELS = "doc_id long, text string, lang string, source string, n_chars long", "doc_id long, quality int, toxic int"


def failed(rows):
    """For each row (doc_id, text, lang) the letters of the filters it fails."""
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t, *_ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append("".join(f for f, hit in zip(FILTERS, (
            len(words) < 100, 100 * len({*words}) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search("[#$%&*|]", t)), i is not None and i > least[t]), strict=True) if hit))
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    fails = failed(rows)
    out = {}
    for part in {r[2] or "" for r in rows}:
        mine = [(f, r[0]) for f, r in zip(fails, rows, strict=True) if (r[2] or "") == part]
        shapley = Counter()
        for order in map("".join, itertools.permutations(FILTERS)):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                shapley[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(f in x[0] for x in mine) - len(gone), sum(x[0] == f for x in mine),
                                          sum(x[1] in good for x in gone), sum(x[1] in toxic for x in gone)]
        for (p, order, step), found in out.items():
            if p == part:
                found.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def run(spark, rows, labels, extra=()):
    docs = spark.createDataFrame([(i, t, lang, None, None) for i, t, lang in rows], DOCS).selectExpr("*", *extra)
    got = audit(cells(docs, spark.createDataFrame(labels, LABELS))).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[m] for m in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in got}
    assert len(found) == len(got)
    assert found == brute(rows, labels)
    return found


def text(n, repeat=1, more=""):
    return " ".join(f"w{k // repeat}" for k in range(n)) + more


def test_orders():
    assert len({*orders()}) == 120 and orders()[0] == FILTERS


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", "en"), (3, " \n", ""), (4, text(99), "en"), (5, text(100), "en"), (6, text(100), "de"), (6, text(100), "en"),
            (5, text(100), "en"), (None, text(100), "en"), (None, text(100), None), (7, text(200, 2), "en"), (8, text(100, 1, " #"), "en"),
            (9, text(125) + " " + text(25), "en"), (10, text(124) + " " + text(32), "en"), (11, "A" * 10 + "b" * 90, "en"), (12, "A" * 11 + "b" * 89, "en"),
            (13, "word " * 60_000, "de"), (14, "x" * 100_000, "de"), (15, "A|b A|b", "fr"), (16, text(100, 1, "\x85　#"), "fr"), (17, "a\x1cb É", "fr"),
            (18, text(100, 1, " 日本👩‍👩‍👧"), "fr"), (0, "A|b A|b", "de")]
    labels = [(1, 1, 0), (4, 1, 1), (5, 1, None), (5, 0, 1), (6, None, None), (7, 0, 1), (8, 1, 1), (None, 1, 1), (12, 1, 0), (15, 1, 1), (99, 1, 1)]
    found = run(spark, rows, labels, extra=("1 AS part", "2 AS n", "3 AS own", "4 AS good", "5 AS mask", "6 AS its_id", "7 AS content"))
    assert {p for p, _, _ in found} == {"", "en", "de", "fr"}


def test_copies_on_most_rows(spark):
    run(spark, [(i, "same" if i % 3 else text(120, 1, f" {i}"), ["en", "de"][i % 2]) for i in range(300)], [(i, i % 2, int(i % 5 == 0)) for i in range(0, 300, 7)])


def test_empty_tables(spark):
    assert run(spark, [], [(1, 1, 1)]) == {}
    run(spark, [(1, "a", "en")], [])
