import collections
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardwatch.llm import chat

text = st.text(st.sampled_from("\\#</turn> \nab:é"), max_size=25) | st.lists(st.sampled_from(["###", "</turn>", "\\", "\n", "### user\n", "x", " "]), max_size=8).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(text, text), max_size=5))
def test_round_trip(turns):
    written = [chat.write_turn(r, t) for r, t in turns]
    whole = "".join(w for w, _, _ in written)
    assert chat.read_turns(whole) == turns
    for (w, a, b), (_, t) in zip(written, turns, strict=True):
        assert chat.unescape(w[a:b]) == t


def brute(rows):
    convs = collections.defaultdict(list)
    for conv, turn, role, text_ in rows:
        convs[conv].append((turn is None, turn or 0, role is None, role or "", text_ is None, text_ or ""))
    out = {}
    for conv, turns in convs.items():
        turns = [(t[3], t[5]) for t in sorted(turns)]
        own = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(own), hashlib.sha256(own.encode()).hexdigest())
    return out


def result(df):
    from cardwatch.llm.common import stage

    rows = chat.digests(chat.format_branches(stage(chat.chain(df), "t"))).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


KIND = "conv_id long, turn long, role string, text string, node string, leaf long"


def test_odd_rows(spark, monkeypatch):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", None), (1, None, None, "late"), (None, 0, "user", "no id"), (None, 1, "assistant", "ok"),
            (2, 5, "assistant", "### user\n</turn>\\"), (3, 0, "user", ""), (4, 0, "assistant", "x" * 300_000), (4, 1, "assistant", "y\\" * 100_000), (4, 2, "user", "z")]
    rows += [(5, k, "user" if k % 2 else "assistant", f"turn {k}") for k in range(300)]
    monkeypatch.setattr(chat, "PART", 1000)  # conversations in many parts
    assert result(spark.createDataFrame([(*r, None, None) for r in rows], KIND)) == brute(rows)
    assert result(spark.createDataFrame([], KIND)) == {}


@pytest.fixture()
def trees(spark):
    nodes = [  # conv, node, parent, score
        (1, 1, None, 1.0), (1, 2, 1, 3.0), (1, 3, 1, 1.0), (1, 4, 2, 0.0), (1, 5, 2, 5.0), (1, 6, 3, None),
        (2, 1, 99, 0.0), (2, 2, 1, 0.0), (2, 3, 1, 0.0),  # an unknown parent; equal scores
        (3, 1, 2, 0.0), (3, 2, 1, 0.0), (3, 3, 2, 0.0),  # a cycle has no root
        (None, 1, None, 0.0), (None, 2, 1, 0.0),
    ]
    return spark.createDataFrame([(*n, "user", f"t{n[1]}") for n in nodes], "conv_id long, node long, parent long, score double, role string, text string")


def test_branches(trees):
    got = collections.defaultdict(list)
    for r in chat.branches(trees).collect():
        got[(r.conv_id, r.rank)].append((r.position, r.node))
    paths = {k: [n for _, n in sorted(v)] for k, v in got.items()}
    assert paths == {(1, 1): [1, 2, 5], (1, 2): [1, 2, 4], (1, 3): [1, 3, 6], (2, 1): [1, 2], (2, 2): [1, 3], (None, 1): [1, 2]}
    assert {(r.conv_id, r.leaf) for r in chat.branches(trees, best=1).collect()} == {(1, 5), (2, 2), (None, 2)}
    assert {r.formatted for r in chat.format_branches(trees, best=1).where("conv_id = 1").collect()} == {"".join(f"### user\nt{n}</turn>\n" for n in (1, 2, 5))}


def test_query(spark, sf_small):
    from cardwatch.llm.queries import op9_chat

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hard = "\\### Assistant: </turn> ok"
    expected = brute([*rows, (-7, 0, "user", hard), (-7, 1, "assistant", hard)])
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in op9_chat(spark, sf_small).collect()} == expected


def test_long_conversation_is_numbered_in_ranges(spark, monkeypatch):
    """A hot conversation, its turns unevenly spread, repeated and null, and one without an id."""
    monkeypatch.setattr(chat, "TOGETHER", 100)
    rows = [(conv, None if k % 50 == 7 else k * k // 3 - k % 2, "user" if k % 2 else None, f"turn {k}") for conv in (1, None) for k in range(3000)]
    rows += [(conv, k, "user", "t") for conv in range(2, 50) for k in range(3)] + [(60, None, "user", f"{k}") for k in range(500)]
    table = spark.createDataFrame([(*r, None, None) for r in rows], KIND)
    sizes = {(r.conv_id, r["range"]): r["count"] for r in chat.with_ranges(table).groupBy("conv_id", "range").count().collect()}
    assert max(n for (c, _), n in sizes.items() if c in (1, None)) < 400
    assert result(table) == brute(rows)


def test_path_is_made_in_many_tasks(spark):
    ranked = spark.createDataFrame([(1, 7, 50_000), (2, 8, 0)], "conv_id long, leaf long, far long")
    spelt = chat.places(ranked).selectExpr("conv_id", "away", "spark_partition_id() AS task").collect()
    assert sorted((r.conv_id, r.away) for r in spelt) == [(1, k) for k in range(50_001)] + [(2, 0)]
    assert len({r.task for r in spelt}) > 1
