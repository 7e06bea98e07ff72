import functools
import hashlib
import itertools
import random
import re
import sys
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardwatch.llm import turn_repair
from cardwatch.llm.turn_repair import BLANK, CUT, DUPLICATE, FINE, GROUPS, INSERT, TO_END, Paths, _edits, damage, digests, repair, solve

sys.setrecursionlimit(20_000)  # best() goes down a frame for each edit
SCHEMA = "conv_id long, turn long, role string, text string"
ROLE = {"u": "user", "a": "assistant"}


def every_way(rows):
    """All edits with at most two inserts between rows: (cost, audit, roles kept), by brute force."""
    gaps = ["", "u", "a", "ua", "au"]
    ops = []
    for initial, fault in rows:
        more = 3 if fault == CUT else 0
        ops.append([("D", 4, "")] + ([] if fault in (BLANK, DUPLICATE) else [("K", more, initial), ("R", 3 + more, "u"), ("R", 3 + more, "a")]))
    for chosen in itertools.product(*ops):
        for inserts in itertools.product(gaps, repeat=len(rows) + 1):
            roles = inserts[0] + "".join(c[2] + i for c, i in zip(chosen, inserts[1:], strict=True))
            if re.fullmatch(r"(s?(ua)+)?", roles):
                audit = "I" * len(inserts[0]) + "".join(c[0] + "I" * len(i) for c, i in zip(chosen, inserts[1:], strict=True))
                yield sum(c[1] for c in chosen) + 3 * sum(map(len, inserts)), audit


def best(rows):
    """(cost, audit) from the end: costs of the rests, then the least letter that stays cheapest."""
    def ends(state):
        return [(0, "")] if state in (0, 3) else []

    @functools.cache
    def rest(at, state, inserted=0):
        found = ends(state) if at == len(rows) else []
        fill = "a" if state == 2 else "u"
        after = 3 if state == 2 else 2
        if inserted < 2:
            c, a = rest(at, after, inserted + 1)
            found.append((c + 3, "I" + a))
        if at < len(rows):
            initial, fault = rows[at]
            c, a = rest(at + 1, state)
            found.append((c + 4, "D" + a))
            if fault in (FINE, CUT):
                more = 3 if fault == CUT else 0
                c, a = rest(at + 1, after)
                found.append((c + 3 + more, "R" + a))
                if initial == fill or initial == "s" and state == 0:
                    c, a = rest(at + 1, 1 if initial == "s" else after)
                    found.append((c + more, "K" + a))
        return min(found, default=(10 ** 9, "~"))

    return rest(0, 0)


def solved(rows):
    found = [(c + INSERT * TO_END[e], "".join(GROUPS[x] for x in g) + "I" * TO_END[e]) for s, e, c, g in solve(rows, range(1))] if rows else [(0, "")]
    return min(found)


row = st.tuples(st.sampled_from("suaux"), st.sampled_from([FINE, FINE, FINE, BLANK, DUPLICATE, CUT]))


@settings(max_examples=60, deadline=None)
@given(st.lists(row, max_size=4))
def test_against_all_edits(rows):
    assert solved(rows) == min(every_way(rows)) == best(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(row, max_size=60))
def test_against_the_rests(rows):
    assert solved(rows) == best(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("xs"), max_size=40))
def test_ties(letters):
    """Rows that fit nowhere: many paths of one cost."""
    rows = [(i, FINE) for i in letters]
    assert solved(rows) == best(rows)


@pytest.mark.parametrize("base", [0, 1, 2, None])
def test_paths_compare_like_lists(base):
    """Also with bases under which unequal paths share hashes."""
    paths, rng = Paths(), random.Random(3)
    if base is not None:
        paths.BASE = base
    level, known = [0], {0: []}
    for _ in range(40):
        parents = rng.sample(level, min(len(level), 6))
        level = [paths.add(p, x) for p in parents for x in rng.sample(range(4), 2)]
        for n in level:
            known[n] = [*known[paths.up[n][0]], paths.letter[n]]
            assert paths.letters(n) == known[n]
        for a, b in itertools.product(level, level):
            order = paths.compare(a, b)
            assert ((order > 0) - (order < 0)) == ((known[a] > known[b]) - (known[a] < known[b]))


def audit_of(damaged):
    """(faults, cost, audit, repaired) of a conversation's rows (turn, role, text)."""
    rows = sorted(damaged, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        ink = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append(BLANK if not ink else DUPLICATE if (role, text) in seen else CUT if ink[-1] not in ".!?" else FINE)
        if ink:
            seen.add((role, text))
    cost, audit = best([(role[:1], f) for (_, role, _), f in zip(rows, faults, strict=True)])
    left, out, state = iter(rows), [], 0
    for letter in audit:
        fill = "assistant" if state == 2 else "user"
        _, role, text = (None, fill, "") if letter == "I" else next(left)
        if letter == "D":
            continue
        role = fill if letter == "R" else role
        out.append(f"{role}:{text}")
        state = {"s": 1, "u": 2, "a": 3}[role[0]]
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost, audit), out


def damaged_rows(turns):
    for conv, turn, role, text in turns:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        for _ in range((h != 0) + (h == 3)):
            yield conv, turn, "user" if h == 4 else role, text


def compare(spark, turns, schema=SCHEMA, extra=()):
    table = spark.createDataFrame(turns, schema).selectExpr("*", *extra)
    hurt = [*damaged_rows(turns)]
    got = damage(table).collect()
    assert sorted(map(repr, ((r.conv_id, r.turn, r.role, r.text) for r in got))) == sorted(map(repr, hurt))
    audits, repaired = repair(damage(table))
    found = {r.conv_id: tuple(r)[1:] for r in audits.collect()}
    texts = {}
    for r in sorted(repaired.collect(), key=lambda r: (r.at, r.place)):
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    hashes = {r.conv_id: r.repaired_sha256 for r in digests(repaired).collect()}
    convs = {}
    for conv, *rest in hurt:
        convs.setdefault(conv, []).append(rest)
    assert {*found} == {*convs}
    for conv, rows in convs.items():
        expected, out = audit_of(rows)
        assert found[conv] == expected
        assert texts.get(conv, []) == out
        assert hashes.get(conv) == (hashlib.sha256("\n".join(out).encode()).hexdigest() if out else None)


def made(rng, convs, most):
    say = ["Yes.", "No!", "Why", "", " \n", "ok?", "ok? \t", "long " * 50 + ".", "x", None, "é."]
    turns = []
    for conv in range(convs):
        for t in range(rng.randrange(most)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            turns.append((conv, rng.choice([t, t, t, t + 3, None]), role, rng.choice(say)))
    return turns


def test_made_conversations(spark):
    rng = random.Random(5)
    turns = made(rng, 60, 14)
    turns += [(None, *t[1:]) for t in turns[:7]] + turns[:5]  # a null id, repeated rows
    rng.shuffle(turns)
    compare(spark, turns, extra=("1 AS at", "2 AS block", "3 AS own", "4 AS edits", "5 AS h"))


def test_blocks_meet(spark, monkeypatch):
    """Blocks of three rows give what one block gives; the workers get the constant with the functions."""
    monkeypatch.setattr(turn_repair, "BLOCK", 3)
    compare(spark, made(random.Random(6), 25, 25))


def test_one_conversation_on_all_rows(spark):
    rng = random.Random(7)
    compare(spark, [(9, t, rng.choice(["user", "assistant", "user", "assistant", "tool"]), rng.choice(["a.", "b.", "c", ""]) + str(rng.randrange(3000)) + rng.choice(".!,"))
                    for t in range(400)])


def test_long_conversation_in_ranges(spark, monkeypatch):
    from cardwatch.llm import chat

    monkeypatch.setattr(chat, "TOGETHER", 50)
    monkeypatch.setattr(turn_repair, "BLOCK", 16)
    rng = random.Random(8)
    compare(spark, [(1, rng.choice([None, t]), rng.choice(["user", "assistant"]), f"t {rng.randrange(90)}.") for t in range(300)] + made(rng, 4, 9))


def test_edits_spell_the_repair():
    assert _edits([("x", FINE), ("u", FINE), ("s", FINE)], 0, [GROUPS.index("R"), GROUPS.index("IK"), GROUPS.index("D")]) == ["U", "ak", "d"]


def test_all_rows_dropped_and_empty_table(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    for rows in ([], [(dropped, 0, "user", "Hi.")]):
        audits, repaired = repair(damage(spark.createDataFrame(rows, SCHEMA)))
        assert audits.collect() == [] and digests(repaired).collect() == []


def test_query_lists_every_conversation(spark, scratch):
    from cardwatch.llm.queries import op12_turn_repair

    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(dropped, 0, "user", "Hi."), (None, None, None, None)], SCHEMA).write.parquet(f"{scratch}/conversations.parquet")
    rows = {r.conv_id: tuple(r)[1:] for r in op12_turn_repair(spark, scratch).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert rows[dropped] == (0, 0, 0, 0, 0, 0, "", nothing)
    assert rows[None] == (0, 1, 0, 0, 0, 4, "D", nothing)
