"""Conversation structure repair by a persistent audit DP.

Rows of a conversation are edited at least cost until their role initials read ``(s?(ua)+)?``. Edits: Keep costs 0,
Rerole to user or assistant 3, Delete 4, Insert of an empty user or assistant row 3; blank rows and duplicates must be
deleted, and a truncated row that stays adds 3. Of the cheapest edits those are taken whose initials are ASCII-least.

The initials read so far have one of four states: nothing, s, ...u, ...a; a state says which role an inserted or
reroled row gets. Edits are grouped by row: the inserts before it and then what happens to it. No such group begins
another, so groups compare like the strings they stand for, and a path's place in the order is settled by its first
different group. Paths are linked nodes that share their prefixes (``Paths``); each node knows its ancestors at
distances of powers of two and a rolling hash of its prefix. Ties of cost are settled by a search for the longest common
prefix over these; equal hashes are then verified group by group.

A conversation may be as long as the table, so it is cut into blocks of ``BLOCK`` rows that are solved apart, for each
state at the block's start. A block's up to 16 results are ranked as strings; over the blocks of a conversation the same
DP runs with these ranks as letters. The chosen results' edits go back to the rows. Memory is that of a block's paths
and, for each conversation, of a node for each state and block.

Defined results: null conv_id is a conversation of its own; null role or text is one space (``damage``, ``repair``);
null turns come first; rows of one turn are ordered by role, then text (null first), then are alike. A blank text has
no character other than ``[\\x20\\x09-\\x0D]``; a duplicate has role and text of an earlier row that isn't blank (named by
SHA-256); truncated means that the last such character isn't one of ``.!?``. A role counts by its first character, an
empty role fits nowhere. An empty table gives empty tables; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cardwatch.llm.chat import with_ranges
from cardwatch.llm.common import need, shuffle_width, small_batches, stage

#: Rows of a conversation that are solved together.
BLOCK = 1024
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after s, after u, after a. What a row of each role leads to, where it may stand.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The role that an inserted or reroled row gets in each state, and how many inserts reach an end from there.
FILLS, TO_END = ("user", "user", "assistant", "user"), (0, 2, 1, 0)
#: Groups of edits for one row, in ASCII order. More than two inserts in a row come back to a state at a cost.
GROUPS = sorted("I" * k + op for k in range(3) for op in "DKR")
FINE, BLANK, DUPLICATE, CUT = range(4)
WHITE, INK = r"[\\x20\\x09-\\x0D]", r"[^\\x20\\x09-\\x0D]"


def _moves(initial: str, fault: int) -> list[list[tuple[int, int, int]]]:
    """For each state: (next state, cost, group), the least group for each next state and cost."""
    out = []
    for state in range(4):
        best: dict[int, tuple[int, int]] = {}
        at, cost = state, 0
        for inserts in range(3):
            ends = [(at, DELETE, "D")]
            if fault in (FINE, CUT):
                more = TRUNCATED if fault == CUT else 0
                ends.append((NEXT[at][FILLS[at][0]], REROLE + more, "R"))
                if initial in NEXT[at]:
                    ends.append((NEXT[at][initial], more, "K"))
            for to, own, op in ends:
                found = (cost + own, GROUPS.index("I" * inserts + op))
                best[to] = min(best.get(to, found), found)
            at, cost = NEXT[at][FILLS[at][0]], cost + INSERT
        out.append([(to, cost, group) for to, (cost, group) in best.items()])
    return out


#: By initial (any other: empty) and fault.
MOVES = {(i, f): _moves(i, f) for i in ("s", "u", "a", "") for f in range(4)}


class Paths:
    """Sequences of letters that share their prefixes. A path is the number of its last node; 0 is the empty one."""

    PRIME, BASE = (1 << 61) - 1, 0x1B873593_CC9E2D51 % ((1 << 61) - 1)

    def __init__(self) -> None:
        self.letter, self.up, self.hash = [-1], [()], [0]

    def add(self, parent: int, letter: int) -> int:
        """The path ``parent`` with one more letter."""
        up = [parent]
        while len(up) <= len(self.up[up[-1]]):
            up.append(self.up[up[-1]][len(up) - 1])
        self.letter.append(letter)
        self.up.append(tuple(up))
        self.hash.append((self.hash[parent] * self.BASE + letter + 1) % self.PRIME)
        return len(self.letter) - 1

    def letters(self, path: int) -> list[int]:
        out = []
        while path:
            out.append(self.letter[path])
            path = self.up[path][0]
        return out[::-1]

    def compare(self, a: int, b: int) -> int:
        """Order of two paths of one length: below, equal to or above 0."""
        if a == b:
            return 0
        x, y, hashes = a, b, self.hash
        if hashes[a] != hashes[b]:  # up to just behind the longest common prefix
            for k in range(len(self.up[x]) - 1, -1, -1):
                if k < len(self.up[x]):
                    p, q = self.up[x][k], self.up[y][k]
                    if hashes[p] != hashes[q]:
                        x, y = p, q
            if self._same(self.up[x][0], self.up[y][0]) and self.letter[x] != self.letter[y]:
                return self.letter[x] - self.letter[y]
        elif self._same(a, b):
            return 0
        one, two = self.letters(a), self.letters(b)  # unequal prefixes had equal hashes
        return (one > two) - (one < two)

    def _same(self, a: int, b: int) -> bool:
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True


Ends = dict[int, tuple[int, int]]


def step(paths: Paths, ends: Ends, moves: list[list[tuple[int, int, int]]]) -> Ends:
    """From (cost, path) of each state to those one letter on: the cheapest of each state, ties by the least path."""
    out: dict[int, tuple[int, int, int]] = {}
    for state, (cost, path) in ends.items():
        for to, more, letter in moves[state]:
            old = out.get(to)
            if old is not None and old[0] == cost + more:
                order = paths.compare(path, old[1])
                if order > 0 or order == 0 and letter >= old[2]:
                    continue
            elif old is not None and old[0] < cost + more:
                continue
            out[to] = (cost + more, path, letter)
    return {to: (cost, paths.add(path, letter)) for to, (cost, path, letter) in out.items()}


def solve(rows: list[tuple[str, int]], starts: range) -> list[tuple[int, int, int, list[int]]]:
    """(start, end, cost, groups) of a block's rows (initial, fault) for every pair of states that it can join."""
    found = []
    for start in starts:
        paths, ends = Paths(), {start: (0, 0)}
        for initial, fault in rows:
            ends = step(paths, ends, MOVES[initial if initial in "sua" else "", fault])
        found += [(start, end, cost, paths.letters(path)) for end, (cost, path) in ends.items()]
    return found


def _edits(rows: list[tuple[str, int]], state: int, groups: list[int]) -> list[str]:
    """What becomes of each row: u, a for an inserted role, then U, A (rerole), k (keep) or d (delete)."""
    out = []
    for (initial, _), group in zip(rows, groups, strict=True):
        made = ""
        for op in GROUPS[group]:
            role = initial if op == "K" else FILLS[state][0]
            made += {"I": role, "R": role.upper(), "K": "k", "D": "d"}[op]
            state = state if op == "D" else NEXT[state][role]
        out.append(made)
    return out


BLOCKS = """conv_id {kind}, block long, n long, first string, last string, pairs long, blank long, duplicate long, truncated long,
    ways array<struct<start: int, stop: int, cost: long, rank: int, audit: string, edits: array<string>>>"""


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _solve_blocks(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, block, at, initial, fault), in order -> one row for each block."""
    schema = T._parse_datatype_string(BLOCKS.format(kind=rows.schema["conv_id"].dataType.simpleString()))
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def block(key: tuple, found: list[tuple[str, int]]) -> dict:
        ways = solve(found, range(1) if key[1] == 0 else range(4))
        ranks = {a: k for k, a in enumerate(sorted({tuple(w[3]) for w in ways}))}
        faults = [f for _, f in found]
        return {"conv_id": key[0], "block": key[1], "n": len(found), "first": found[0][0], "last": found[-1][0],
                "pairs": sum(not _legal(a, b) for (a, _), (b, _) in itertools.pairwise(found)),
                "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT),
                "ways": [{"start": s, "stop": e, "cost": c, "rank": ranks[tuple(g)],
                          "audit": "".join(GROUPS[x] for x in g), "edits": _edits(found, s, g)} for s, e, c, g in ways]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, out, size = None, [], [], 0
        for batch in batches:
            for key, initial, fault in zip(zip(*(batch.column(c).to_pylist() for c in ("conv_id", "block")), strict=True),
                                           batch.column("initial").to_pylist(), batch.column("fault").to_pylist(), strict=True):
                if key != last and held:
                    out.append(block(last, held))
                    size += len(held)
                    held = []
                    if size > 8 * BLOCK:
                        yield pa.RecordBatch.from_pylist(out, arrow)
                        out, size = [], 0
                last = key
                held.append((initial, fault))
        if held:
            out.append(block(last, held))
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    return rows.select("conv_id", "block", "initial", "fault").mapInArrow(run, schema)


def _choose(blocks: DataFrame) -> DataFrame:
    """Blocks in order -> rows for each block (start, stop: its states) and, with null block, for each conversation."""
    kind = blocks.schema["conv_id"].dataType
    schema = T._parse_datatype_string("conv_id {kind}, block long, start int, stop int, cost long, pairs long".format(kind=kind.simpleString()))
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, paths, ends, pairs, numbers, last = None, None, None, 0, [], ""

        def close() -> None:
            def better(a: int, b: int) -> bool:
                one, two = (ends[s][0] + INSERT * TO_END[s] for s in (a, b))
                return one < two or one == two and paths.compare(ends[a][1], ends[b][1]) < 0

            stop = next(iter(ends))
            for state in ends:
                if better(state, stop):
                    stop = state
            out.append((conv, None, None, stop, ends[stop][0] + INSERT * TO_END[stop], pairs))
            state = 0
            for number, letter in zip(numbers, paths.letters(ends[stop][1]), strict=True):
                # a letter is a rank and the state behind the block
                out.append((conv, number, state, letter & 3, None, None))
                state = letter & 3

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

        for batch in batches:
            for conv_id, block, first, final, inner, ways in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "block", "first", "last", "pairs", "ways")), strict=True):
                if paths is None or conv_id != conv:
                    if paths is not None:
                        close()
                    conv, paths, ends, pairs, numbers = conv_id, Paths(), {0: (0, 0)}, 0, []
                pairs += inner + (bool(numbers) and not _legal(last, first))
                last = final
                numbers.append(block)
                moves: list[list] = [[], [], [], []]
                for w in ways:
                    moves[w["start"]].append((w["stop"], w["cost"], w["rank"] << 2 | w["stop"]))
                ends = step(paths, ends, moves)
            if len(out) > 5000:
                yield packed()
                out.clear()
        if paths is not None:
            close()
        if out:
            yield packed()

    return blocks.select("conv_id", "block", "first", "last", "pairs", "ways").mapInArrow(run, schema)


def damage(turns: DataFrame) -> DataFrame:
    """Damage rows (conv_id, turn, role, text) by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text,
    2 takes out its ``.!?``, 3 repeats it, 4 makes it the user's. Null is one space, in the checksum and in role and text."""
    need(turns, "conv_id", "turn", "role", "text")
    name = "concat(coalesce(CAST(conv_id AS STRING), ' '), ':', coalesce(CAST(turn AS STRING), ' '))"
    return turns.selectExpr("conv_id", "turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text", f"crc32(CAST({name} AS BINARY)) % 20 AS h").where("h <> 0").selectExpr(
        "conv_id", "turn", "IF(h = 4, 'user', role) AS role",
        "CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '') ELSE text END AS text",
        "explode(IF(h = 3, array(0, 1), array(0))) AS again").drop("again")


def numbered(turns: DataFrame) -> DataFrame:
    """Stored rows (conv_id, turn, role, text, at, initial, content, blank, cut); ``at`` counts from 0 in each conversation."""
    need(turns, "conv_id", "turn", "role", "text")
    rows = turns.selectExpr("conv_id", "CAST(turn AS BIGINT) AS own", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text")
    # ranges are cut by a number that is never null; null and the least number share the first range
    keyed = with_ranges(rows.withColumn("turn", F.coalesce("own", F.lit(-(1 << 63)))))
    order = Window.partitionBy("conv_id", "range").orderBy(F.asc_nulls_first("own"), "role", "text")
    placed = keyed.withColumn("at", F.expr("CAST(before - 1 AS BIGINT)") + F.row_number().over(order))
    return stage(placed.selectExpr(
        "conv_id", "own AS turn", "role", "text", "at", "substring(role, 1, 1) AS initial",
        "unhex(sha2(concat(CAST(char_length(role) AS STRING), ':', role, text), 256)) AS content",
        f"NOT text RLIKE '{INK}' AS blank", f"NOT text RLIKE '[.!?]{WHITE}*\\\\z' AS cut"), "turns")


def _faults(rows: DataFrame) -> DataFrame:
    """(conv_id, block, at, initial, fault) of numbered rows."""
    # first places of what a conversation holds more than once; minima are combined before the shuffle
    firsts = rows.where("NOT blank").groupBy("conv_id", "content").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = stage(firsts.selectExpr("conv_id AS c", "content AS k", "first"), "firsts")
    met = rows.select("conv_id", "at", "initial", "content", "blank", "cut").join(firsts, F.expr("conv_id <=> c AND content = k"), "left")
    fault = f"CASE WHEN blank THEN {BLANK} WHEN at > first THEN {DUPLICATE} WHEN cut THEN {CUT} ELSE {FINE} END AS fault"
    return met.selectExpr("conv_id", f"at DIV {BLOCK} AS block", "at", "initial", fault)


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, turn, role, text) -> their audits and the repaired rows.

    Audits: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit; one for each conversation that has rows.
    Repaired: conv_id, at, place, role, text; a conversation's rows are in order of ``at``, then ``place``.
    """
    small_batches(turns.sparkSession)
    rows = numbered(turns)
    faults = _faults(rows).repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "at")
    blocks = stage(_solve_blocks(faults), "blocks")
    light = blocks.withColumn("ways", F.expr("transform(ways, w -> named_struct('start', w.start, 'stop', w.stop, 'cost', w.cost, 'rank', w.rank))"))
    chosen = stage(_choose(light.repartition("conv_id").sortWithinPartitions("conv_id", "block")), "chosen")

    ways = chosen.where("block IS NOT NULL").selectExpr("conv_id AS c", "block AS b", "start", "stop")
    taken = blocks.join(ways, F.expr("conv_id <=> c AND block = b")).withColumn("way", F.expr("filter(ways, w -> w.start = start AND w.stop = stop)[0]"))
    pieces = taken.selectExpr("conv_id", "block", "way.audit AS audit", "way.edits AS edits")
    sums = blocks.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in ("n", "blank", "duplicate", "truncated")))
    texts = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "audit"))).alias("parts"))
    turn = rows.groupBy("conv_id", "turn").count().groupBy("conv_id").agg(
        F.expr("coalesce(max(turn) - min(turn) + 1 - count(turn), 0L)").alias("gaps"))
    whole = chosen.where("block IS NULL").selectExpr("conv_id", "stop", "cost", "pairs AS illegal")
    for other in (sums, texts, turn):
        mine = other.withColumnRenamed("conv_id", "c")
        whole = whole.join(mine, F.expr("conv_id <=> c")).drop("c")
    tail = f"element_at(array({', '.join(map(str, TO_END))}), stop + 1)"
    audits = whole.selectExpr("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                              f"concat(array_join(transform(parts, p -> p.audit), ''), repeat('I', {tail})) AS audit")

    its = pieces.selectExpr("conv_id AS c", "block", "edits")
    edited = rows.join(its, F.expr(f"conv_id <=> c AND at DIV {BLOCK} = block")).selectExpr(
        "conv_id", "at", "role", "text", f"posexplode(split(edits[CAST(at % {BLOCK} AS INT)], '')) AS (place, edit)").where("edit <> 'd'")
    kept = edited.selectExpr(
        "conv_id", "at", "place", "CASE lower(edit) WHEN 'u' THEN 'user' WHEN 'a' THEN 'assistant' ELSE role END AS role",
        "IF(edit IN ('u', 'a'), '', text) AS text")
    ends = whole.where(f"{tail} > 0").selectExpr(
        "conv_id", "n AS at", "posexplode(IF(stop = 1, array('user', 'assistant'), array('assistant'))) AS (place, role)", "'' AS text")
    return audits, kept.unionByName(ends)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of repaired rows: ``role:text``, joined by newlines. A conversation is hashed as a stream."""
    schema = T.StructType([repaired.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    kind = to_arrow_type(schema["conv_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, out = None, None, []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], kind), pa.array([h for _, h in out], pa.string())], names=schema.fieldNames())

        for batch in batches:
            for c, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "role", "text")), strict=True):
                if state is None or c != conv:
                    if state is not None:
                        out.append((conv, state.hexdigest()))
                    conv, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if len(out) > 5000:
                yield packed()
                out.clear()
        if state is not None:
            out.append((conv, state.hexdigest()))
        if out:
            yield packed()

    dealt = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "at", "place")
    return dealt.select("conv_id", "role", "text").mapInArrow(run, schema)
