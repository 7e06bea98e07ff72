"""Chat formatting of reply trees.

``branches`` enumerates the paths from root to leaf of every conversation by iterated self-joins. Each round doubles
the reach of every message's pointer to its ancestors, so a tree of depth d takes about log2(d) joins, and keys are
(conversation, message), so no conversation is a hot key. A branch's score is the mean score of its messages; branches
are ranked by it (ties: the smaller leaf). ``format_branches`` writes each chosen branch as one conversation.

Template: for each turn ``### role``, a newline, the text and ``</turn>`` and a newline. In a text, the control strings
``###`` and ``</turn>`` get a backslash; backslashes right before one, or at the end, are doubled. In a role, backslashes
and newlines are escaped. So a control string marks a turn exactly if an even number of backslashes is before it, and
``read_turns`` gives back every role and text. The loss mask covers the texts of the assistant, without ``</turn>``.

A formatted conversation comes in parts of whole turns (about ``PART`` characters), in order; nearly all have one part.
Turns of one conversation are written in order by one task as a stream, so memory is bounded by a part. A long
conversation is numbered in ranges of turns and its path made in blocks, so both run in many tasks.

Null role or text counts as empty. A null or unknown parent makes a root; messages on a cycle of parents have no root
and are in no branch. Repeated (conversation, message) keys must not occur in ``branches``; ``chain`` numbers rows by
(turn, role, text), nulls last, so there repeated rows are turns of their own. A null conv_id is a conversation too.
An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm.common import need, shuffle_width, small_batches, stage

START, END = "###", "</turn>"
CONTROL = re.compile(rf"(\\*)({START}|{END}|\Z)")
ESCAPED = re.compile(rf"(\\+)({START}|{END}|\Z)")
TURN = re.compile(rf"{START} ([^\n]*)\n(.*?)(?<!\\)((?:\\\\)*){END}\n", re.S)
PART = 1 << 20
#: Rows of a conversation that are numbered together (more if the table has over ``RANGES`` times as many), and turns of
#: a path that are spelt out together.
TOGETHER, RANGES, BLOCK = 4096, 1024, 4096


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[1] * 2 + ("\\" + m[2] if m[2] else ""), text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], text)


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text begins and ends."""
    head = f"{START} " + role.replace("\\", "\\\\").replace("\n", "\\n") + "\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        role = re.sub(r"\\(.)", lambda x: "\n" if x[1] == "n" else x[1], m[1])
        out.append((role, unescape(m[2] + m[3])))
        at = m.end()
    return out


def with_ranges(turns: DataFrame) -> DataFrame:
    """Add ``range`` and ``before`` to (conv_id, turn, ...): a conversation of over ``TOGETHER`` rows is cut into ranges of
    turns of about equal counts, at most ``RANGES`` on the table; ``before`` counts its rows in the ranges before."""
    same = F.expr("c <=> conv_id")
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    # the largest conversations; each is of over a share of all rows, so there are at most RANGES
    least = max(TOGETHER, -(-turns.count() // RANGES))
    big = stage(counts.where(F.col("n") > least).select(F.col("conv_id").alias("c"), "n"), "long")
    if big.isEmpty():
        return turns.withColumns({"range": F.lit(0), "before": F.lit(0).cast("long")})
    cuts = big.agg(F.max("n")).first()[0] // least  # at most RANGES
    most = [k / (cuts + 1) for k in range(1, cuts + 1)]
    bounds = turns.join(F.broadcast(big), same).groupBy("c").agg(F.percentile_approx("turn", most).alias("ends")).withColumn("ends", F.array_distinct("ends"))
    bounds = stage(bounds, "ends")
    # nulls come last
    at = "IF(turn IS NULL, IF(ends IS NULL, 0, size(ends)), size(filter(ends, e -> e < turn)))"
    dealt = turns.join(F.broadcast(bounds), same, "left").withColumn("range", F.expr(f"coalesce({at}, 0)")).drop("c", "ends")
    long = bounds.select("c")
    of = dealt.join(F.broadcast(long), same, "left_semi").groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = of.select(F.col("conv_id").alias("c"), F.col("range").alias("r"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return dealt.join(F.broadcast(starts), F.expr("c <=> conv_id AND r = range"), "left").drop("c", "r").withColumn("before", F.expr("coalesce(before, 0L)"))


def chain(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as trees without branches: each row replies to the one before it."""
    need(turns, "conv_id", "turn", "role", "text")
    order = Window.partitionBy("conv_id", "range").orderBy(F.asc_nulls_last("turn"), F.asc_nulls_last("role"), F.asc_nulls_last("text"))
    rows = with_ranges(turns.select("conv_id", "turn", "role", "text"))
    return rows.select("conv_id", (F.col("before") + F.row_number().over(order)).cast("long").alias("node"), "role", "text").selectExpr(
        "conv_id", "node", "nullif(node - 1, 0L) AS parent", "0D AS score", "role", "text")


def places(ranked: DataFrame) -> DataFrame:
    """A row for each distance ``away`` from 0 to ``far``: blocks are dealt to tasks before they are spelt out."""
    blocks = ranked.withColumn("block", F.explode(F.expr(f"sequence(0L, far DIV {BLOCK})")))
    dealt = blocks.repartition(shuffle_width(ranked.sparkSession), "conv_id", "leaf", "block")
    return dealt.withColumn("away", F.explode(F.expr(f"sequence(block * {BLOCK}, least(far, block * {BLOCK} + {BLOCK - 1}))"))).drop("block")


def branches(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """Paths from root to leaf: (conv_id, leaf, rank, position, node), for the ``best`` branches or all.

    ``nodes``: conv_id, node (long), parent (long), score (double).
    """
    need(nodes, "conv_id", "node", "parent", "score")
    own = nodes.selectExpr("conv_id", "node", "parent", "coalesce(score, 0D) AS score")
    same = lambda a, b: F.expr(f"{a}.conv_id <=> {b}.conv_id AND {a}.up = {b}.node")
    known = own.selectExpr("conv_id", "node").alias("k")
    # up: the ancestor reached; far: steps to it; total: scores of the messages passed
    jump = stage(own.alias("n").join(known, F.expr("n.conv_id <=> k.conv_id AND n.parent = k.node"), "left").selectExpr(
        "n.conv_id", "n.node", "k.node AS up", "n.score AS total", "IF(k.node IS NULL, 0L, 1L) AS far"), "jump")
    jumps = [jump]
    limit = max(1, jump.count()).bit_length() + 1
    while len(jumps) <= limit and not jumps[-1].where("up IS NOT NULL").isEmpty():
        last = jumps[-1]
        jumps.append(stage(last.alias("a").join(last.alias("b"), same("a", "b"), "left").selectExpr(
            "a.conv_id", "a.node", "b.up AS up", "a.total + coalesce(b.total, 0D) AS total", "a.far + coalesce(b.far, 0L) AS far"), "jump"))
    rooted = jumps[-1].where("up IS NULL")
    parents = jumps[0].where("up IS NOT NULL").selectExpr("conv_id AS c", "up AS p").distinct()
    leaves = rooted.join(parents, F.expr("conv_id <=> c AND node = p"), "left_anti").selectExpr("conv_id", "node AS leaf", "far", "total / (far + 1) AS score")
    ranks = Window.partitionBy("conv_id").orderBy(F.desc("score"), "leaf")
    ranked = leaves.withColumn("rank", F.row_number().over(ranks))
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    # every message of a path is its leaf's ancestor at some distance: add up jumps by the distance's bits
    path = places(ranked.select("conv_id", "leaf", "rank", F.col("leaf").alias("up"), "far"))
    for bit, j in enumerate(jumps[:-1]):
        on = F.expr(f"x.conv_id <=> j.conv_id AND x.up = j.node AND (away >> {bit}) & 1 = 1")
        step = path.alias("x").join(j.select("conv_id", "node", F.col("up").alias("to")).alias("j"), on, "left")
        path = step.selectExpr("x.conv_id", "leaf", "rank", "coalesce(to, x.up) AS up", "far", "away")  # one use of path: two would double the plan each round
    return path.selectExpr("conv_id", "leaf", "rank", "far - away AS position", "up AS node")


def format_branches(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """Chosen branches as conversations: (conv_id, leaf, rank, part, formatted, loss), ``loss`` being spans [start, end)."""
    need(nodes, "conv_id", "node", "role", "text")
    small_batches(nodes.sparkSession)
    texts = nodes.select("conv_id", "node", "role", "text").alias("t")
    turns = branches(nodes, best).alias("b").join(texts, F.expr("b.conv_id <=> t.conv_id AND b.node = t.node")).selectExpr(
        "b.conv_id", "leaf", "rank", "position", "coalesce(role, '') AS role", "coalesce(text, '') AS text")
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*turns.schema.fields[:3], T.StructField("part", T.IntegerType()), T.StructField("formatted", T.StringType()), T.StructField("loss", span)])
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part, size = None, 0, 0
        pieces: list[str] = []
        loss: list[dict] = []
        kinds: list[pa.DataType] = []
        rows: list[tuple] = []

        def end() -> None:
            rows.append((*key, part, "".join(pieces), list(loss)))
            pieces.clear()
            loss.clear()

        def packed() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, [*kinds, pa.int32(), pa.string(), spans], strict=True)], names=schema.fieldNames())

        for batch in batches:
            kinds = [batch.column(i).type for i in range(3)]
            for *now, _, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if pieces and (now != key or size > PART):
                    end()
                    part, size = (part + 1 if now == key else 0), 0
                key = now
                turn, a, b = write_turn(role, text)
                if role == "assistant":
                    loss.append({"start": size + a, "end": size + b})
                pieces.append(turn)
                size += len(turn)
            if sum(len(r[4]) for r in rows) > PART:
                yield packed()
        if pieces:
            end()
        if rows:
            yield packed()

    order = ("conv_id", "leaf", "position")
    return turns.repartition(shuffle_width(nodes.sparkSession), "conv_id", "leaf").sortWithinPartitions(*order).mapInArrow(run, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """Read conversations back: (conv_id, leaf, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)."""
    need(formatted, "conv_id", "leaf", "part", "formatted", "loss")
    head = [formatted.schema["conv_id"], formatted.schema["leaf"]]
    rest = [("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()), ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType())]
    schema = T.StructType([*head, *(T.StructField(n, t) for n, t in rest)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, turns, masked = None, hashlib.sha256(), hashlib.sha256()
        n = loss_chars = chars = 0
        kinds: list[pa.DataType] = []
        rows: list[tuple] = []

        def packed() -> pa.RecordBatch:
            types = [*kinds, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*rows, strict=True)
            made = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=schema.fieldNames())
            rows.clear()
            return made

        for batch in batches:
            kinds = [batch.column(i).type for i in range(2)]
            for conv, leaf, _, formatted_, loss in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (conv, leaf) != key:
                    if key:
                        rows.append((*key, n, turns.hexdigest(), loss_chars, masked.hexdigest(), chars))
                    key, turns, masked = (conv, leaf), hashlib.sha256(), hashlib.sha256()
                    n = loss_chars = chars = 0
                for role, text in read_turns(formatted_):
                    turns.update(f"{role}\n{text}\n".encode())
                    n += 1
                for span in loss:
                    text = unescape(formatted_[span["start"]:span["end"]])
                    masked.update(text.encode())
                    loss_chars += len(text)
                chars += len(formatted_)
            if len(rows) > 1000:
                yield packed()
        if key:
            rows.append((*key, n, turns.hexdigest(), loss_chars, masked.hexdigest(), chars))
            yield packed()

    # parts come in order: they are dealt as they were written
    dealt = formatted.select("conv_id", "leaf", "part", "formatted", "loss").repartition(shuffle_width(formatted.sparkSession), "conv_id", "leaf")
    return dealt.sortWithinPartitions("conv_id", "leaf", "part").mapInArrow(run, schema)
