"""How five filters of a corpus interact, in every order of applying them, by folds in SQL.

Each document has a mask of the filters it fails. Documents are counted by part, mask and labels; these counts are
the cells, at most 128 for a part however many documents it has. A cell is folded over the array of all orders (120
strings, part of the plan): ``transform`` runs over the orders and ``aggregate`` over an order's steps, which gives 600
structs weighted by the cell's count. The structs of a part's cells are summed element by element.

Whether a text repeats one of a smaller id is decided for each distinct text, named by its SHA-256, so no text is
shuffled and a text on a third of all rows is one row for each task and id.

Filters (a document fails): A under 100 words; B 100 * distinct words < 80 * words; C 100 * ``[A-Z]`` characters > 10 *
code points; D holds any of ``#$%&*|``; E is identical to the text of any smaller id. Words are maximal runs of
characters other than ``[\\x20\\x09-\\x0D]``, with case. Null text counts as empty and is identical to other empty
texts; a null id is never smaller nor larger than another; rows that repeat id and text don't repeat each other.
Null lang is the part of the empty string. Several labels of an id count as one if any of them is set. Whole texts are
read. An empty table has no parts and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import need

FILTERS = "ABCDE"
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
BLANK = r"[\\x20\\x09-\\x0D]"

#: Bit k is set if the k-th of the first four filters rejects the text; ``words`` is bound once.
OWN_MASK = f"""element_at(transform(array(filter(split(t, '{BLANK}+'), w -> w <> '')), words ->
    IF(size(words) < 100, 1, 0)
  + IF(100L * size(array_distinct(words)) < 80L * size(words), 2, 0)
  + IF(100L * (char_length(t) - char_length(regexp_replace(t, '[A-Z]', ''))) > 10L * char_length(t), 4, 0)
  + IF(t RLIKE '[#$%&*|]', 8, 0)), 1)"""


def orders() -> list[str]:
    return ["".join(p) for p in itertools.permutations(FILTERS)]


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents counted by the filters they fail and by their labels."""
    need(docs, "doc_id", "text", "lang")
    need(labels, "doc_id", "quality", "toxic")
    read = docs.selectExpr("doc_id", "coalesce(lang, '') AS part", "coalesce(text, '') AS t")
    rows = read.selectExpr("doc_id", "part", "unhex(sha2(t, 256)) AS content", f"{OWN_MASK} AS own")
    one = rows.groupBy("doc_id", "part", "content", "own").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.groupBy(F.col("doc_id").alias("its_id")).agg(
        F.max(F.expr("coalesce(quality = 1, false)")).alias("good"), F.max(F.expr("coalesce(toxic = 1, false)")).alias("toxic"))
    marked = one.join(marks, F.col("doc_id") == F.col("its_id"), "left").withColumns(
        {"good": F.expr("coalesce(good, false)"), "toxic": F.expr("coalesce(toxic, false)")})
    # rows of a text by part and labels: all of them, those without an id, and those of the smallest id
    known = "FILTER (WHERE doc_id IS NOT NULL)"
    groups = marked.groupBy("content", "part", "own", "good", "toxic").agg(
        F.sum("n").alias("n"), F.expr("coalesce(sum(n) FILTER (WHERE doc_id IS NULL), 0L)").alias("no_id"),
        F.min("doc_id").alias("least"), F.expr(f"min_by(n, doc_id) {known}").alias("at_least"))
    first = F.min("least").over(Window.partitionBy("content"))
    split = groups.withColumn("first", first).withColumn("firsts", F.expr("no_id + IF(least = first, at_least, 0L)"))
    kinds = F.expr("array(struct(own AS mask, firsts AS n), struct(own + 16 AS mask, n - firsts AS n))")
    both = split.select("part", "good", "toxic", F.inline(kinds))
    return both.where("n > 0").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def _fold() -> str:
    """SQL: the 600 structs of one cell."""
    fails = "getbit(mask, ascii(substr(o, k, 1)) - 65) = 1"
    others = "mask <> shiftleft(1, ascii(substr(o, k, 1)) - 65)"
    when = {
        "kept": f"NOT s.gone AND NOT ({fails})", "removed": f"NOT s.gone AND {fails}", "redundant": f"s.gone AND {fails}",
        "unique_fails": f"{fails} AND NOT ({others})", "good_lost": f"NOT s.gone AND {fails} AND good", "toxic_lost": f"NOT s.gone AND {fails} AND toxic"}
    step = ", ".join(f"'{m}', IF({when[m]}, n, 0L)" for m in MEASURES)
    kinds = ", ".join(f"{m}: bigint" for m in MEASURES)
    empty = f"CAST(array() AS array<struct<filter_order: string, step: int, {kinds}>>)"
    walk = (f"aggregate(sequence(1, 5), named_struct('gone', false, 'steps', {empty}), (s, k) -> named_struct('gone', s.gone OR {fails}, "
            f"'steps', concat(s.steps, array(named_struct('filter_order', o, 'step', k, {step})))), s -> s.steps)")
    return f"flatten(transform(array({', '.join(repr(o) for o in orders())}), o -> {walk}))"


def audit(counted: DataFrame) -> DataFrame:
    """600 rows for each part of ``counted`` (as ``cells`` gives it): filter_order, step and the measures."""
    need(counted, "part", "mask", "good", "toxic", "n")
    folded = counted.select("part", F.expr(_fold()).alias("steps"))
    sums = ", ".join(f"'{m}', x.{m} + y.{m}" for m in MEASURES)
    add = f"(a, b) -> zip_with(a, b, (x, y) -> named_struct('filter_order', x.filter_order, 'step', x.step, {sums}))"
    # at most 128 cells for each part
    merged = folded.groupBy("part").agg(F.collect_list("steps").alias("all")).withColumn("steps", F.expr(f"aggregate(slice(all, 2, size(all)), all[0], {add})"))
    rows = merged.select("part", F.inline("steps"))
    same = Window.partitionBy("part", F.expr("substr(filter_order, step, 1)"))
    return rows.withColumn("shapley", F.sum("removed").over(same))
