"""Key-unique rows without windows over hot keys.

``first_per_key`` keeps, for every key, the row that is smallest in a given order. It is a
``groupBy(key).agg(min(struct(order..., rest...)))``: the aggregate is combined map-side, so a
key that holds a third of all rows still ships at most one row per input partition to the
shuffle. A ``row_number()`` window would pull every copy of the hot key into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, ties broken by all remaining columns.

    Fully deterministic, whatever the partitioning or retry history.
    """
    keys = list(keys)
    columns = df.columns
    rest = [c for c in columns if c not in keys]
    if not rest and not order:
        return df.select(*keys).distinct()
    if all(isinstance(o, str) for o in order):
        # Built as SQL text: a handful of planner calls however wide the row is.
        fields = [f"'__o{i}', {_q(o)}" for i, o in enumerate(order)] + [f"{_lit(c)}, {_q(c)}" for c in rest]
        packed = F.expr(f"min(named_struct({', '.join(fields)}))")
    else:
        packed = F.min(F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"__o{i}")
                                  for i, o in enumerate(order)], *[F.col(c) for c in rest]))
    return df.groupBy(*keys).agg(packed.alias("__row")).selectExpr(
        *[_q(c) if c in keys else f"__row.{_q(c)} AS {_q(c)}" for c in columns])


def first_of_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """``first_per_key`` where few keys repeat: a hash count finds those, and only their rows are packed and sorted.

    Rows of other keys pass through an anti join with the (usually small, then broadcast) repeated keys."""
    keys = list(keys)
    again = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(
        *[F.col(k).alias(f"__again_{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__again_{i}"))
    once = df.join(again, same, "left_anti")
    return once.unionByName(first_per_key(df.join(again, same, "left_semi"), keys, order))


def insert_if_absent(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                     order: Sequence[str | Column] = ()) -> DataFrame:
    """Rows of ``incoming`` to append to ``target`` with "first row wins" on key conflicts.

    Duplicate keys inside ``incoming`` keep their first row by ``order``; keys already present
    in ``target`` are skipped (a left-anti join, so neither side is collected).
    """
    fresh = first_per_key(incoming, keys, order)
    return fresh.join(target.select(*keys), list(keys), "left_anti")
