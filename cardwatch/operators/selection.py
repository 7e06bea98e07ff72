"""Exact "k smallest rows per group" without a global sort or a one-task window.

``row_number() OVER (PARTITION BY g ORDER BY key) <= k`` is the textbook form, but it sends a
whole group (e.g. the 99.9 % majority class) through one task. Here the threshold is found
by histogram refinement instead:

1. one distributed pass counts rows per (group, key bucket) - ``B`` buckets over the key range,
   map-side combined, so the driver receives at most ``groups x B`` small rows;
2. per group, the bucket holding the k-th row is located from the cumulative counts; every row
   of lower buckets is selected outright, and the key range narrows to that one bucket;
3. repeat on the narrowed range until the boundary bucket holds at most ``exact_limit`` rows,
   which are then ranked exactly (bounded window) by the full ordering.

Keys are non-negative-or-any ``bigint`` columns that are monotone in the full ordering (e.g. a
60-bit hash prefix for a hash order, or the id itself). Equal keys always share a bucket, so the
result is exact. Each pass is one scan of a persisted two-column projection.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 4096
DEFAULT_EXACT_LIMIT = 200_000


def _group_pred(group_col: str | None, g) -> Column:
    if group_col is None:
        return F.lit(True)
    return F.col(group_col).isNull() if g is None else (F.col(group_col) == F.lit(g))


def smallest_k(
    df: DataFrame,
    key_col: str,
    order: Sequence[Column],
    k_of: Callable[[dict], dict],
    group_col: str | None = None,
    buckets: int = DEFAULT_BUCKETS,
    exact_limit: int = DEFAULT_EXACT_LIMIT,
) -> DataFrame:
    """Rows of ``df`` that rank ``<= k_of(counts)[g]`` within their group by ``order``.

    ``key_col`` must be a bigint column monotone in ``order`` (ties in the key are resolved
    by ``order`` in the final exact step). ``k_of`` receives ``{group: row_count}`` and returns
    ``{group: k}``; it runs on the driver over one small dictionary.
    """
    gcol = F.col(group_col) if group_col else F.lit(0)
    slim = df.select(gcol.alias("__g"), F.col(key_col).alias("__k")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stats = {r["__g"]: (r["n"], r["lo"], r["hi"]) for r in
                 slim.groupBy("__g").agg(F.count(F.lit(1)).alias("n"), F.min("__k").alias("lo"),
                                         F.max("__k").alias("hi")).collect()}
        wanted = k_of({g: s[0] for g, s in stats.items()})
        # per group: [lo, hi, need, rows_in_range, done]; rows with key < lo are selected outright
        state = {}
        for g, (n, lo, hi) in stats.items():
            need = int(max(0, min(wanted.get(g, 0), n)))
            state[g] = {"lo": lo, "hi": hi, "need": need, "n": n, "all": need >= n, "none": need == 0}
        active = [g for g, s in state.items() if not (s["all"] or s["none"]) and s["n"] > exact_limit
                  and s["lo"] != s["hi"]]
        while active:
            hist = None
            for g in active:
                s = state[g]
                width = (int(s["hi"]) - int(s["lo"])) // buckets + 1
                part = (slim.where((F.col("__g").eqNullSafe(F.lit(g))) & F.col("__k").between(s["lo"], s["hi"]))
                        .groupBy("__g", F.floor((F.col("__k") - F.lit(s["lo"])) / F.lit(width)).alias("b"))
                        .agg(F.count(F.lit(1)).alias("c"), F.min("__k").alias("mn"), F.max("__k").alias("mx")))
                hist = part if hist is None else hist.unionByName(part)
            rows = hist.collect()  # at most len(active) * buckets rows
            by_group: dict = {}
            for r in rows:
                by_group.setdefault(r["__g"], []).append(r)
            for g in active:
                s = state[g]
                acc = 0
                for r in sorted(by_group[g], key=lambda r: r["b"]):
                    if acc + r["c"] >= s["need"]:
                        s["need"] -= acc
                        s["lo"], s["hi"], s["n"] = r["mn"], r["mx"], r["c"]
                        break
                    acc += r["c"]
            active = [g for g in active if state[g]["n"] > exact_limit and state[g]["lo"] != state[g]["hi"]]
    finally:
        slim.unpersist()

    below = None
    bounds: list[tuple[Column, int]] = []
    for g, s in state.items():
        gp = _group_pred(group_col, g)
        if s["none"]:
            continue
        if s["all"]:
            below = gp if below is None else (below | gp)
            continue
        p_below = gp & (F.col(key_col) < F.lit(s["lo"]))
        below = p_below if below is None else (below | p_below)
        bounds.append((gp & F.col(key_col).between(s["lo"], s["hi"]), s["need"]))
    if not bounds:
        return df.limit(0) if below is None else df.where(below)
    cond = bounds[0][0]
    need_col = F.when(bounds[0][0], F.lit(bounds[0][1]))
    for p, nd in bounds[1:]:
        cond = cond | p
        need_col = need_col.when(p, F.lit(nd))
    # Each group's boundary holds at most ``exact_limit`` rows (unless one key value alone is
    # larger, which a hash key or a de-duplicated id rules out) and is ranked by itself; rows below it need no rank and
    # are dealt out by a hash, so that ``df`` is evaluated once for both.
    below = F.lit(False) if below is None else F.coalesce(below, F.lit(False))
    cond = F.coalesce(cond, F.lit(False))
    dealt = F.when(cond, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(key_col), F.lit(1 << 20)))
    w = Window.partitionBy(gcol, "__deal").orderBy(*order)
    kept = df.where(below | cond).withColumn("__deal", dealt).withColumn("__rn", F.row_number().over(w))
    return kept.where((F.col("__deal") > 0) | (F.col("__rn") <= need_col)).drop("__deal", "__rn")


def hash_key(c: Column, salt: str = "") -> Column:
    """60-bit non-negative bigint prefix of ``md5(salt || c)``; monotone in the md5 hex order."""
    h = F.md5(F.concat(F.lit(salt), c.cast("string")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def hash_order(c: Column, salt: str = "") -> Column:
    return F.md5(F.concat(F.lit(salt), c.cast("string")))
