"""Connected components of an edge table, all in joins and grouped minima.

Each step hooks trees onto the smallest label any member sees and halves the paths to the roots; labels are
written to shared files after each step. Minima are combined before the shuffle, so a vertex with very many
edges is no hot key there, and joins on it may be split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import stage


def components(edges: DataFrame, small: bool = False) -> DataFrame:
    """``a``, ``b`` (long) -> one row per vertex: ``node``, ``component`` (its smallest vertex).

    Null ends, loops and repeated edges are allowed and mean nothing; no edges give no rows. ``small``: the caller has
    counted the vertices, and a label for each may be broadcast; then only the minima are shuffled.
    """
    hint = F.broadcast if small else (lambda df: df)
    both = edges.where("a <> b").selectExpr("explode(array(struct(a AS src, b AS dst), struct(b AS src, a AS dst))) AS e").select("e.*")
    both = stage(both, "edges")
    labels = stage(both.groupBy("src").agg(F.min("dst").alias("m")).selectExpr("src AS node", "least(src, m) AS f"), "labels")
    while True:
        # a vertex offers what it and its neighbours see (the parents' parents) to itself and to its parent
        up = labels.alias("x").join(hint(labels.selectExpr("node AS f", "f AS g")), "f").select("node", "f", "g")
        seen = both.join(hint(up.selectExpr("node AS dst", "g AS low")), "dst").join(hint(labels.selectExpr("node AS src", "f")), "src")
        offers = seen.selectExpr("explode(array(struct(src AS node, low, f AS old), struct(f AS node, low, CAST(NULL AS BIGINT) AS old))) AS o").select("o.*")
        offers = offers.unionByName(up.selectExpr("node", "g AS low", "f AS old")).unionByName(up.selectExpr("f AS node", "g AS low", "CAST(NULL AS BIGINT) AS old"))
        step = stage(offers.groupBy("node").agg(F.min("low").alias("low"), F.max("old").alias("old")), "labels")
        labels = step.selectExpr("node", "low AS f")
        if step.where("low <> old").isEmpty():
            return labels.selectExpr("node", "f AS component")


def merged(labels: DataFrame | None, links: DataFrame, small: bool = False) -> DataFrame:
    """``labels`` (node, component; None: no links yet) after further links ``a``, ``b``. Only the components that these
    links join are worked on again."""
    if labels is None:
        return components(links, small)
    hint = F.broadcast if small else (lambda df: df)
    ends = links
    for end in ("a", "b"):
        ends = ends.join(hint(labels.selectExpr(f"node AS {end}", f"component AS of_{end}")), end, "left")
    grown = components(ends.selectExpr("coalesce(of_a, a) AS a", "coalesce(of_b, b) AS b"), small)
    old = labels.join(hint(grown.selectExpr("node AS component", "component AS now")), "component", "left").selectExpr("node", "coalesce(now, component) AS component")
    return stage(old.unionByName(grown.join(hint(labels.select("node")), "node", "left_anti")), "labels")
