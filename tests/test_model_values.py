"""Scores of the fitted variants against their trees, read from the saved model and evaluated node by node."""

import glob
import math

import pytest
from pyspark.ml.functions import vector_to_array

from cardwatch.plans import keys as K
from cardwatch.plans import models


def trees(spark, path):
    """The saved model's trees: {tree: {node id: node}}, and the trees' weights."""
    stage = sorted(glob.glob(f"{path}/stages/2_*"))[0]
    nodes = {}
    for r in spark.read.parquet(stage + "/data").collect():
        nodes.setdefault(r.treeID, {})[r.nodeData.id] = r.nodeData
    weights = {r[0]: r[2] for r in spark.read.parquet(stage + "/treesMetadata").collect()}
    return nodes, weights


def leaf(tree, x):
    node = tree[0]
    while node.leftChild >= 0:
        s = node.split
        value = x[s.featureIndex]
        left = value <= s.leftCategoriesOrThreshold[0] if s.numCategories == -1 else value in s.leftCategoriesOrThreshold
        node = tree[node.leftChild if left else node.rightChild]
    return node


def probability(nodes, weights, learner, x):
    """Probability of class 1: votes by the leaves' class shares (forest), or the logistic of twice the margin (boosting)."""
    found = {t: leaf(tree, x) for t, tree in nodes.items()}
    if learner == "gbt":
        return 1 / (1 + math.exp(-2 * sum(weights[t] * n.prediction for t, n in found.items())))
    votes = [0.0, 0.0]
    for n in found.values():
        for c in (0, 1):
            votes[c] += n.impurityStats[c] / sum(n.impurityStats)
    return votes[1] / sum(votes)


@pytest.mark.parametrize("name", sorted(models.VARIANTS))
def test_scores_are_the_trees(spark, scratch, sf_small, name):
    variant = models.VARIANTS[name]
    data = models.prepared(K.silver(spark, sf_small), name)
    model, scored = models.fit(data, name)
    models.save(model, scratch + "/m")
    nodes, weights = trees(spark, scratch + "/m")
    params = variant.params
    assert len(nodes) == params.get("numTrees", params.get("maxIter")) and all(len(t) < 2 ** (params.get("maxDepth", 5) + 1) for t in nodes.values())
    rows = scored.select(vector_to_array("features").alias("x"), "fraud_probability", "label_pred").collect()
    assert rows
    for r in rows:
        p = probability(nodes, weights, variant.learner, r.x)
        assert math.isclose(p, r.fraud_probability, rel_tol=1e-9, abs_tol=1e-12)
        assert r.label_pred == float(p > 0.5) or math.isclose(p, 0.5, abs_tol=1e-9)
