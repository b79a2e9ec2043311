"""Attributions and partial dependence of trees against sums over all subsets and against scored copies."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohortforge.operators import explain, learners, trees
from cohortforge.operators.search import read_trees

NAMES = ["f0", "f1", "f2", "f3"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, size=(300, 4)).astype(float)
    y = ((x[:, 0] * x[:, 1] + rng.normal(size=300) * 8 > 30) ^ (x[:, 2] > 9)).astype(float)
    data = [(i, [float(v) for v in x[i]], float(y[i])) for i in range(300)]
    return spark.createDataFrame(data, "id long, x array<double>, label double").withColumn("features", array_to_vector("x")).cache()


def by_subsets(t, x):
    """Shapley values by their definition: a walk that takes both branches of unknown features, by their cover."""
    weight = t.weight if t.boosted else t.weight / len(t.root)

    def walk(node, known):
        if t.left[node] == node:
            return t.value[node]
        f, l, r = t.feature[node], t.left[node], t.right[node]
        if f in known:
            return walk(l if x[f] <= t.threshold[node] else r, known)
        return (t.cover[l] * walk(l, known) + t.cover[r] * walk(r, known)) / t.cover[node]

    d, out = len(x), np.zeros(len(x))
    value = {s: sum(w * walk(r, set(s)) for r, w in zip(t.root, weight)) for n in range(d + 1) for s in itertools.combinations(range(d), n)}
    for j in range(d):
        for s, v in value.items():
            if j not in s:
                out[j] += math.factorial(len(s)) * math.factorial(d - len(s) - 1) / math.factorial(d) * (value[tuple(sorted((*s, j)))] - v)
    return out, value[()]


@pytest.mark.parametrize("name,params", [("decision_tree", {}), ("random_forest", {"numTrees": 5, "maxDepth": 4}), ("gradient_boosting", {"maxIter": 4})])
def test_attributions_are_sums_over_all_subsets(spark, rows, name, params, monkeypatch):
    monkeypatch.setattr(trees, "TOGETHER", 40)
    model = learners.fit_scorer(name, rows, **params).model
    t, boxes = read_trees(model, spark), trees.read_boxes(model, spark)
    x = np.array([r["x"] for r in rows.orderBy("id").limit(25).collect()] + [[float("nan"), 1.0, 2.0, 3.0]])
    got = boxes.attributions(x)
    for line, point in zip(got, x):
        want, base = by_subsets(t, point)
        assert line == pytest.approx(want, abs=1e-9)
        assert boxes.base == pytest.approx(base)
    whole = trees.tree_shapley(rows, boxes, NAMES).groupBy("id").agg(F.sum("attribution").alias("s"), F.count("*").alias("n"))
    if name != "gradient_boosting":  # the others are explained by their probability
        scored = learners.fit_scorer(name, rows, **params)(rows).select("id", "y_prob")
        worst = whole.join(scored, "id").agg(F.max(F.abs(F.col("s") + boxes.base - F.col("y_prob"))), F.count("*"), F.max("n")).first()
        assert worst[0] < 1e-9 and worst[1] == 300 and worst[2] == 4


def test_partial_dependence_equals_scored_copies(spark, rows, monkeypatch):
    monkeypatch.setattr(trees, "TOGETHER", 40)
    score = learners.fit_scorer("random_forest", rows, numTrees=4, maxDepth=5)
    flat = rows.select("id", "label", *[F.col("x")[j].alias(c) for j, c in enumerate(NAMES)])
    grid = {"f1": [0.0, 3.0, 7.5, 11.0], "f3": [2.0]}
    scorer = lambda df: score(df.withColumn("features", array_to_vector(F.array(*NAMES))))
    want = {(r["feature"], r["value"]): r["mean_prediction"] for r in explain.partial_dependence(flat, scorer, list(grid), grid).collect()}
    got = {(r["feature"], r["value"]): r["mean_prediction"] for r in trees.tree_partial_dependence(rows, trees.read_boxes(score.model, spark), NAMES, grid).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_trees_without_splits_and_empty_tables(spark, rows):
    same = rows.withColumn("label", F.lit(1.0))
    flat = trees.read_boxes(learners.fit_scorer("random_forest", same, numTrees=2).model, spark)
    assert flat.base == pytest.approx(1.0)
    assert {r["attribution"] for r in trees.tree_shapley(same, flat, NAMES).collect()} == {0.0}
    assert {r["mean_prediction"] for r in trees.tree_partial_dependence(same, flat, NAMES, {"f0": [1.0, 2.0]}).collect()} == {1.0}
    assert trees.tree_shapley(rows.where("false"), flat, NAMES).count() == 0
    assert trees.tree_partial_dependence(rows.where("false"), flat, NAMES, {"f0": [1.0]}).count() == 0
