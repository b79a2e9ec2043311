"""Trees grown from counts of binned rows against those of Spark ML."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import toy

from __spark_entry__ import queries
from cohortforge.operators import folds, grown, learners


@pytest.fixture(scope="module")
def rows(spark):
    return learners.compact(toy(spark), 400)


def probabilities(trees, rows):
    got = grown.score_trees(trees, rows, "features").select("id", "y_prob").collect()
    return {r["id"]: r["y_prob"] for r in got}


@pytest.mark.parametrize("model,params", [
    ("decision_tree", {"impurity": "gini", "minInstancesPerNode": 1}),
    ("decision_tree", {"impurity": "entropy", "minInstancesPerNode": 7}),
    ("decision_tree", {"maxDepth": 2}),
    ("gradient_boosting", {"maxIter": 12, "maxDepth": 3, "stepSize": 0.2}),
    ("gradient_boosting", {"maxIter": 5, "maxDepth": 6, "stepSize": 0.1}),
])
def test_trees_equal_those_of_spark(spark, rows, model, params, monkeypatch):
    train, held = rows.where("fold > 0"), rows.where("fold = 0")
    want = {r["id"]: r["probability"][1] for r in learners.make_classifier(model, 400, **params).fit(train).transform(rows).collect()}
    for at_once in (grown.AT_ONCE, 500):  # in one go, and a few nodes at a time
        monkeypatch.setattr(grown, "AT_ONCE", at_once)
        got = probabilities(grown.fit_trees(train, model, params, "features", "label"), rows)
        assert got.keys() == want.keys()
        assert [got[i] for i in want] == pytest.approx(list(want.values()), abs=1e-9)
    settings = [params]
    scored = grown.search_cells(train, held, model, settings, "features", "label", "roc_auc", 400)
    said = sorted((r["y_prob"], r["y_true"]) for r in scored.collect() for _ in range(r["n"]))
    own = sorted((want[r["id"]], r["label"]) for r in held.collect())
    assert np.allclose([p for p, _ in said], [p for p, _ in own], atol=1e-9) and sum(y for _, y in said) == sum(y for _, y in own)


def test_thresholds_with_a_hot_value_and_many_values():
    assert grown.thresholds(np.array([1.0, 2.0, 4.0]), np.array([1.0, 1.0, 1.0]), 32).tolist() == [1.5, 3.0]
    assert grown.thresholds(np.array([5.0]), np.array([9.0]), 32).tolist() == []
    even = grown.thresholds(np.arange(64.0), np.ones(64), 32)
    assert even.tolist() == [2 * i + 1.5 for i in range(31)]
    hot = grown.thresholds(np.arange(40.0), np.array([1.0] * 39 + [1000.0]), 32)
    assert len(hot) <= 31 and (np.diff(hot) > 0).all()


def test_cells_count_every_row(spark, rows):
    train, held = rows.where("fold > 0"), rows.where("fold = 0")
    got = grown.cells(train, held, grown.bin_edges(train, "features"), "features", "label").agg(F.sum("w"), F.sum("h")).first()
    assert tuple(got) == (train.count(), held.count())


@pytest.mark.parametrize("model,grid", [
    ("decision_tree", {"maxDepth": [1, 3, 30], "minInstancesPerNode": [1, 10], "impurity": ["gini", "entropy"]}),
    ("gradient_boosting", {"maxIter": [1, 4], "maxDepth": [2], "stepSize": [0.1, 0.3]}),
])
def test_search_is_the_same_whether_spark_fits_or_tasks_do(spark, rows, monkeypatch, model, grid):
    scoring = "roc_auc" if model == "gradient_boosting" else "f1"
    here, _ = learners.grid_search(rows, model, grid, scoring=scoring)
    monkeypatch.setattr(grown, "HELD_NUMBERS", 0)
    there, _ = learners.grid_search(rows, model, grid, scoring=scoring)
    assert here.settings == there.settings
    assert here.means == pytest.approx(there.means, abs=1e-9) and here.deviations == pytest.approx(there.deviations, abs=1e-9)


@pytest.mark.parametrize("model,grid", [("decision_tree", {"maxDepth": [1, 30]}), ("gradient_boosting", {"maxIter": [2, 5], "stepSize": [0.1]})])
def test_nested_tables_are_the_same_too(spark, monkeypatch, model, grid):
    df = folds.nested_folds(toy(spark, 150).drop("fold"), "label", ["id"], 3, 2).cache()
    oof, chosen = learners.nested_cv(df, [model], {model: grid})
    here, best = {r["id"]: tuple(r) for r in oof.collect()}, sorted(chosen.collect())
    monkeypatch.setattr(grown, "HELD_NUMBERS", 0)
    oof, chosen = learners.nested_cv(df, [model], {model: grid})
    there = {r["id"]: tuple(r) for r in oof.collect()}
    assert len(here) == 150 and here.keys() == there.keys() and best == sorted(chosen.collect())
    assert all(here[i][:-1] == there[i][:-1] and here[i][-1] == pytest.approx(there[i][-1], abs=1e-9) for i in here)


@pytest.mark.parametrize("weight", [False, True])
def test_out_of_fold_boosting_is_that_of_spark(spark, rows, monkeypatch, weight):
    """Weights are such that their sums are exact in any order; else ties of two splits fall either way."""
    params = {"gradient_boosting": {"maxIter": 6, "maxDepth": 4}}
    monkeypatch.setattr(learners, "weight_column", lambda counts, label: F.when(F.col(label) == 1, 2.0).otherwise(0.5))
    imbalance = "class_weight" if weight else "none"
    here = {r["id"]: r for r in learners.run_cv(rows, ["gradient_boosting"], imbalance=imbalance, params=params, failed="raise").collect()}
    monkeypatch.setattr(grown, "HELD_NUMBERS", 0)
    there = {r["id"]: r for r in learners.run_cv(rows, ["gradient_boosting"], imbalance=imbalance, params=params, failed="raise").collect()}
    assert len(here) == 400 and here.keys() == there.keys()
    assert [here[i]["y_prob"] for i in there] == pytest.approx([r["y_prob"] for r in there.values()], abs=1e-9)
    assert all(here[i]["y_pred"] == r["y_pred"] for i, r in there.items())


def test_run_cv_does_not_fit_boosting_with_spark(spark, rows, monkeypatch):
    monkeypatch.setattr(learners, "make_classifier", lambda *a, **kw: pytest.fail("fitted one after another"))
    assert learners.run_cv(rows, ["gradient_boosting"], params={"gradient_boosting": {"maxIter": 2}}, failed="raise").count() == 400


def test_unknown_settings_and_large_tables_are_left_to_spark():
    assert grown.fits_here("decision_tree", [{"maxDepth": 3}], 2_000_000, 4)
    assert not grown.fits_here("decision_tree", [{"maxDepth": 3}], 2_000_001, 4)
    assert not grown.fits_here("decision_tree", [{"maxBins": 64}], 10, 1)
    assert not grown.fits_here("random_forest", [{"maxDepth": 3}], 10, 1)


def test_one_class_and_no_rows(spark, rows):
    same = rows.withColumn("label", F.lit(1))
    assert set(probabilities(grown.fit_trees(same, "decision_tree", {}, "features", "label"), same).values()) == {1.0}
    with pytest.raises(ValueError, match="no training rows"):
        grown.fit_trees(rows.where("false"), "decision_tree", {}, "features", "label")
    with pytest.raises(Exception, match="two classes"):
        grown.fit_trees(rows.withColumn("label", F.lit(2)), "gradient_boosting", {"maxIter": 2}, "features", "label")


def test_nested_cv_searches_every_model_but_the_forest(monkeypatch, spark, data):
    seen, real = [], learners.nested_cv

    def spy(df, models, *args, **kw):
        seen.extend(models)
        small = {m: {k: v[:1] for k, v in learners.GRIDS[m].items()} for m in ("decision_tree", "gradient_boosting")}
        return real(df, [{"gradient_boosting": "gradient_boosting"}.get(m, "decision_tree") for m in models][:1], small)

    monkeypatch.setattr(learners, "nested_cv", spy)
    out = queries()["nested_cv"](spark, data)
    assert sorted(seen) == sorted(set(learners.GRIDS) - {"random_forest"})
    assert {r["model"] for r in out.select("model").distinct().collect()} == {"decision_tree", "gradient_boosting"}
