"""Searches that share fits, and out-of-fold tables that a run goes on with."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import toy

from cohortforge.operators import folds, learners, search


@pytest.fixture(scope="module")
def rows(spark):
    return learners.compact(toy(spark), 400)


@pytest.mark.parametrize("model,grid", [
    ("decision_tree", {"maxDepth": [1, 2, 4, 30], "minInstancesPerNode": [1, 10]}),
    ("gradient_boosting", {"maxIter": [1, 3], "maxDepth": [2]}),
])
def test_prefixes_of_one_fit_equal_separate_fits(spark, rows, model, grid):
    train, held = rows.where("fold > 0"), rows.where("fold = 0").orderBy("id")
    settings = search.settings_of(grid)
    shared = search.shared_fits(model, settings)
    assert sorted(i for _, places in shared for i in places) == list(range(len(settings))) and len(shared) < len(settings)
    x = np.array([r["features"].toArray() for r in held.collect()])
    for params, places in shared:
        trees = search.read_trees(learners.make_classifier(model, 400, **params).fit(train), spark)
        got = trees.probabilities(x, [settings[i] for i in places])
        for line, i in zip(got, places):
            own = learners.make_classifier(model, 400, **settings[i]).fit(train).transform(held)
            assert np.allclose(line, [r["probability"][1] for r in own.collect()], atol=1e-12), settings[i]


def test_a_sub_forest_is_the_mean_of_its_trees(spark, rows):
    model = learners.make_classifier("random_forest", 400, numTrees=6, maxDepth=4).fit(rows)
    x = np.array([r["features"].toArray() for r in rows.limit(50).collect()])
    trees = search.read_trees(model, spark)
    whole = trees.probabilities(x, [{"numTrees": 6, "maxDepth": 4}, {"numTrees": 2, "maxDepth": 4}])
    assert np.allclose(whole[0], [model.predictProbability(r["features"])[1] for r in rows.limit(50).collect()])
    two = np.mean([[t.predictProbability(r["features"])[1] for r in rows.limit(50).collect()] for t in model.trees[:2]], axis=0)
    assert np.allclose(whole[1], two)


@pytest.mark.parametrize("counts,want", [((3, 1, 5, 1), (0.75, 0.75, 0.75, 0.8)), ((0, 0, 4, 0), (0, 0, 0, 1)), ((0, 0, 0, 0), (0, 0, 0, 0))])
def test_measures(counts, want):
    assert [search.measure(counts, s) for s in ("f1", "precision", "recall", "accuracy")] == pytest.approx(list(want))
    with pytest.raises(ValueError):
        search.measure(counts, "beauty")


def test_scores_by_area(spark):
    scored = spark.createDataFrame([(0, 1, 0.9, 2), (0, 0, 0.2, 3), (0, 0, 0.95, 1), (1, 1, 0.5, 1), (1, 0, 0.5, 1)], "setting int, y_true int, y_prob double, n long")
    assert search.scores_of(scored, 2, "roc_auc") == pytest.approx([0.75, 0.5])


def test_a_killed_run_goes_on_with_what_is_missing(spark, rows, tmp_path, monkeypatch):
    store, real, fitted = str(tmp_path / "oof"), learners.fit_fold_steps, []

    def dies(name, *args, **kw):
        if len(fitted) == 2:
            raise KeyboardInterrupt
        fitted.append(name)
        return real(name, *args, **kw)

    monkeypatch.setattr(learners, "fit_fold_steps", dies)
    with pytest.raises(KeyboardInterrupt):
        learners.run_cv(rows, ["one_r", "zero_r"], parallelism=1, store=store)
    again = []
    monkeypatch.setattr(learners, "fit_fold_steps", lambda name, *a, **kw: again.append(name) or real(name, *a, **kw))
    got = learners.run_cv(rows, ["one_r", "zero_r"], parallelism=1, store=store)
    assert len(again) == 4 and got.count() == 800
    want = learners.run_cv(rows, ["one_r", "zero_r"])
    assert got.exceptAll(want.select(got.columns)).isEmpty()
    assert len(again) == 10


def test_nested_run_goes_on(spark, tmp_path, monkeypatch):
    df = folds.nested_folds(toy(spark, 120).drop("fold"), "label", ["id"], 3, 2)
    grid, store = {"decision_tree": {"maxDepth": [1, 3]}}, str(tmp_path / "nested")
    oof, chosen = learners.nested_cv(df, ["decision_tree", "zero_r"], grid, store=store)
    assert oof.count() == 120 and chosen.count() == 3
    first = sorted(tuple(r) for r in oof.collect())
    monkeypatch.setattr(learners, "make_classifier", lambda *a, **kw: pytest.fail("fitted again"))
    oof, _ = learners.nested_cv(df, ["decision_tree"], grid, store=store)
    assert sorted(tuple(r) for r in oof.collect()) == first
    with pytest.raises(ValueError):
        learners.nested_cv(df, ["zero_r"])


def test_search_result(spark, rows):
    found, table = learners.grid_search(rows, "sgd_classifier", {"regParam": [1e-4, 10.0]}, scoring="roc_auc")
    assert table.agg(F.count("*")).first()[0] == 2
    assert found.means[found.best] == max(found.means) > 0.7
    assert found.bestModel.coefficients.size == 3


def test_forests_keep_the_nodes_of_rows_and_grow_the_same_trees(rows):
    kept = learners.make_classifier("random_forest", 400, numTrees=5)
    walked = learners.make_classifier("random_forest", 400, numTrees=5, cacheNodeIds=False)
    assert kept.getCacheNodeIds() and kept.getMaxDepth() == 30
    shown = [m.fit(rows).toDebugString.split("\n", 1)[1] for m in (kept, walked)]
    assert shown[0] == shown[1]


def test_linear_fits_read_few_partitions(spark, rows, monkeypatch):
    spread_out, seen = rows.repartition(6).cache(), []
    real = learners.make_classifier

    def spy(name, *args, **kw):
        est = real(name, *args, **kw)
        fit = est.fit
        est.fit = lambda df: seen.append((name, df.rdd.getNumPartitions())) or fit(df)
        return est

    monkeypatch.setattr(learners, "make_classifier", spy)
    monkeypatch.setattr(learners, "compact", lambda df, n: df)
    found, _ = learners.grid_search(spread_out, "logistic_regression", {"C": [0.1, 1.0]})
    assert found.bestModel.coefficients.size == 3
    learners.fit_fold_steps("sgd_classifier", spread_out)
    learners.fit_fold_steps("decision_tree", spread_out)
    assert {n for _, n in seen[:-1]} == {1} and seen[-1] == ("decision_tree", 6)
    monkeypatch.setattr(learners, "NUMBERS_PER_TASK", 400)  # 3 numbers a row
    assert learners.gathered(spread_out, 400, "features").rdd.getNumPartitions() == 3
    assert learners.gathered(spread_out.where("false"), 0, "features").count() == 0
