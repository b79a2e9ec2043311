"""Queries call their operators at full size: grids, folds, models, iterations and forests as the operators define them."""

import inspect
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.linalg import Matrices, Vectors

from __spark_entry__ import queries
from cohortforge.operators import cluster, learners, reduce


class Seen(Exception):
    """Carries the arguments of a call that need not be carried out."""


def call_of(monkeypatch, module, name, spark, data, key):
    """Arguments, defaults filled in, with which a query first calls an operator."""
    signature = inspect.signature(getattr(module, name))

    def spy(*args, **kw):
        bound = signature.bind(*args, **kw)
        bound.apply_defaults()
        raise Seen(bound.arguments)

    monkeypatch.setattr(module, name, spy)
    with pytest.raises(Seen) as seen:
        queries()[key](spark, data)
    return seen.value.args[0]


def n_folds(df, fold="fold"):
    return df.select(fold).distinct().count()


@pytest.mark.parametrize("key", ["run_cv", "cross_validate"])
def test_cv_takes_all_models_and_ten_folds(monkeypatch, spark, data, key):
    got = call_of(monkeypatch, learners, "run_cv", spark, data, key)
    assert tuple(got["models"]) == learners.CLASSIFIERS and n_folds(got["df"]) == 10


@pytest.mark.parametrize("key", ["grid_search", "knn_search"])
def test_searches_take_the_whole_grid_and_ten_folds(monkeypatch, spark, data, key):
    got = call_of(monkeypatch, learners, key, spark, data, key)
    assert got["grid"] in (None, learners.GRIDS["knn" if key == "knn_search" else got["model"]])
    assert n_folds(got["df"]) == 10


@pytest.mark.parametrize("key,models", [("nested_cv", {"logistic_regression", "decision_tree", "knn", "sgd_classifier"}), ("nested_cv_forest", {"random_forest"})])
def test_nested_cv_searches_whole_grids_over_ten_by_five_folds(monkeypatch, spark, data, key, models):
    got = call_of(monkeypatch, learners, "nested_cv", spark, data, key)
    assert got["grids"] in (None, learners.GRIDS) and models == set(got["models"])
    inner = got["df"].selectExpr("outer_fold", "explode(inner_fold) as f").where("f is not null")
    assert n_folds(got["df"], "outer_fold") == 10 and n_folds(inner, "f") == 5


def test_importances_and_rules_come_from_the_registered_forest(monkeypatch, spark, data):
    full = learners.make_classifier("random_forest", 1)
    own = reduce.default_importance_estimator()
    assert (own.getNumTrees(), own.getMaxDepth()) == (full.getNumTrees(), full.getMaxDepth())
    got = call_of(monkeypatch, learners, "fit_scorer", spark, data, "forest_top_rules")
    assert got["name"] == "random_forest" and not got.get("params")


@pytest.mark.parametrize("key", ["gmm", "kmeans_gmm_agreement", "gmm_bic_aic"])
def test_mixtures_take_the_whole_range_and_all_iterations(monkeypatch, spark, data, key):
    name = "gmm_bic_aic" if key == "gmm_bic_aic" else "fit_gmm"
    got = call_of(monkeypatch, cluster, name, spark, data, key)
    assert got["max_iter"] == 200 and len(got["df"].first()["features"]) == 50
    assert list(got.get("ks", range(2, 11))) == list(range(2, 11))


def test_likelihood_of_a_singular_component(spark):
    cov = np.ones((2, 2))
    part = {"mean": Vectors.dense([0.0, 0.0]), "cov": Matrices.dense(2, 2, cov.ravel().tolist())}
    model = SimpleNamespace(weights=[1.0], gaussiansDF=SimpleNamespace(collect=lambda: [part]))
    x = np.array([[1.0, 1.0], [0.5, 0.5], [-2.0, -2.0]])
    df = spark.createDataFrame([(Vectors.dense(r.tolist()),) for r in x], ["features"])
    full = cov + 1e-6 * np.eye(2)
    want = sum(-0.5 * (r @ np.linalg.inv(full) @ r + np.log(np.linalg.det(full)) + 2 * np.log(2 * np.pi)) for r in x)
    assert cluster.gmm_log_likelihood(model, df) == pytest.approx(want, rel=1e-6)
