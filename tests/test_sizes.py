"""What a task holds is bounded by the task, whatever the tables hold."""

import threading
import tracemalloc

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from cohortforge.operators import cluster, learners, neighbors, reduce, rules, trees


def vectors(spark, n, width, seed):
    rng = np.random.default_rng(seed)
    rows = pd.DataFrame({"id": np.arange(n), "vector": list(rng.normal(size=(n, width)))})
    return spark.createDataFrame(rows, "id long, vector array<double>").repartition(4)


def test_neighbour_tasks_hold_bounded_arrays(spark, monkeypatch):
    rows, asked = vectors(spark, 30_000, 16, 1), vectors(spark, 50, 16, 2)
    seen, real = [], type(rows).mapInPandas
    monkeypatch.setattr(type(rows), "mapInPandas", lambda df, f, schema: seen.append((f, df.columns)) or real(df, f, schema))
    neighbors.knn_join(asked, rows, 5, block_rows=64)
    assert {c for _, columns in seen for c in columns} >= {"rid", "qid", "vec"}
    batch = pd.DataFrame({"rid": np.arange(10_000), "vec": list(np.random.default_rng(3).normal(size=(10_000, 16)))})
    for f, columns in seen:
        tracemalloc.start()
        for _ in f(iter([batch.rename(columns={"rid": columns[0]})])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 200e6, (columns, peak)


def test_neighbours_are_exact_over_cells_blocks_and_copies(spark):
    rng = np.random.default_rng(5)
    x = np.round(np.vstack([rng.normal(size=(900, 20)), 1e4 + rng.normal(scale=1e-3, size=(300, 20)), np.zeros((40, 20))]), 4)
    df = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in enumerate(x)], "id long, vector array<double>")
    odd = spark.createDataFrame([(5000, None), (5001, [float("nan")] * 20)], "id long, vector array<double>")
    got = neighbors.knn_join(df.unionAll(odd), df.unionAll(odd), 4, exclude_self=True, block_rows=300).orderBy("query_id", "rank").toPandas()
    want = []
    for i, v in enumerate(x):
        diff = x - v
        d = np.sqrt((diff * diff).sum(axis=1))
        d[i] = np.inf
        want += [(i, int(j), d[j], r + 1) for r, j in enumerate(np.lexsort((np.arange(len(x)), d))[:4])]
    assert list(got.itertuples(index=False, name=None)) == want


def test_baskets_are_mined_in_bounded_partitions(spark, monkeypatch):
    monkeypatch.setattr(rules, "BASKETS_PER_TASK", 100, raising=False)
    parts, real = [], rules.FPGrowth.fit
    monkeypatch.setattr(rules.FPGrowth, "fit", lambda est, df: parts.append(df.rdd.getNumPartitions()) or real(est, df))
    baskets = spark.range(1000, numPartitions=1).select(F.array(F.concat(F.lit("a"), F.col("id") % 2), F.concat(F.lit("b"), F.col("id") % 5)).alias("items"))
    got = {tuple(r["items"]): r["freq"] for r in rules.frequent_itemsets(baskets, min_support=0.05).collect()}
    assert parts == [10]
    assert got[("a0",)] == 500 and got[("b3",)] == 200 and got[("a1", "b3")] == 100 and len(got) == 17


def test_forests_are_fitted_on_bounded_partitions(spark, monkeypatch):
    rows = spark.range(60_000, numPartitions=1).select("id", (F.col("id") % 2).cast("double").alias("label"), array_to_vector(F.array((F.col("id") % 7).cast("double"))).alias("features"))
    parts = []
    for kind in (RandomForestClassifier, RandomForestRegressor):
        real = kind._fit
        monkeypatch.setattr(kind, "_fit", lambda est, df, real=real: parts.append(df.rdd.getNumPartitions()) or real(est, df))
    few = {"numTrees": 2, "maxDepth": 2}
    learners.fit_scorer("random_forest", rows, **few)
    learners.train_regressor(rows, "random_forest", **few)
    learners.train_classifier(rows.withColumn("x", F.col("id") % 3).drop("features"), ["x"], **few)
    reduce.fit_from_importances(rows, "features", "label", "kept", RandomForestClassifier(**few), 1)
    assert parts == [2, 2, 2, 2]


def two_at_a_time(monkeypatch, module, name):
    """Every call waits for another one at the same time."""
    meet, real = threading.Barrier(2, timeout=60), getattr(module, name)

    def spy(*args, **kw):
        meet.wait()
        return real(*args, **kw)

    monkeypatch.setattr(module, name, spy)


def test_mixtures_are_fitted_side_by_side(spark, monkeypatch):
    two_at_a_time(monkeypatch, cluster, "fit_gmm")
    x = np.random.default_rng(7).normal(size=(200, 2)) + np.repeat([[0, 0], [9, 9]], 100, axis=0)
    df = spark.createDataFrame([(Vectors.dense(v.tolist()),) for v in x], ["features"])
    got = cluster.gmm_bic_aic(df, ks=[2, 3], max_iter=20).orderBy("k").collect()
    assert [r["k"] for r in got] == [2, 3] and [r["n_params"] for r in got] == [11, 17] and got[0]["bic"] < got[1]["bic"]


def test_folds_of_a_neighbour_search_run_side_by_side(spark, monkeypatch):
    two_at_a_time(monkeypatch, learners, "knn_join")
    rows = [(i, i % 2, (i // 2) % 2, Vectors.dense([float(i % 2) * 10 + i / 100, 1.0])) for i in range(40)]
    df = spark.createDataFrame(rows, ["id", "label", "fold", "features"])
    best, out = learners.knn_search(df, {"k": [1, 3]}, scoring="accuracy", scale=False)
    assert best["score"] == 1.0 and {r["params"]: r["mean"] for r in out.collect()} == {"k=1, weights=uniform": 1.0, "k=3, weights=uniform": 1.0}


def test_explained_rows_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(trees, "EXPLAINED_PER_TASK", 100, raising=False)
    rows = spark.range(1000, numPartitions=1).select("id", (F.col("id") % 2).cast("double").alias("label"), array_to_vector(F.array((F.col("id") % 2).cast("double"), F.lit(0.0))).alias("features"))
    boxes = trees.read_boxes(learners.fit_scorer("decision_tree", rows, maxDepth=2).model, spark)
    got = trees.tree_shapley(rows, boxes, ["a", "b"])
    assert got.rdd.getNumPartitions() == 10
    sums = {(r["feature"], r["id"] % 2): r["attribution"] for r in got.collect()}
    assert sums[("a", 1)] == 0.5 and sums[("a", 0)] == -0.5 and sums[("b", 1)] == 0.0 and got.count() == 2000
