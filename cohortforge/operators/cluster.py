"""Segmentation: k-means, mixtures, divisive hierarchy and their quality tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, spread
from .profile import min_cluster_fraction

K_RANGE = range(2, 11)


def fit_kmeans(df: DataFrame, k: int = 3, features: str = "features", seed: int = 42, max_iter: int = 100):
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster", maxIter=max_iter).fit(df)


def kmeans_labels(df: DataFrame, k: int = 3, features: str = "features", seed: int = 42) -> DataFrame:
    return fit_kmeans(df, k, features, seed).transform(df)


def silhouette(df: DataFrame, features: str = "features", cluster: str = "cluster") -> float:
    """Mean silhouette with squared Euclidean distance: linear in the rows, from per-cluster sums."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster, metricName="silhouette").evaluate(df)


def elbow(df: DataFrame, ks: Sequence[int] = K_RANGE, features: str = "features", seed: int = 42) -> DataFrame:
    """(k, inertia)."""
    rows = [(int(k), float(fit_kmeans(df, k, features, seed).summary.trainingCost)) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def silhouette_by_k(df: DataFrame, ks: Sequence[int] = K_RANGE, features: str = "features", seed: int = 42,
                    floor: float = 0.01) -> DataFrame:
    """(k, silhouette, min_fraction, is_best); degenerate clusterings have no silhouette."""
    rows = []
    for k in ks:
        labeled = kmeans_labels(df, k, features, seed)
        shape = min_cluster_fraction(labeled, "cluster", floor).first()
        score = None if shape["is_degenerate"] else float(silhouette(labeled, features))
        rows.append((int(k), score, float(shape["min_fraction"])))
    best = max((r for r in rows if r[1] is not None), key=lambda r: r[1], default=(None,))[0]
    return df.sparkSession.createDataFrame(
        [(*r, int(r[0] == best)) for r in rows], "k int, silhouette double, min_fraction double, is_best int"
    )


def fit_gmm(df: DataFrame, k: int, features: str = "features", seed: int = 42, max_iter: int = 200):
    return GaussianMixture(k=k, seed=seed, featuresCol=features, predictionCol="cluster", maxIter=max_iter).fit(df)


def gmm_labels(model, df: DataFrame) -> DataFrame:
    """Labels with the probability of the chosen component."""
    return model.transform(df).withColumn("confidence", F.array_max(vector_to_array("probability")))


def gmm_profile(model, df: DataFrame) -> DataFrame:
    return gmm_labels(model, df).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("mean_confidence")
    )


def gmm_log_likelihood(model, df: DataFrame, features: str = "features", floor: float = 1e-6) -> float:
    """Log likelihood under the returned parameters (k matrices of columns squared; rows stay distributed).

    ``floor`` is added to the variances, as the source's mixtures do: a component on fewer rows than columns has a
    singular covariance, which is no density.
    """
    weights = np.array(model.weights)
    parts = [(np.asarray(g["mean"].toArray()), np.asarray(g["cov"].toArray())) for g in model.gaussiansDF.collect()]
    prepared = []
    for (mean, cov), w in zip(parts, weights):
        cov = cov + floor * np.eye(len(cov))
        sign, logdet = np.linalg.slogdet(cov)
        prepared.append((mean, np.linalg.inv(cov), logdet, np.log(max(w, 1e-300))))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            x = np.vstack(b["v"])
            logs = []
            for mean, inv, logdet, lw in prepared:
                d = x - mean
                logs.append(lw - 0.5 * (((d @ inv) * d).sum(axis=1) + logdet + x.shape[1] * np.log(2 * np.pi)))
            m = np.vstack(logs)
            top = m.max(axis=0)
            yield pd.DataFrame({"ll": [float((top + np.log(np.exp(m - top).sum(axis=0))).sum())]})

    per_batch = df.select(vector_to_array(features).alias("v")).mapInPandas(score, "ll double")
    return float(per_batch.agg(F.sum("ll")).first()[0])


def gmm_bic_aic(df: DataFrame, ks: Sequence[int] = K_RANGE, features: str = "features", seed: int = 42, max_iter: int = 200,
                parallelism: int = 9) -> DataFrame:
    """(k, log_likelihood, n_params, bic, aic).

    An iteration is a short job that one after another leaves most cores idle, so ``parallelism`` mixtures are fitted at a
    time; the threads only submit Spark jobs.
    """
    n = df.count()
    points = spread(df, n)
    points = df if points is df else cut_lineage(points)

    def one(k: int) -> tuple:
        model = fit_gmm(points, k, features, seed, max_iter)
        d = len(model.gaussiansDF.first()["mean"])
        p = (k - 1) + k * d + k * d * (d + 1) // 2
        ll = gmm_log_likelihood(model, points, features)
        return int(k), ll, int(p), -2 * ll + p * float(np.log(n)), -2 * ll + 2.0 * p

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        rows = list(pool.map(one, ks))
    return df.sparkSession.createDataFrame(rows, "k int, log_likelihood double, n_params long, bic double, aic double")


def hierarchical_labels(df: DataFrame, k: int = 3, features: str = "features", seed: int = 42) -> DataFrame:
    """Divisive hierarchy over all rows.

    Spark starts a split by noise in proportion to the centre's length, which is nothing for centred
    data; one constant coordinate keeps that length positive and changes no distance.
    """
    asm = VectorAssembler(inputCols=[features, "__one"], outputCol="__shifted")
    rows = asm.transform(df.withColumn("__one", F.lit(1.0)))
    model = BisectingKMeans(k=k, seed=seed, featuresCol="__shifted", predictionCol="cluster").fit(rows)
    return model.transform(rows).drop("__one", "__shifted")
