"""Dimension reduction and feature selection; everything is fitted on the training rows handed in."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, UnivariateFeatureSelector, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import spread
from .profile import class_weights


def fit_standardizer(df: DataFrame, features: str, output: str, center: bool = False, n: int | None = None) -> PipelineModel:
    """Scale by the population deviation; not centred by default, which keeps sparse vectors sparse.

    Centring changes nothing for distances, trees or linear models with a free intercept.
    """
    n = df.count() if n is None else n
    scaler = StandardScaler(inputCol=features, outputCol=f"{output}__s", withMean=center, withStd=True)
    size = len(df.select(features).first()[0])
    up = float(np.sqrt(n / (n - 1))) if n > 1 else 1.0
    lift = ElementwiseProduct(scalingVec=Vectors.dense([up] * size), inputCol=f"{output}__s", outputCol=output)
    return Pipeline(stages=[scaler, lift]).fit(df)


def fit_pca(df: DataFrame, features: str, output: str, k: int) -> PipelineModel:
    """Centre, then project. The covariance (columns squared, not rows) is the only thing on the driver."""
    return Pipeline(stages=pca_stages(features, output, k)).fit(df)


def pca_stages(features: str, output: str, k: int) -> list:
    center = StandardScaler(inputCol=features, outputCol=f"{output}__c", withMean=True, withStd=False)
    return [center, PCA(k=k, inputCol=f"{output}__c", outputCol=output)]


def explained_variance(model: PipelineModel, spark) -> DataFrame:
    """(component, ratio, cumulative)."""
    ratios = [float(x) for x in model.stages[-1].explainedVariance]
    rows = [(i + 1, r, float(sum(ratios[: i + 1]))) for i, r in enumerate(ratios)]
    return spark.createDataFrame(rows, "component int, ratio double, cumulative double")


def cumulative_explained_variance(components: DataFrame, levels: Sequence[float] = (0.80, 0.90, 0.95)) -> DataFrame:
    """First component count whose cumulative ratio reaches each level, from (component, ratio)."""
    upto = Window.partitionBy(F.lit(0)).orderBy("component").rowsBetween(Window.unboundedPreceding, 0)  # one row per component
    cum = components.select("component", F.sum("ratio").over(upto).alias("cumulative"))
    at = F.array(*[F.lit(float(x)) for x in levels])
    return (
        cum.withColumn("level", F.explode(at))
        .groupBy("level")
        .agg(F.min(F.when(F.col("cumulative") >= F.col("level"), F.col("component"))).alias("n_components"))
    )


def pca_loadings(model: PipelineModel, names: Sequence[str], spark, components: int = 2) -> DataFrame:
    """(feature, pc1, pc2, ..., norm), each component signed so that its largest entry is positive."""
    pc = model.stages[-1].pc.toArray()[:, :components]
    pc = pc * np.sign(pc[np.abs(pc).argmax(axis=0), np.arange(pc.shape[1])])
    rows = [(n, *[float(x) for x in r], float(np.sqrt((r * r).sum()))) for n, r in zip(names, pc)]
    cols = ", ".join(f"pc{i + 1} double" for i in range(pc.shape[1]))
    return spark.createDataFrame(rows, f"feature string, {cols}, norm double")


def fit_kbest(df: DataFrame, features: str, label: str, output: str, k: int = 20):
    """The k features with the highest one-way F against the label."""
    return kbest_stage(features, label, output, k).fit(df)


def kbest_stage(features: str, label: str, output: str, k: int = 20) -> UnivariateFeatureSelector:
    sel = UnivariateFeatureSelector(featuresCol=features, labelCol=label, outputCol=output, selectionMode="numTopFeatures")
    return sel.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(k)


class ImportanceSelector(Estimator):
    """Pipeline stage that picks features by a fitted model's importances (see ``fit_from_importances``)."""

    def __init__(self, features: str, label: str, output: str, estimator=None, max_features: int = 20):
        super().__init__()
        if estimator is None:
            raise ValueError("select_from_model needs an estimator")
        self._args = (features, label, output, estimator, max_features)

    def _fit(self, dataset: DataFrame) -> VectorSlicer:
        return fit_from_importances(dataset, *self._args)


def fit_from_importances(df: DataFrame, features: str, label: str, output: str, estimator=None, max_features: int = 20):
    """Keep features whose importance reaches the median, at most ``max_features``."""
    if estimator is None:
        raise ValueError("select_from_model needs an estimator")
    model = estimator.copy({estimator.featuresCol: features, estimator.labelCol: label}).fit(spread(df, df.count()))
    weight = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    w = np.abs(weight.toArray())
    ranked = np.lexsort((np.arange(len(w)), -w))[:max_features]
    keep = sorted(int(i) for i in ranked if w[i] >= np.median(w)) or list(range(len(w)))
    return VectorSlicer(inputCol=features, outputCol=output, indices=keep)


def default_importance_estimator(seed: int = 42) -> RandomForestClassifier:
    """The forest that ``learners`` registers: importances near the median depend on its size."""
    return RandomForestClassifier(numTrees=100, maxDepth=30, seed=seed)


def fit_reduction(df: DataFrame, spec: tuple[str, dict], features: str, label: str, output: str):
    """A transformer for ``('pca' | 'select_kbest' | 'select_from_model', parameters)``."""
    return Pipeline(stages=reduction_stages(spec, features, label, output)).fit(df)


def reduction_stages(spec: tuple[str, dict], features: str, label: str, output: str) -> list:
    """Unfitted stages of a reduction, to be fitted on whatever rows the surrounding fold trains on."""
    kind, params = spec
    if kind == "pca":
        return pca_stages(features, output, **params)
    if kind == "select_kbest":
        return [kbest_stage(features, label, output, **params)]
    if kind == "select_from_model":
        return [ImportanceSelector(features, label, output, **params)]
    raise ValueError(f"unknown reduction {kind!r}; use 'pca', 'select_kbest' or 'select_from_model'")


def select_l1(df: DataFrame, features: str, label: str, names: Sequence[str], c: float = 0.1) -> DataFrame:
    """(feature, coefficient, kept) of a balanced L1 logistic fit: kept where |coefficient| >= the median."""
    n = df.count()
    weights = {r[label]: r["weight"] for r in class_weights(df, label).collect()}
    w = F.lit(1.0)
    for v, x in weights.items():
        w = F.when(F.col(label) == v, F.lit(x)).otherwise(w)
    model = LogisticRegression(
        featuresCol=features, labelCol=label, weightCol="__w", elasticNetParam=1.0, regParam=1.0 / (c * n), maxIter=200
    ).fit(df.withColumn("__w", w))
    coef = np.abs(model.coefficients.toArray())
    keep = coef >= np.median(coef)
    if not keep.any():
        keep[:] = True
    rows = [(n_, float(v), int(k)) for n_, v, k in zip(names, model.coefficients.toArray(), keep)]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double, kept int")


def projection_table(model: PipelineModel, df: DataFrame, output: str, keep: Sequence[str]) -> DataFrame:
    """(keep..., pc1, pc2) for a two-dimensional view."""
    arr = vector_to_array(output)
    return model.transform(df).select(*keep, arr[0].alias("pc1"), arr[1].alias("pc2"))
