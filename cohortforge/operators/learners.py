"""Classifiers and regressors on Spark ML, cross-validation and tuning over fold columns.

A fitted model is a scorer: a function DataFrame -> DataFrame adding ``y_pred`` and ``y_prob``.
The driver only submits fits; rows never leave the executors.
"""

from __future__ import annotations

import functools
import itertools
import warnings
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    GBTRegressor,
    IsotonicRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_col
from ..session import cut_lineage, scratch_path, spread
from .grown import fit_trees, fits_here, score_trees, search_cells
from .metrics import classification_metrics, metrics_long
from .neighbors import knn_classify, knn_join
from .reduce import fit_reduction, fit_standardizer, reduction_stages
from .resample import oversample
from .search import scores_of, search_splits, settings_of

Scorer = Callable[[DataFrame], DataFrame]

SCALE_SENSITIVE = ("logistic_regression", "sgd_classifier", "knn")
LINEAR = ("logistic_regression", "sgd_classifier")
STRATEGIES = ("none", "class_weight", "smote", "class_weight+smote")
CLASSIFIERS = (
    "zero_r", "one_r", "naive_bayes", "logistic_regression", "decision_tree", "knn", "sgd_classifier",
    "random_forest", "gradient_boosting",
)
REGRESSORS = ("linear", "ridge", "lasso", "random_forest", "gradient_boosting")

#: Forests of deep trees keep the node of every row from level to level; else each level walks every row from the roots
#: again. The trees are the same. For a single tree the kept nodes cost more than the walk.
KEPT_NODES = {"cacheNodeIds": True, "checkpointInterval": -1}

# Search space per model.
GRIDS: dict[str, dict[str, list]] = {
    "logistic_regression": {"C": [0.01, 0.1, 1.0, 10.0], "elasticNetParam": [1.0, 0.0]},
    "decision_tree": {"maxDepth": [3, 5, 10, 20, 30], "minInstancesPerNode": [1, 5, 10, 20], "impurity": ["gini", "entropy"]},
    "knn": {"k": [3, 5, 7, 11, 15], "weights": ["uniform", "distance"]},
    "sgd_classifier": {"regParam": [1e-5, 1e-4, 1e-3]},
    "random_forest": {"numTrees": [50, 100, 200], "maxDepth": [5, 10, 20, 30], "minInstancesPerNode": [1, 5, 10]},
    "gradient_boosting": {"maxIter": [50, 100, 200], "maxDepth": [3, 5, 7], "stepSize": [0.01, 0.1, 0.2]},
}


def make_classifier(name: str, n_rows: int, features: str = "features", label: str = "label",
                    weight: str | None = None, seed: int = 42, **params):
    """Unfitted Spark ML estimator of a registered name (models that are plain queries are handled in ``fit_scorer``)."""
    common = {"featuresCol": features, "labelCol": label}
    if weight:
        common["weightCol"] = weight
    c = params.pop("C", 1.0)
    make = {
        "one_r": lambda: DecisionTreeClassifier(**common, **({"maxDepth": 1, "seed": seed} | params)),
        "naive_bayes": lambda: NaiveBayes(**common, **({"modelType": "gaussian"} | params)),
        "logistic_regression": lambda: LogisticRegression(
            **common, **({"regParam": 1.0 / (c * max(n_rows, 1)), "elasticNetParam": 0.0, "maxIter": 1000, "standardization": False} | params)
        ),
        "decision_tree": lambda: DecisionTreeClassifier(**common, **({"maxDepth": 30, "seed": seed} | params)),
        "sgd_classifier": lambda: LogisticRegression(
            **common, **({"regParam": 1e-4, "elasticNetParam": 0.0, "maxIter": 1000, "standardization": False} | params)
        ),
        "random_forest": lambda: RandomForestClassifier(**common, **({"numTrees": 100, "maxDepth": 30, "seed": seed} | KEPT_NODES | params)),
        "gradient_boosting": lambda: GBTClassifier(
            **common, **({"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "seed": seed} | params)
        ),
    }
    if name not in make:
        raise ValueError(f"unknown classifier {name!r}; use one of {', '.join(CLASSIFIERS)}")
    return make[name]()


def label_counts(df: DataFrame, label: str) -> dict:
    """Rows per class; everything else a fit needs to know about its training set follows from these."""
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def weight_column(counts: Mapping, label: str) -> Column:
    """Balanced class weight n / (k * n_c) as an expression (one branch per class)."""
    out, n = F.lit(1.0), sum(counts.values())
    for cls, size in counts.items():
        out = F.when(as_col(label) == cls, F.lit(n / (len(counts) * size))).otherwise(out)
    return out


def positive_probability(scored: DataFrame, probability: str = "probability", raw: str = "rawPrediction") -> Column:
    """Probability of class 1, else the sigmoid of the decision score."""
    if probability in scored.columns:
        return vector_to_array(probability)[1]
    if raw in scored.columns:
        return 1 / (1 + F.exp(-vector_to_array(raw)[1]))
    raise AttributeError("model gives neither a probability nor a decision score")


def majority_class(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: most frequent label, smallest on ties."""
    return df.groupBy(as_col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(1)


def gaussian_nb_params(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """(label, column, prior, mean, var) with variances smoothed by 1e-9 of the largest feature variance."""
    wide = df.groupBy(as_col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.struct(F.avg(as_col(c)).alias("mean"), F.var_pop(as_col(c)).alias("var")).alias(c) for c in columns],
    )
    row = df.agg(F.count(F.lit(1)), F.greatest(*[F.var_pop(as_col(c)) for c in columns], F.lit(0.0))).first()
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), as_col(c).alias("s")) for c in columns])
    return wide.select("label", (F.col("n") / F.lit(float(row[0]))).alias("prior"), F.explode(pairs).alias("p")).select(
        "label", "p.column", "prior", "p.s.mean", (F.col("p.s.var") + F.lit(1e-9 * row[1])).alias("var")
    )


def gaussian_nb_scorer(df: DataFrame, columns: Sequence[str], label: str = "label") -> Scorer:
    """Gaussian naive Bayes as one projection: log likelihood per class from the fitted table."""
    table: dict = {}
    for r in gaussian_nb_params(df, columns, label).collect():  # classes x columns numbers
        table.setdefault(r["label"], {"prior": r["prior"]})[r["column"]] = (r["mean"], r["var"])
    joint = {}
    for cls, p in sorted(table.items()):
        ll = F.ln(F.lit(p["prior"]))
        for c in columns:
            m, v = p[c]
            d = as_col(c) - F.lit(m)
            ll = ll - 0.5 * F.ln(F.lit(6.283185307179586 * v)) - d * d / F.lit(2 * v)
        joint[cls] = ll

    def score(rows: DataFrame) -> DataFrame:
        names = {cls: f"__ll{i}" for i, cls in enumerate(joint)}
        out = rows.withColumns({names[cls]: ll for cls, ll in joint.items()})
        top = F.greatest(*[F.col(n) for n in names.values()]) if len(names) > 1 else F.col(next(iter(names.values())))
        pred = F.lit(None).cast("int")
        for cls in sorted(names, reverse=True):
            pred = F.when(F.col(names[cls]) == top, F.lit(int(cls))).otherwise(pred)
        total = sum((F.exp(F.col(n) - top) for n in names.values()), F.lit(0.0))
        prob = F.exp(F.col(names[1]) - top) / total if 1 in names else F.lit(0.0)
        return out.withColumns({"y_pred": pred, "y_prob": prob}).drop(*names.values())

    return score


def fit_scorer(name: str, train: DataFrame, features: str = "features", label: str = "label", row_id: str = "id",
               weight: str | None = None, seed: int = 42, counts: Mapping | None = None, scores_only: bool = False, **params) -> Scorer:
    """Fit a registered classifier and return its scorer, which has the Spark ML model as ``model`` unless ``scores_only``."""
    if name not in CLASSIFIERS:
        raise ValueError(f"unknown classifier {name!r}; use one of {', '.join(CLASSIFIERS)}")
    if name == "zero_r":
        top = majority_class(train, label).first()["label"]
        return lambda df: df.withColumns({"y_pred": F.lit(int(top)), "y_prob": F.lit(1.0 if top == 1 else 0.0)})
    if name == "knn":
        k, votes = params.get("k", 5), params.get("weights", "uniform")
        known = train.select(as_col(row_id), as_col(label), vector_to_array(features).alias("__vec"))

        def score(df: DataFrame) -> DataFrame:
            near = knn_join(df.withColumn("__vec", vector_to_array(features)), known, k, row_id, row_id, "__vec")
            voted = knn_classify(near, known, row_id, label, votes).withColumnRenamed("query_id", row_id)
            return df.join(voted.withColumn("y_pred", F.col("y_pred").cast("int")), row_id)

        return score
    n = sum(counts.values()) if counts else train.count()
    if scores_only and name == "gradient_boosting" and not (weight and "minInstancesPerNode" in params) and fits_here(name, [params], n, width_of(train, features)):
        trees = fit_trees(gathered(train, n, features), name, params, features, label, weight)
        return lambda df: score_trees(trees, df, features)
    est = make_classifier(name, n, features, label, weight, seed, **params)
    model = est.fit(gathered(train, n, features) if name in LINEAR else spread(train, n))

    def score_ml(df: DataFrame) -> DataFrame:
        out = model.transform(df)
        return out.withColumns(
            {"y_pred": F.col("prediction").cast("int"), "y_prob": positive_probability(out)}
        ).drop("prediction", "probability", "rawPrediction")

    score_ml.model = model
    return score_ml


def fit_fold_steps(name: str, train: DataFrame, features: str = "features", label: str = "label", row_id: str = "id",
                   scale: bool | None = None, imbalance: str = "none", reduction: tuple[str, dict] | None = None,
                   seed: int = 42, counts: Mapping | None = None, scores_only: bool = False, **params) -> Scorer:
    """scaler -> reducer -> oversampling -> classifier, every step fitted on ``train`` only."""
    if imbalance not in STRATEGIES:
        raise ValueError(f"unknown strategy {imbalance!r}; use one of {', '.join(STRATEGIES)}")
    counts = dict(counts or label_counts(train, label))
    steps, rows, vec = [], train, features
    if name in SCALE_SENSITIVE if scale is None else scale:
        step = fit_standardizer(rows, vec, "__scaled", n=sum(counts.values()))
        steps.append(step)
        rows, vec = step.transform(rows), "__scaled"
    if reduction is not None:
        step = fit_reduction(rows, reduction, vec, label, "__reduced")
        steps.append(step)
        rows, vec = step.transform(rows), "__reduced"
    rows = rows.select(as_col(row_id), as_col(label), as_col(vec).alias("__x"))
    if "smote" in imbalance:
        both = oversample(rows.withColumn("__v", vector_to_array("__x")), label, row_id, "__v", seed=seed, counts=counts)
        counts = {c: max(counts.values()) for c in counts}
        # Iterative fits read these rows many times.
        rows = cut_lineage(both.select(row_id, label, array_to_vector("__v").alias("__x")))
    weight = None
    if "class_weight" in imbalance or name == "sgd_classifier":
        rows, weight = rows.withColumn("__w", weight_column(counts, label)), "__w"
    fitted = fit_scorer(name, rows, "__x", label, row_id, weight, seed, counts, scores_only, **params)

    def score(df: DataFrame) -> DataFrame:
        out = df
        for s in steps:
            out = s.transform(out)
        return fitted(out.withColumn("__x", as_col(vec))).drop("__x", "__scaled", "__scaled__s", "__reduced", "__reduced__c")

    score.fitted = fitted
    return score


#: Rows in one partition of a fit at least: small tables are not cut into many tiny tasks.
ROWS_PER_TASK = 5_000
#: Numbers (rows times width) in one partition of a linear fit: 8 MB.
NUMBERS_PER_TASK = 1_000_000
CHOSEN = "model string, fold int, params string, inner_score double"
OOF = "model string, fold int, y_true int, y_pred int, y_prob double"


def compact(df: DataFrame, n_rows: int) -> DataFrame:
    """Rows written once, in fewer partitions where they would hold next to nothing, in more where they would hold too many."""
    most = max(1, -(-n_rows // ROWS_PER_TASK))
    return cut_lineage(spread(df, n_rows) if df.rdd.getNumPartitions() <= most else df.coalesce(most))


def width_of(df: DataFrame, features: str) -> int:
    first = df.select(F.size(vector_to_array(features))).first()
    return (first and first[0]) or 1


def gathered(df: DataFrame, n_rows: int, features: str) -> DataFrame:
    """Rows for linear fits, and for cells of binned rows, in fewer, larger partitions: passes are short, so tasks cost more than sums."""
    most = max(1, -(-n_rows * width_of(df, features) // NUMBERS_PER_TASK))
    return df.coalesce(most) if most < df.rdd.getNumPartitions() else df


def is_written(spark, path: str) -> bool:
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def run_cv(df: DataFrame, models: Sequence[str], fold: str = "fold", features: str = "features", label: str = "label",
           row_id: str = "id", threshold: float = 0.5, imbalance: str = "none", reduction: tuple[str, dict] | None = None,
           params: Mapping[str, dict] | None = None, seed: int = 42, parallelism: int = 8, store: str | None = None,
           failed: str = "null") -> DataFrame:
    """Out-of-fold table (id, model, fold, y_true, y_pred, y_prob) of every model over every fold.

    ``df`` carries its fold as a column; training is ``fold != i``. A model that fails on a fold, or finds one
    class only, has null predictions there, so its metrics for that fold are NaN and all others stay. With
    ``failed="raise"`` such a fold ends the run with an error that names it, once all others are fitted and written.
    ``parallelism`` fits run at a time; the threads only submit Spark jobs.

    Each (model, fold) is scored at once and written to its own folder of ``store`` (a new scratch folder unless given);
    its model is then dropped, and the result reads the written rows only. A run over a store that holds some of them
    already goes on with the others: a folder counts once it is committed, and a failed fit leaves none, so that it is
    tried again. A store belongs to one table and one choice of the other arguments.
    """
    if failed not in ("null", "raise"):
        raise ValueError("failed must be 'null' or 'raise'")
    spark = df.sparkSession
    # One pass gives the class counts of every training side (folds x classes numbers).
    cells = {(r[0], r[1]): r["n"] for r in df.groupBy(fold, label).agg(F.count(F.lit(1)).alias("n")).collect()}
    store = store or scratch_path(spark, "out-of-fold")
    path = lambda job: f"{store}/{job[0]}/{job[1]}"
    jobs = list(itertools.product(models, sorted({f for f, _ in cells})))
    if not jobs:
        raise ValueError("no model could be fitted")
    left = [job for job in jobs if not is_written(spark, path(job))]
    rows = compact(df, sum(cells.values())) if left else df
    broken: dict[tuple, Exception] = {}

    def one(job: tuple) -> None:
        name, i = job
        train, held = rows.where(as_col(fold) != i), rows.where(as_col(fold) == i)
        counts: dict = {}
        for (f, cls), n in cells.items():
            if f != i:
                counts[cls] = counts.get(cls, 0) + n

        def write(scored: DataFrame, said: dict, to: str) -> None:
            scored.select(
                as_col(row_id), F.lit(name).alias("model"), as_col(fold).cast("int").alias("fold"), as_col(label).cast("int").alias("y_true"), *[v.alias(k) for k, v in said.items()]
            ).write.mode("overwrite").parquet(to)

        try:
            if len(counts) > 1 or name == "zero_r":
                score = fit_fold_steps(
                    name, train, features, label, row_id, imbalance=imbalance, reduction=reduction, seed=seed, counts=counts, scores_only=True,
                    **(params or {}).get(name, {}),
                )
                pred = F.col("y_pred") if threshold == 0.5 else (F.col("y_prob") >= threshold).cast("int")
                return write(score(held), {"y_pred": pred, "y_prob": F.col("y_prob")}, path(job))
            broken[job] = ValueError("one class only in training")
        except Exception as err:  # one fit must not end the run
            warnings.warn(f"{name} failed on fold {i}: {err}", RuntimeWarning, stacklevel=2)
            broken[job] = err
        if failed == "null":
            write(held, {"y_pred": F.lit(None).cast("int"), "y_prob": F.lit(None).cast("double")}, f"{path(job)}-failed")

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        list(pool.map(one, left))
    if broken and failed == "raise":
        which = "; ".join(f"{name} on fold {i}: {str(broken[name, i])[:300]}" for name, i in jobs if (name, i) in broken)
        raise RuntimeError(f"{len(broken)} of {len(jobs)} fits failed: {which}") from next(iter(broken.values()))
    return read_store(df, row_id, [f"{path(job)}-failed" if job in broken else path(job) for job in jobs])


def read_store(df: DataFrame, row_id: str, paths: Sequence[str]) -> DataFrame:
    kind = df.schema[row_id].dataType.simpleString()
    return df.sparkSession.read.schema(f"`{row_id}` {kind}, {OOF}").parquet(*paths)


def cv_metrics(oof: DataFrame) -> DataFrame:
    """(model, fold, metric, value) of an out-of-fold table; NaN where no row of a fold has a prediction."""
    failed = oof.groupBy(F.col("model").alias("__m"), F.col("fold").alias("__f")).agg((F.count("y_pred") == 0).alias("__failed"))
    long = metrics_long(classification_metrics(oof)).join(failed, (F.col("model") == F.col("__m")) & (F.col("fold") == F.col("__f")))
    return long.withColumn("value", F.when(F.col("__failed"), F.lit(float("nan"))).otherwise(F.col("value"))).drop("__m", "__f", "__failed")


def cross_validate(oof: DataFrame, metric: str | None = None) -> DataFrame:
    """Mean and population deviation over the folds that were fitted per (model, metric)."""
    long = cv_metrics(oof).where(~F.isnan("value"))
    rows = long.where(F.col("metric") == metric) if metric else long
    return rows.groupBy("model", "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def imbalance_compare(df: DataFrame, model: str = "logistic_regression", metric: str = "f1", fold: str = "fold", **kw) -> DataFrame:
    """Mean and deviation of the CV score without correction, with class weights and with oversampling.

    Strategies are compared over the same folds, so a fold that can't be fitted is an error unless ``failed="null"`` is given.
    """
    if model not in CLASSIFIERS:
        raise ValueError(f"unknown classifier {model!r}; use one of {', '.join(CLASSIFIERS)}")
    plans = {"baseline": "none", "class_weight_balanced": "class_weight", "smote": "smote"}
    if model in ("knn", "zero_r"):
        plans.pop("class_weight_balanced")
    out = None
    for label_, strategy in plans.items():
        oof = run_cv(df, [model], fold, imbalance=strategy, **({"failed": "raise"} | kw))
        part = cross_validate(oof, metric).select(F.lit(label_).alias("strategy"), "metric", "mean", "std")
        out = part if out is None else out.unionByName(part)
    return out


@dataclass
class Search:
    """Result of a search: settings with mean and deviation of their scores, the best one, refitted on all rows."""

    settings: list[dict]
    means: list[float]
    deviations: list[float]
    refit: Callable[[], tuple]

    @property
    def best(self) -> int:
        return max(range(len(self.means)), key=lambda i: self.means[i])

    @functools.cached_property
    def bestModel(self):
        """Fitted Spark ML model of the best setting."""
        return self.refit()[0]

    def table(self, spark) -> DataFrame:
        rows = [(said(s), float(m), float(d)) for s, m, d in zip(self.settings, self.means, self.deviations)]
        return spark.createDataFrame(rows, "params string, mean double, std double")


def said(setting: Mapping) -> str:
    return ", ".join(f"{k}={v:.6g}" if isinstance(v, float) else f"{k}={v}" for k, v in sorted(setting.items()))


def _prepared(train: DataFrame, model: str, features: str, label: str, scale: bool | None, reduction: tuple[str, dict] | None):
    """Scaler and reduction fitted on training rows: (fitted steps or None, features column after them)."""
    stages, vec = [], features
    if model in SCALE_SENSITIVE if scale is None else scale:
        stages.append(StandardScaler(inputCol=vec, outputCol="__scaled", withMean=False, withStd=True))
        vec = "__scaled"
    if reduction is not None:
        stages += reduction_stages(reduction, vec, label, "__reduced")
        vec = "__reduced"
    return (Pipeline(stages=stages).fit(train) if stages else None), vec


def search_folds(splits: Mapping, model: str, grid: Mapping[str, Sequence] | None, n_rows: int, features: str, label: str, scoring: str,
                 parallelism: int, seed: int, scale: bool | None, reduction: tuple[str, dict] | None) -> tuple[list[dict], dict]:
    """Settings, and split -> score of each; scaler and reduction are fitted once per split, on its training rows only."""
    settings = settings_of(grid or GRIDS[model])

    def ready(item: tuple) -> tuple:
        key, (train, held) = item
        steps, vec = _prepared(train, model, features, label, scale, reduction)
        known, held = (steps.transform(train), steps.transform(held)) if steps else (train, held)
        return key, ((gathered(known, n_rows, vec) if model in LINEAR else known, held), vec)

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        rows = dict(pool.map(ready, splits.items()))
    (some, _), vec = next(iter(rows.values())) if rows else ((None, None), features)
    if some is not None and fits_here(model, settings, n_rows, width_of(some, vec)):

        def of_split(key) -> tuple:
            (train, held), vec = rows[key]
            train, held = gathered(train, n_rows, vec), gathered(held, n_rows, vec)
            return key, scores_of(search_cells(train, held, model, settings, vec, label, scoring, n_rows), len(settings), scoring)

        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            return settings, dict(pool.map(of_split, splits))

    def fit(key, params: dict) -> tuple:
        (train, held), vec = rows[key]
        return make_classifier(model, n_rows, vec, label, None, seed, **params).fit(train), held, vec

    return settings, search_splits(splits, settings, model, fit, features, label, scoring, parallelism)


def grid_search(df: DataFrame, model: str, grid: Mapping[str, Sequence] | None = None, fold: str = "fold", features: str = "features",
                label: str = "label", scoring: str = "f1", parallelism: int = 8, seed: int = 42, scale: bool | None = None,
                reduction: tuple[str, dict] | None = None):
    """Exhaustive search scored over an existing fold column; returns (``Search``, result table).

    Settings that are prefixes of one another share a fit (see ``search``).
    """
    if model not in GRIDS or model == "knn":
        raise ValueError(f"no grid for {model!r}")
    n = df.count()
    rows = compact(df, n)
    splits = {r[0]: (rows.where(as_col(fold) != r[0]), rows.where(as_col(fold) == r[0])) for r in rows.select(fold).distinct().collect()}
    settings, scores = search_folds(splits, model, grid, n, features, label, scoring, parallelism, seed, scale, reduction)
    each = np.array([scores[k] for k in sorted(splits)])

    def refit() -> tuple:
        steps, vec = _prepared(rows, model, features, label, scale, reduction)
        known = steps.transform(rows) if steps else rows
        return make_classifier(model, n, vec, label, None, seed, **settings[found.best]).fit(gathered(known, n, vec) if model in LINEAR else known), steps

    found = Search(settings, each.mean(0).tolist(), each.std(0).tolist(), refit)
    return found, found.table(df.sparkSession)


def knn_search(df: DataFrame, grid: Mapping[str, Sequence] | None = None, fold: str = "fold", features: str = "features",
               label: str = "label", row_id: str = "id", scoring: str = "f1", scale: bool = True) -> tuple[dict, DataFrame]:
    """Best (k, weights) over an existing fold column, and the result table.

    Each fold is searched once for the largest k; every smaller k and both votes reuse those neighbours.
    """
    grid = grid or GRIDS["knn"]
    ks, votes = list(grid.get("k", [5])), list(grid.get("weights", ["uniform"]))
    metric = {"roc_auc": "auc_roc"}.get(scoring, scoring)

    def of_fold(i) -> DataFrame:
        train, held = df.where(as_col(fold) != i), df.where(as_col(fold) == i)
        vec = features
        if scale:
            step, vec = fit_standardizer(train, features, "__scaled"), "__scaled"
            train, held = step.transform(train), step.transform(held)
        arr = vector_to_array(vec).alias("__vec")
        part = knn_join(held.select(row_id, arr), train.select(row_id, arr), max(ks), row_id, row_id, "__vec")
        return part.withColumn("__fold", F.lit(i))

    # Small folds leave cores idle between their steps; the threads only submit Spark jobs.
    with ThreadPoolExecutor(4) as pool:
        parts = list(pool.map(of_fold, [r[0] for r in df.select(fold).distinct().orderBy(fold).collect()]))
    near = functools.reduce(DataFrame.unionByName, parts)
    near = cut_lineage(near)
    truth = df.select(as_col(row_id).alias("query_id"), as_col(label).cast("int").alias("y_true"), as_col(fold).alias("fold"))
    plans = {f"k={k}, weights={vote}": {"k": k, "weights": vote} for k, vote in itertools.product(ks, votes)}
    voted = None
    for name, p in plans.items():
        part = knn_classify(near.where(F.col("rank") <= p["k"]), df, row_id, label, p["weights"]).withColumn("model", F.lit(name))
        voted = part if voted is None else voted.unionByName(part)
    # All settings are scored as models of one table, in one pass.
    table = cv_metrics(cut_lineage(voted.join(truth, "query_id"))).where(F.col("metric") == metric).groupBy("model")
    rows = table.agg(F.avg("value"), F.stddev_pop("value")).collect()
    scores = {r[0]: (r[1], r[2]) for r in rows}
    top = max(plans, key=lambda n: scores[n][0])
    out = df.sparkSession.createDataFrame([(n, *scores[n]) for n in plans], "params string, mean double, std double")
    return plans[top] | {"score": scores[top][0]}, out


def nested_cv(df: DataFrame, models: Sequence[str], grids: Mapping[str, Mapping[str, Sequence]] | None = None, features: str = "features",
              label: str = "label", row_id: str = "id", scoring: str = "f1", seed: int = 42, scale: bool | None = None,
              reduction: tuple[str, dict] | None = None, parallelism: int = 8, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Outer estimate of tuned models over ``outer_fold`` / ``inner_fold`` columns (see ``nested_folds``).

    Returns the out-of-fold table and the chosen parameters per (model, fold); models without a grid are skipped.
    The inner splits of all outer folds are searched together, and settings share fits. Each (model, outer fold) is
    written to ``store`` with its choice; a run over a store goes on with what is missing there.
    """
    grids, spark = grids or GRIDS, df.sparkSession
    names = [m for m in models if m in grids]
    if not names:
        raise ValueError("none of the models has a grid")
    store = store or scratch_path(spark, "nested")
    n = df.count()
    rows = compact(df, n)
    outer = [r[0] for r in rows.select("outer_fold").distinct().orderBy("outer_fold").collect()]
    inner = [r[0] for r in rows.select(F.explode("inner_fold").alias("i")).where("i is not null").distinct().orderBy("i").collect()]
    path = lambda name, o: f"{store}/{name}/{o}"

    def outer_rows(o) -> tuple[DataFrame, DataFrame]:
        return rows.where(F.col("outer_fold") != o), rows.where(F.col("outer_fold") == o)

    def finish(name: str, o, params: dict, score: float, scored: DataFrame) -> None:
        scored.select(
            as_col(row_id), F.lit(name).alias("model"), F.col("outer_fold").cast("int").alias("fold"), as_col(label).cast("int").alias("y_true"), F.col("y_pred").cast("int").alias("y_pred"), "y_prob"
        ).write.mode("overwrite").parquet(path(name, o))
        spark.createDataFrame([(name, o, said(params), float(score))], CHOSEN).coalesce(1).write.mode("overwrite").parquet(f"{path(name, o)}-chosen")

    for name in names:
        left = [o for o in outer if not is_written(spark, f"{path(name, o)}-chosen")]
        if name == "knn":

            def one(o) -> None:
                train, held = outer_rows(o)
                best, _ = knn_search(train.withColumn("__inner", F.col("inner_fold")[o]), grids["knn"], "__inner", features, label, row_id, scoring, scale is not False)
                score = best.pop("score")
                finish("knn", o, best, score, fit_fold_steps("knn", train, features, label, row_id, scale, reduction=reduction, seed=seed, **best)(held))
        else:
            splits = {}
            for o, i in itertools.product(left, inner):
                train = outer_rows(o)[0]
                splits[o, i] = train.where(F.col("inner_fold")[o] != i), train.where(F.col("inner_fold")[o] == i)
            settings, scores = search_folds(splits, name, grids[name], n, features, label, scoring, parallelism, seed, scale, reduction)

            def one(o, name=name, settings=settings, scores=scores) -> None:
                train, held = outer_rows(o)
                means = np.mean([scores[o, i] for i in inner], axis=0)
                top = int(np.argmax(means))
                steps, vec = _prepared(train, name, features, label, scale, reduction)
                known, held = (steps.transform(train), steps.transform(held)) if steps else (train, held)
                if fits_here(name, settings, n, width_of(known, vec)):
                    scored = score_trees(fit_trees(gathered(known, n, vec), name, settings[top], vec, label), held, vec)
                else:
                    model = make_classifier(name, n, vec, label, None, seed, **settings[top]).fit(gathered(known, n, vec) if name in LINEAR else known)
                    scored = model.transform(held)
                    scored = scored.withColumns({"y_pred": F.col("prediction").cast("int"), "y_prob": positive_probability(scored)})
                finish(name, o, settings[top], float(means[top]), scored)

        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            list(pool.map(one, left))
    done = [path(m, o) for m in names for o in outer]
    return read_store(df, row_id, done), spark.read.schema(CHOSEN).parquet(*[f"{p}-chosen" for p in done])


def calibrate(df: DataFrame, model: str, fold: str = "fold", method: str = "sigmoid", features: str = "features", label: str = "label",
              row_id: str = "id", seed: int = 42, **params) -> Scorer:
    """Post-hoc calibration: per fold a model on the rest, a calibrator on the fold's own scores; the mean is returned."""
    if method not in ("sigmoid", "isotonic"):
        raise ValueError("method must be 'sigmoid' or 'isotonic'")
    pairs: list[tuple[Scorer, Callable[[DataFrame], Column | DataFrame]]] = []
    for i in [r[0] for r in df.select(fold).distinct().orderBy(fold).collect()]:
        score = fit_fold_steps(model, df.where(as_col(fold) != i), features, label, row_id, seed=seed, **params)
        held = score(df.where(as_col(fold) == i)).select(F.col("y_prob"), as_col(label).cast("double").alias("__y"))
        if method == "sigmoid":
            lr = LogisticRegression(featuresCol="__s", labelCol="__y", maxIter=100)
            cal = lr.fit(VectorAssembler(inputCols=["y_prob"], outputCol="__s").transform(held))
            pairs.append((score, lambda c, a=float(cal.coefficients[0]), b=float(cal.intercept): 1 / (1 + F.exp(-(F.lit(a) * c + F.lit(b))))))
        else:
            iso = IsotonicRegression(featuresCol="y_prob", labelCol="__y").fit(held)
            pairs.append((score, _steps(list(iso.boundaries), list(iso.predictions))))

    def calibrated(rows: DataFrame) -> DataFrame:
        out, names = rows, []
        for j, (score, fix) in enumerate(pairs):
            out = score(out).withColumn(f"__c{j}", fix(F.col("y_prob"))).drop("y_pred", "y_prob")
            names.append(f"__c{j}")
        mean = sum((F.col(n) for n in names), F.lit(0.0)) / len(names)
        return out.withColumn("y_prob", mean).withColumn("y_pred", (F.col("y_prob") >= 0.5).cast("int")).drop(*names)

    return calibrated


def _steps(xs: Sequence[float], ys: Sequence[float]) -> Callable[[Column], Column]:
    """Piecewise-linear lookup through the isotonic boundaries."""
    bx, by = F.array(*[F.lit(float(x)) for x in xs]), F.array(*[F.lit(float(y)) for y in ys])

    def at(c: Column) -> Column:
        i = F.size(F.filter(bx, lambda b: b <= c))
        x0, x1 = F.element_at(bx, F.greatest(i, F.lit(1))), F.element_at(bx, F.least(i + 1, F.lit(len(xs))))
        y0, y1 = F.element_at(by, F.greatest(i, F.lit(1))), F.element_at(by, F.least(i + 1, F.lit(len(ys))))
        return F.when((i == 0) | (x1 == x0), y0).otherwise(y0 + (y1 - y0) * F.try_divide(c - x0, x1 - x0))

    return at


def train_regressor(df: DataFrame, name: str = "random_forest", features: str = "features", label: str = "label", seed: int = 42, **params):
    """Fitted regressor of a registered name."""
    common = {"featuresCol": features, "labelCol": label}
    n = df.count()
    make = {
        "linear": lambda: LinearRegression(**common, **({"regParam": 0.0, "solver": "normal"} | params)),
        "ridge": lambda: LinearRegression(**common, **({"regParam": 1.0 / max(n, 1), "elasticNetParam": 0.0, "standardization": False} | params)),
        "lasso": lambda: LinearRegression(**common, **({"regParam": 0.1, "elasticNetParam": 1.0, "standardization": False} | params)),
        "random_forest": lambda: RandomForestRegressor(**common, **({"numTrees": 100, "maxDepth": 30, "seed": seed} | params)),
        "gradient_boosting": lambda: GBTRegressor(**common, **({"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "seed": seed} | params)),
    }
    if name not in make:
        raise ValueError(f"unknown regressor {name!r}; use one of {', '.join(REGRESSORS)}")
    return make[name]().fit(spread(df, n))


def train_classifier(df: DataFrame, columns: Sequence[str], name: str = "random_forest", label: str = "label", scale: bool = True,
                     class_weight: str | None = None, seed: int = 42, **params):
    """A persistable fitted Pipeline (assemble, optional scaling, classifier) of a registered Spark ML name."""
    rows, weight = df, None
    if class_weight == "balanced":
        rows, weight = df.withColumn("__w", weight_column(label_counts(df, label), label)), "__w"
    stages = [VectorAssembler(inputCols=list(columns), outputCol="features")]
    vec = "features"
    if scale:
        stages.append(StandardScaler(inputCol="features", outputCol="scaled", withMean=False, withStd=True))
        vec = "scaled"
    n = rows.count()
    stages.append(make_classifier(name, n, vec, label, weight, seed, **params))
    return Pipeline(stages=stages).fit(spread(rows, n))


def ols_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope, intercept and R2 of a one-feature least-squares line."""
    a, b = as_col(y).cast("double"), as_col(x).cast("double")
    return df.agg(F.regr_slope(a, b).alias("slope"), F.regr_intercept(a, b).alias("intercept"), F.regr_r2(a, b).alias("r2"))
