"""Neighbours, resampling, reduction, learners and model selection."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.exprs import round_all
from ...operators import encode, folds, learners, metrics, neighbors, profile, reduce, resample
from ...session import cut_lineage
from ..bindings import LINES, PARTS, VECTORS, plain, table, view
from ..registry import query
from .profile import anova_sql

VEC_SQL = "WITH v AS (" + plain(VECTORS.replace("{array}", "DOUBLE[]")) + ") "
LN = f"WITH li AS ({plain(LINES)}) "
PT = f"WITH pa AS ({plain(PARTS)}) "
PART_COLS = ("size", "price", "cheap_type", "name_length")


def vectors(spark, d) -> DataFrame:
    return view(spark, d, VECTORS.replace("{array}", "array<double>"))


def lines(spark, d) -> DataFrame:
    return view(spark, d, LINES)


def parts(spark, d, k: int | None = None) -> DataFrame:
    """Parts with a feature vector and, if wanted, a stratified fold."""
    rows = encode.assemble_vector(view(spark, d, PARTS), PART_COLS)
    return folds.stratified_kfold(rows, "label", ["id"], k) if k else rows


def embedded(spark, d, k: int | None = None) -> DataFrame:
    rows = vectors(spark, d).select("id", (F.col("label") < 2).cast("int").alias("label"), array_to_vector("vector").alias("features"))
    return folds.stratified_kfold(rows, "label", ["id"], k) if k else rows


_KNN = """, p AS (SELECT a.id AS q, b.id AS n, b.label AS l, list_distance(a.vector, b.vector) AS x FROM v a JOIN v b ON a.id <> b.id),
    k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY x, n) AS r FROM p QUALIFY r <= 5)"""


@query("knn_join", VEC_SQL + _KNN + " SELECT q AS query_id, n AS neighbor_id, ROUND(x, 6) AS distance, CAST(r AS INT) AS rank FROM k")
def q_knn(spark, d):
    v = vectors(spark, d)
    return round_all(neighbors.knn_join(v, v, 5, exclude_self=True))


@query(
    "knn_classifier",
    VEC_SQL + _KNN + """, c AS (SELECT q, l, COUNT(*) n FROM k GROUP BY 1, 2)
    SELECT q AS query_id, arg_min(l, (-n, l)) AS y_pred, ROUND(coalesce(SUM(n) FILTER (l = 1), 0) / SUM(n), 6) AS y_prob FROM c GROUP BY q""",
)
def q_knn_class(spark, d):
    v = vectors(spark, d)
    return round_all(neighbors.knn_classify(neighbors.knn_join(v, v, 5, exclude_self=True), v))


@query(
    "knn_classifier_weighted",
    VEC_SQL + _KNN + """, c AS (SELECT q, l, SUM(1 / x) n FROM k GROUP BY 1, 2)
    SELECT q AS query_id, arg_max(l, n) AS y_pred, ROUND(coalesce(SUM(n) FILTER (l = 1), 0) / SUM(n), 6) AS y_prob FROM c GROUP BY q""",
)
def q_knn_weighted(spark, d):
    v = vectors(spark, d)
    return round_all(neighbors.knn_classify(neighbors.knn_join(v, v, 5, exclude_self=True), v, weights="distance"))


_H = "CAST('0x' || substr(md5('{s}|' || CAST(base_id AS VARCHAR) || '|' || CAST(copy AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296e0"


@query(
    "smote",
    VEC_SQL + """, y AS (SELECT id, CASE WHEN label < 2 THEN 1 ELSE 0 END AS label, vector FROM v), mi AS (SELECT * FROM y WHERE label = 1),
    n AS (SELECT COUNT(*) FILTER (label = 1) AS m, COUNT(*) FILTER (label = 0) - COUNT(*) FILTER (label = 1) AS need FROM y),
    b AS (SELECT id AS base_id, vector AS base, row_number() OVER (ORDER BY md5('42|' || CAST(id AS VARCHAR))) AS r FROM mi),
    dr AS (SELECT base_id, base, unnest(range(need // m + CASE WHEN r <= need % m THEN 1 ELSE 0 END)) AS copy FROM b, n),
    """ + f"""dd AS (SELECT *, CAST(floor({_H.format(s=43)} * 5) AS INT) + 1 AS rank, {_H.format(s=44)} AS u FROM dr),
    p AS (SELECT a.id AS q, b.id AS nn, b.vector AS nv, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.vector, b.vector), b.id) AS rk FROM mi a JOIN mi b ON a.id <> b.id)
    SELECT base_id, nn AS neighbor_id, CAST(copy AS INT) AS copy, ROUND(u, 6) AS u, 1 AS label,
    ROUND(list_sum(list_transform(range(1, 65), lambda i: base[i] + u * (nv[i] - base[i]))), 4) AS total FROM dd JOIN p ON q = base_id AND rk = rank""",
)
def q_smote(spark, d):
    rows = vectors(spark, d).withColumn("label", (F.col("label") < 2).cast("int"))
    out = resample.smote(rows, "label")
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return out.select("base_id", "neighbor_id", "copy", F.round("u", 6).alias("u"), "label", F.round(total, 4).alias("total"))


@query(
    "smote_balance",
    VEC_SQL + """, n AS (SELECT COUNT(*) FILTER (label >= 2) AS top FROM v) SELECT unnest([0, 1]) AS label, top AS n FROM n""",
)
def q_balance(spark, d):
    rows = vectors(spark, d).withColumn("label", (F.col("label") < 2).cast("int"))
    return resample.oversample(rows, "label").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("pca_fit_transform")
def q_pca(spark, d):
    rows = vectors(spark, d).select("id", array_to_vector("vector").alias("features"))
    return round_all(reduce.explained_variance(reduce.fit_pca(rows, "features", "pcs", 16), spark))


@query("pca_total_variance", VEC_SQL + ", u AS (SELECT unnest(vector) AS x, unnest(range(1, 65)) AS i FROM v), w AS (SELECT i, var_samp(x) AS s FROM u GROUP BY i) SELECT ROUND(SUM(s), 6) AS total_variance FROM w")
def q_pca_variance(spark, d):
    """All components together must carry the total variance of the input."""
    rows = vectors(spark, d).select(array_to_vector("vector").alias("features"))
    pcs = reduce.fit_pca(rows, "features", "pcs", 64).transform(rows).select(vector_to_array("pcs").alias("p"))
    return pcs.select(F.posexplode("p").alias("i", "x")).groupBy("i").agg(F.var_samp("x").alias("s")).agg(F.round(F.sum("s"), 6).alias("total_variance"))


@query("pca_loadings")
def q_loadings(spark, d):
    rows = vectors(spark, d).select(array_to_vector("vector").alias("features"))
    out = reduce.pca_loadings(reduce.fit_pca(rows, "features", "pcs", 2), [f"e{i}" for i in range(64)], spark)
    return round_all(out.orderBy(F.desc("norm"), "feature").limit(8), 5)


@query("select_k_best", f"{PT}, f AS ({anova_sql(PART_COLS, 'label', 'pa')}) SELECT \"column\" AS feature FROM f ORDER BY f_stat DESC LIMIT 2")
def q_kbest(spark, d):
    rows = parts(spark, d)
    model = reduce.fit_kbest(rows, "features", "label", "best", 2)
    return spark.createDataFrame([(PART_COLS[i],) for i in model.selectedFeatures], "feature string")


@query("anova_f_vector_columns", f"{PT}{anova_sql(PART_COLS, 'label', 'pa')}")
def q_anova(spark, d):
    return round_all(profile.anova_f(view(spark, d, PARTS), PART_COLS, "label"), 4)


@query("select_from_model")
def q_sfm(spark, d):
    slicer = reduce.fit_from_importances(parts(spark, d), "features", "label", "kept", reduce.default_importance_estimator(), 2)
    return spark.createDataFrame([(PART_COLS[i],) for i in slicer.getIndices()], "feature string")


@query("select_l1")
def q_l1(spark, d):
    return round_all(reduce.select_l1(parts(spark, d), "features", "label", PART_COLS), 4)


def holdout(scorer, rows: DataFrame) -> DataFrame:
    """Confusion counts and AUC of a scorer on a table."""
    out = scorer(rows).select("id", F.lit("m").alias("model"), F.col("is_test").alias("fold"), F.col("label").cast("int").alias("y_true"), "y_pred", "y_prob")
    return round_all(metrics.classification_metrics(out), 4)


def split_parts(spark, d):
    rows = cut_lineage(folds.stratified_split(parts(spark, d), "label", ["id"]))
    return rows.where("is_test = 0"), rows.where("is_test = 1")


@query("zero_r", f"{PT}, m AS (SELECT label FROM pa GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) SELECT id, (SELECT label FROM m) AS y_pred, CAST((SELECT label FROM m) AS DOUBLE) AS y_prob FROM pa")
def q_zero(spark, d):
    rows = parts(spark, d)
    return learners.fit_scorer("zero_r", rows)(rows).select("id", "y_pred", "y_prob")


_NB_COLS = ("qty", "disc", "price")
_NB = ", ".join(f"AVG({c}) m_{c}, var_pop({c}) + (SELECT 1e-9 * greatest(var_pop(qty), var_pop(disc), var_pop(price)) FROM li) v_{c}" for c in _NB_COLS)
_LL = " ".join(f"- 0.5 * ln(2 * pi() * v_{c}) - ({c} - m_{c}) ** 2 / (2 * v_{c})" for c in _NB_COLS)


@query(
    "gaussian_nb",
    LN + f""", g AS (SELECT label AS l, COUNT(*) / (SELECT COUNT(*) FROM li) AS prior, {_NB} FROM li GROUP BY 1),
    s AS (SELECT id, l, ln(prior) {_LL} AS ll FROM li, g)
    SELECT a.id, CASE WHEN b.ll > a.ll THEN 1 ELSE 0 END AS y_pred, ROUND(1 / (1 + exp(a.ll - b.ll)), 6) AS y_prob FROM s a JOIN s b ON a.id = b.id AND a.l = 0 AND b.l = 1""",
)
def q_nb(spark, d):
    rows = lines(spark, d)
    return round_all(learners.gaussian_nb_scorer(rows, _NB_COLS)(rows).select("id", "y_pred", "y_prob"))


@query(
    "naive_bayes_ml",
    LN + f""", g AS (SELECT label AS l, COUNT(*) / (SELECT COUNT(*) FROM li) AS prior, {_NB} FROM li GROUP BY 1),
    s AS (SELECT id, l, ln(prior) {_LL} AS ll FROM li, g)
    SELECT a.id, CASE WHEN b.ll > a.ll THEN 1 ELSE 0 END AS y_pred, ROUND(1 / (1 + exp(a.ll - b.ll)), 5) AS y_prob FROM s a JOIN s b ON a.id = b.id AND a.l = 0 AND b.l = 1""",
)
def q_nb_ml(spark, d):
    rows = encode.assemble_vector(lines(spark, d), _NB_COLS)
    return round_all(learners.fit_scorer("naive_bayes", rows)(rows).select("id", "y_pred", "y_prob"), 5)


@query(
    "one_r",
    PT + """, v AS (SELECT DISTINCT size FROM pa), t AS (SELECT (size + lead(size) OVER (ORDER BY size)) / 2 AS cut FROM v),
    c AS (SELECT cut, CASE WHEN size <= cut THEN 0 ELSE 1 END AS side, COUNT(*) * 1e0 AS n, AVG(label) AS p FROM pa, t WHERE cut IS NOT NULL GROUP BY 1, 2),
    b AS (SELECT cut FROM c GROUP BY cut ORDER BY SUM(n * 2 * p * (1 - p)), cut LIMIT 1),
    f AS (SELECT side, p FROM c JOIN b ON b.cut = c.cut)
    SELECT id, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS y_pred, ROUND(p, 6) AS y_prob FROM pa, b JOIN f ON f.side = CASE WHEN size <= b.cut THEN 0 ELSE 1 END""",
)
def q_one_r(spark, d):
    """With as many bins as values the one-split tree is the best Gini cut, found here by hand."""
    rows = encode.assemble_vector(view(spark, d, PARTS), ["size"])
    return round_all(learners.fit_scorer("one_r", rows, maxBins=64)(rows).select("id", "y_pred", "y_prob"))


@query(
    "logistic_saturated",
    PT + "SELECT cheap_type, ROUND(AVG(label), 3) AS y_prob, COUNT(*) AS n FROM pa GROUP BY 1",
)
def q_saturated(spark, d):
    """Without a penalty and with one 0/1 feature the fit must give the two group rates."""
    rows = encode.assemble_vector(view(spark, d, PARTS), ["cheap_type"])
    out = learners.fit_scorer("logistic_regression", rows, regParam=0.0, tol=1e-9)(rows)
    return out.groupBy("cheap_type").agg(F.round(F.avg("y_prob"), 3).alias("y_prob"), F.count(F.lit(1)).alias("n"))


def _model_query(name, **params):
    def run(spark, d):
        train, test = split_parts(spark, d)
        return holdout(learners.fit_fold_steps(name, train, **params), test)

    return run


for _name, _key, _params in (
    ("one_r_holdout", "one_r", {}),
    ("naive_bayes_holdout", "naive_bayes", {}),
    ("logistic", "logistic_regression", {}),
    ("decision_tree", "decision_tree", {}),
    ("sgd_logloss", "sgd_classifier", {}),
    ("random_forest", "random_forest", {}),
    ("gradient_boosting", "gradient_boosting", {}),
):
    query(_name)(_model_query(_key, **_params))


@query("fold_local_steps")
def q_steps(spark, d):
    """scaler -> reducer -> oversampling -> classifier, fitted on the training side only."""
    rows = cut_lineage(folds.stratified_split(embedded(spark, d), "label", ["id"]))
    score = learners.fit_fold_steps("logistic_regression", rows.where("is_test = 0"), imbalance="smote", reduction=("pca", {"k": 8}))
    return holdout(score, rows.where("is_test = 1"))


@query("train_classifier")
def q_train(spark, d):
    train, test = split_parts(spark, d)
    model = learners.train_classifier(train.drop("features"), PART_COLS, "random_forest", class_weight="balanced")

    def score(df):
        out = model.transform(df.drop("features"))
        return out.withColumns({"y_pred": F.col("prediction").cast("int"), "y_prob": learners.positive_probability(out)})

    return holdout(score, test)


@query("train_regressor")
def q_regressor(spark, d):
    rows = encode.assemble_vector(view(spark, d, PARTS).drop("label"), ["size", "cheap_type", "name_length"]).withColumn("label", F.col("price"))
    out = None
    for name in ("linear", "ridge", "lasso", "random_forest", "gradient_boosting"):
        pred = learners.train_regressor(rows, name).transform(rows)
        part = metrics.regression_metrics(pred.select(F.lit(name).alias("model"), F.col("label").alias("y_true"), F.col("prediction").alias("y_pred")), ["model"])
        out = part if out is None else out.unionByName(part)
    return round_all(out, 4)


@query("ols_line", "SELECT ROUND(regr_slope(l_extendedprice, l_quantity), 4) AS slope, ROUND(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, ROUND(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem")
def q_ols(spark, d):
    out = learners.ols_line(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice")
    return out.select(F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"), F.round("r2", 6).alias("r2"))


@query(
    "linear_regressor",
    "SELECT ROUND(regr_slope(l_extendedprice, l_quantity), 3) AS slope, ROUND(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem",
)
def q_linear(spark, d):
    rows = encode.assemble_vector(table(spark, d, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label")), ["l_quantity"])
    model = learners.train_regressor(rows, "linear")
    return round_all(spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double"), 3)


@query("predict_proba")
def q_proba(spark, d):
    train, test = split_parts(spark, d)
    return round_all(learners.fit_fold_steps("logistic_regression", train)(test).select("id", "y_pred", "y_prob"), 5)


@query("calibrate")
def q_calibrate(spark, d):
    rows = cut_lineage(parts(spark, d, 5))
    out = None
    for method in ("sigmoid", "isotonic"):
        score = learners.calibrate(rows, "decision_tree", method=method)
        part = score(rows).select(F.lit(method).alias("model"), F.col("label").alias("y_true"), "y_prob")
        part = metrics.calibration_curve(part)
        out = part if out is None else out.unionByName(part)
    return round_all(out, 4)


@query("run_cv")
def q_cv(spark, d):
    rows = cut_lineage(parts(spark, d, 10))
    oof = learners.run_cv(rows, learners.CLASSIFIERS, threshold=0.3, imbalance="class_weight", failed="raise")
    return round_all(metrics.classification_metrics(oof), 4)


@query(
    "run_cv_baseline",
    f"""{PT}, f AS (SELECT id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42|' || CAST(id AS VARCHAR))) - 1) % 5 AS INT) AS fold FROM pa),
    m AS (SELECT DISTINCT g.fold, (SELECT label FROM f x WHERE x.fold <> g.fold GROUP BY label ORDER BY COUNT(*) DESC, label LIMIT 1) AS top FROM f g)
    SELECT id, 'zero_r' AS model, f.fold, label AS y_true, top AS y_pred, CAST(top AS DOUBLE) AS y_prob FROM f JOIN m ON f.fold = m.fold""",
)
def q_cv_zero(spark, d):
    return learners.run_cv(cut_lineage(parts(spark, d, 5)), ["zero_r"], failed="raise")


@query("grid_search")
def q_grid(spark, d):
    _, out = learners.grid_search(cut_lineage(parts(spark, d, 10)), "decision_tree")
    return round_all(out, 4)


@query("knn_search")
def q_knn_search(spark, d):
    _, out = learners.knn_search(cut_lineage(embedded(spark, d, 10)))
    return round_all(out)


@query(
    "knn_search_uniform",
    VEC_SQL + """, f AS (SELECT id, CASE WHEN label < 2 THEN 1 ELSE 0 END AS label, vector FROM v),
    g AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY md5('42|' || CAST(id AS VARCHAR))) - 1) % 2 AS fold FROM f),
    p AS (SELECT a.id AS q, a.fold AS fold, a.label AS y, b.label AS l, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.vector, b.vector), b.id) AS r
      FROM g a JOIN g b ON a.fold <> b.fold),
    k AS (SELECT unnest([3, 5]) AS k), c AS (SELECT k, q, fold, y, CASE WHEN SUM(l) > k / 2 THEN 1 ELSE 0 END AS z FROM p, k WHERE r <= k GROUP BY k, q, fold, y),
    a AS (SELECT k, fold, AVG(CASE WHEN y = z THEN 1 ELSE 0 END) AS acc FROM c GROUP BY 1, 2)
    SELECT 'k=' || CAST(k AS VARCHAR) || ', weights=uniform' AS params, ROUND(AVG(acc), 6) AS mean, ROUND(stddev_pop(acc), 6) AS std FROM a GROUP BY k""",
)
def q_knn_search_uniform(spark, d):
    _, out = learners.knn_search(cut_lineage(embedded(spark, d, 2)), {"k": [3, 5]}, scoring="accuracy", scale=False)
    return round_all(out)


#: Models whose whole grids are searched in ``nested_cv``, with boosting; the forest has a query of its own.
NESTED = ("logistic_regression", "decision_tree", "knn", "sgd_classifier")
BOOSTED = ("gradient_boosting",)


def nested(spark, d, *rounds):
    rows = cut_lineage(folds.nested_folds(parts(spark, d), "label", ["id"], 10, 5))
    out = None
    for models in rounds:
        oof, chosen = learners.nested_cv(rows, models)
        part = round_all(metrics.classification_metrics(oof).join(chosen, ["model", "fold"]), 4)
        out = part if out is None else out.unionByName(part)
    return out


@query("nested_cv")
def q_nested(spark, d):
    return nested(spark, d, NESTED, BOOSTED)


@query("nested_cv_forest")
def q_nested_forest(spark, d):
    return nested(spark, d, ("random_forest",))


def flagged(spark, d) -> DataFrame:
    """Parts with one feature of two values: every tree is one split at most."""
    return encode.assemble_vector(view(spark, d, PARTS), ["cheap_type"]).select("id", "label", "cheap_type", "features")


_STUMP = """, s AS (SELECT {key}, x, count(*) FILTER (label = 1) > count(*) FILTER (label = 0) AS says FROM {train} GROUP BY {key}, x)"""


@query(
    "grid_search_stump",
    PT + """, f AS (SELECT id, label, cheap_type AS x, (row_number() OVER (PARTITION BY label ORDER BY md5('42|' || CAST(id AS VARCHAR))) - 1) % 5 AS fold FROM pa),
    t AS (SELECT g.fold AS f, h.x, h.label FROM (SELECT DISTINCT fold FROM f) g JOIN f h ON h.fold <> g.fold)"""
    + _STUMP.format(key="f", train="t") + """,
    a AS (SELECT fold, AVG(CASE WHEN says = (label = 1) THEN 1 ELSE 0 END) AS acc FROM f JOIN s ON s.f = f.fold AND s.x = f.x GROUP BY fold),
    p AS (SELECT 'impurity=' || i || ', maxDepth=' || CAST(d AS VARCHAR) AS params FROM (SELECT unnest(['gini', 'entropy']) AS i), (SELECT unnest([1, 3]) AS d))
    SELECT params, ROUND((SELECT AVG(acc) FROM a), 6) AS mean, ROUND((SELECT stddev_pop(acc) FROM a), 6) AS std FROM p""",
)
def q_grid_stump(spark, d):
    rows = folds.stratified_kfold(flagged(spark, d), "label", ["id"], 5)
    return round_all(learners.grid_search(rows, "decision_tree", {"maxDepth": [1, 3], "impurity": ["gini", "entropy"]}, scoring="accuracy")[1])


@query(
    "nested_cv_stump",
    PT + """, f AS (SELECT id, label, cheap_type AS x, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42|' || CAST(id AS VARCHAR))) - 1) % 4 AS INT) AS fold FROM pa),
    t AS (SELECT g.fold AS f, h.x, h.label FROM (SELECT DISTINCT fold FROM f) g JOIN f h ON h.fold <> g.fold)"""
    + _STUMP.format(key="f", train="t") + """
    SELECT id, 'decision_tree' AS model, fold, label AS y_true, CAST(says AS INT) AS y_pred FROM f JOIN s ON s.f = f.fold AND s.x = f.x""",
)
def q_nested_stump(spark, d):
    rows = cut_lineage(folds.nested_folds(flagged(spark, d), "label", ["id"], 4, 2))
    oof, _ = learners.nested_cv(rows, ["decision_tree"], {"decision_tree": {"maxDepth": [1, 2]}}, scoring="accuracy")
    return oof.drop("y_prob")


@query("imbalance_compare")
def q_imbalance(spark, d):
    rows = cut_lineage(embedded(spark, d, 5))
    return round_all(learners.imbalance_compare(rows, "logistic_regression"), 4)


@query("cross_validate")
def q_cross(spark, d):
    oof = learners.run_cv(cut_lineage(parts(spark, d, 10)), learners.CLASSIFIERS, failed="raise")
    return round_all(learners.cross_validate(oof), 4)


@query(
    "cross_validate_baseline",
    f"""{PT}, f AS (SELECT label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42|' || CAST(id AS VARCHAR))) - 1) % 3 AS INT) AS fold FROM pa),
    a AS (SELECT fold, AVG(1 - label) AS accuracy FROM f GROUP BY 1)
    SELECT 'zero_r' AS model, 'accuracy' AS metric, ROUND(AVG(accuracy), 6) AS mean, ROUND(stddev_pop(accuracy), 6) AS std FROM a""",
)
def q_cross_zero(spark, d):
    oof = learners.run_cv(cut_lineage(parts(spark, d, 3)), ["zero_r"], failed="raise")
    return round_all(learners.cross_validate(oof, "accuracy"))


@query(
    "knn_out_of_fold",
    VEC_SQL + """, f AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY md5('42|' || CAST(id AS VARCHAR))) - 1) % 2 AS fold FROM v),
    p AS (SELECT a.id AS q, b.label AS l, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.vector, b.vector), b.id) AS r FROM f a JOIN f b ON a.fold <> b.fold),
    c AS (SELECT q, l, COUNT(*) n FROM p WHERE r <= 3 GROUP BY 1, 2) SELECT q AS id, CAST(arg_min(l, (-n, l)) AS INT) AS y_pred FROM c GROUP BY q""",
)
def q_knn_oof(spark, d):
    rows = folds.stratified_kfold(vectors(spark, d), "label", ["id"], 2).withColumn("features", array_to_vector("vector")).drop("vector")
    return learners.run_cv(cut_lineage(rows), ["knn"], params={"knn": {"k": 3, "scale": False}}, failed="raise").select("id", "y_pred")


