"""The evaluation suite over a scored table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.exprs import round_all
from ...operators import metrics, ordered, reduce, significance
from ...session import cut_lineage
from ..bindings import SCORED, plain, view
from ..registry import query

SC = f"WITH scored AS ({plain(SCORED)}) "


def scored(spark, d):
    return view(spark, d, SCORED)


_CELL = """COUNT(*) FILTER (y_true = 1 AND y_pred = 1) AS tp, COUNT(*) FILTER (y_true = 0 AND y_pred = 0) AS tn,
    COUNT(*) FILTER (y_true = 0 AND y_pred = 1) AS fp, COUNT(*) FILTER (y_true = 1 AND y_pred = 0) AS fn"""
_N = "(tp + tn + fp + fn)"
_CHANCE = f"(((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (1e0 * {_N} * {_N}))"
_HARD_RAW = {
    "accuracy": f"(tp + tn) / {_N}",
    "balanced_accuracy": "(tp / (tp + fn) + tn / (tn + fp)) / 2",
    "precision": "coalesce(tp / nullif(tp + fp, 0), 0)",
    "recall": "tp / (tp + fn)",
    "f1": "2 * tp / (2 * tp + fp + fn)",
    "f1_weighted": f"(2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fp + fn) * (tn + fp)) / {_N}",
    "kappa": f"((tp + tn) / {_N} - {_CHANCE}) / (1 - {_CHANCE})",
}
_HARD = ", ".join(f"ROUND({v}, 6) AS {k}" for k, v in _HARD_RAW.items())
_CURVE = """, s AS (SELECT model, fold, y_prob p, SUM(y_true) * 1e0 pos, SUM(1 - y_true) * 1e0 neg FROM scored GROUP BY 1, 2, 3),
    c AS (SELECT *, SUM(pos) OVER w tp, SUM(neg) OVER w fp, SUM(pos) OVER a np, SUM(neg) OVER a nn, lag(pos) OVER w AS x,
      row_number() OVER w AS i, row_number() OVER (PARTITION BY model, fold ORDER BY p) AS j, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg
      FROM s WINDOW w AS (PARTITION BY model, fold ORDER BY p DESC), a AS (PARTITION BY model, fold)),
    r AS (SELECT model, fold, y_true, rank() OVER (PARTITION BY model, fold ORDER BY y_prob) + (COUNT(*) OVER (PARTITION BY model, fold, y_prob) - 1) / 2 AS rk FROM scored),
    auc AS (SELECT model, fold, (SUM(rk) FILTER (y_true = 1) - SUM(y_true) * (SUM(y_true) + 1) / 2) / (SUM(y_true) * SUM(1 - y_true)) AS auc_roc FROM r GROUP BY 1, 2)"""
_AREAS = """, q AS (SELECT *, lag(tp / (tp + fp), 1, 1e0) OVER w AS pp, lag(tp / np, 1, 0e0) OVER w AS pr FROM c WINDOW w AS (PARTITION BY model, fold ORDER BY p DESC)),
    ap AS (SELECT model, fold, SUM((tp / np - pr) * tp / (tp + fp)) AS auprc, SUM((tp / np - pr) * (tp / (tp + fp) + pp) / 2) AS pr_auc FROM q GROUP BY 1, 2)"""


@query("confusion_matrix", SC + "SELECT model, fold, y_true, y_pred, COUNT(*) AS n FROM scored GROUP BY ALL")
def q_cm(spark, d):
    return metrics.confusion_matrix(scored(spark, d))


@query("confusion_counts", SC + f"SELECT model, fold, {_CELL} FROM scored GROUP BY 1, 2")
def q_counts(spark, d):
    return metrics.confusion_counts(scored(spark, d))


@query(
    "hard_metrics",
    SC + f", k AS (SELECT model, fold, {_CELL}, COUNT(*) * 1e0 AS n FROM scored GROUP BY 1, 2) SELECT model, fold, {_HARD} FROM k",
)
def q_hard(spark, d):
    return round_all(metrics.hard_metrics(scored(spark, d)))


@query("auc_roc", SC + _CURVE + "SELECT model, fold, ROUND(auc_roc, 6) AS auc_roc FROM auc")
def q_auc(spark, d):
    return round_all(metrics.curve_metrics(scored(spark, d)).select("model", "fold", "auc_roc"))


@query("average_precision", SC + _CURVE + _AREAS + "SELECT model, fold, ROUND(auprc, 6) AS auprc FROM ap")
def q_ap(spark, d):
    return round_all(metrics.curve_metrics(scored(spark, d)).select("model", "fold", "auprc"))


@query("pr_auc", SC + _CURVE + _AREAS + "SELECT model, fold, ROUND(pr_auc, 6) AS pr_auc FROM ap")
def q_prauc(spark, d):
    return round_all(metrics.curve_metrics(scored(spark, d)).select("model", "fold", "pr_auc"))


@query("brier", SC + "SELECT model, fold, ROUND(AVG((y_prob - y_true) ** 2), 6) AS brier_score FROM scored GROUP BY 1, 2")
def q_brier(spark, d):
    return round_all(metrics.brier(scored(spark, d)))


_ALL = (
    SC
    + _CURVE
    + _AREAS
    + f""", k AS (SELECT model, fold, {_CELL}, COUNT(*) * 1e0 AS n, AVG((y_prob - y_true) ** 2) AS brier FROM scored GROUP BY 1, 2),
    m AS (SELECT k.model, k.fold, {", ".join(f"{v} AS {k}" for k, v in _HARD_RAW.items())}, auc_roc, auprc, pr_auc, brier AS brier_score
    FROM k JOIN auc ON k.model = auc.model AND k.fold = auc.fold JOIN ap ON k.model = ap.model AND k.fold = ap.fold)"""
)


@query("classification_metrics", _ALL + " SELECT model, fold, " + ", ".join(f"ROUND({c}, 6) AS {c}" for c in (*_HARD_RAW, "auc_roc", "auprc", "pr_auc", "brier_score")) + " FROM m")
def q_all(spark, d):
    return round_all(metrics.classification_metrics(scored(spark, d)))


@query(
    "cumulative_curve",
    SC + _CURVE + "SELECT model, fold, p AS score, CAST(tp AS BIGINT) AS cum_pos, CAST(fp AS BIGINT) AS cum_neg FROM c",
)
def q_curve(spark, d):
    return metrics.score_curve(scored(spark, d)).select("model", "fold", "score", "cum_pos", "cum_neg")


@query(
    "topk_capacity",
    SC + """, r AS (SELECT model, y_true, row_number() OVER (PARTITION BY model ORDER BY y_prob DESC, md5('0|' || id)) r FROM scored),
    n AS (SELECT model, COUNT(*) n, SUM(y_true) pos FROM scored GROUP BY 1),
    f AS (SELECT * FROM (VALUES ('top_5pct', 0.05e0), ('top_10pct', 0.10e0), ('top_15pct', 0.15e0), ('top_20pct', 0.20e0)) v(label, f)),
    k AS (SELECT model, label, CAST(greatest(1, floor(n * f)) AS BIGINT) AS k, pos FROM n, f)
    SELECT k.model, label, k, ROUND(SUM(y_true) / k, 6) AS precision_at_k, ROUND(SUM(y_true) / MIN(pos), 6) AS recall_at_k
    FROM k JOIN r ON r.model = k.model AND r.r <= k.k GROUP BY k.model, label, k""",
)
def q_topk(spark, d):
    return round_all(metrics.topk_capacity(scored(spark, d), ["id"]))


@query(
    "roc_points",
    SC + _CURVE + """SELECT model, fold, ROUND(fp / nn, 6) AS fpr, ROUND(tp / np, 6) AS tpr, p AS threshold FROM c
    WHERE i = 1 OR j = 1 OR pos <> next_pos OR neg <> next_neg
    UNION ALL SELECT DISTINCT model, fold, 0e0, 0e0, CAST('inf' AS DOUBLE) FROM scored""",
)
def q_roc(spark, d):
    return round_all(metrics.roc_points(scored(spark, d)), keep=["threshold"])


@query(
    "roc_points_full",
    SC + _CURVE + """SELECT model, fold, ROUND(fp / nn, 6) AS fpr, ROUND(tp / np, 6) AS tpr, p AS threshold FROM c
    UNION ALL SELECT DISTINCT model, fold, 0e0, 0e0, CAST('inf' AS DOUBLE) FROM scored""",
)
def q_roc_full(spark, d):
    return round_all(metrics.roc_points(scored(spark, d), drop_collinear=False), keep=["threshold"])


@query(
    "pr_points",
    SC + _CURVE + """SELECT model, fold, ROUND(tp / np, 6) AS recall, ROUND(tp / (tp + fp), 6) AS precision, p AS threshold, ROUND(np / (np + nn), 6) AS prevalence FROM c
    UNION ALL SELECT model, fold, 0e0, 1e0, NULL, ROUND(AVG(y_true), 6) FROM scored GROUP BY 1, 2""",
)
def q_pr(spark, d):
    return round_all(metrics.pr_points(scored(spark, d)), keep=["threshold"])


@query(
    "calibration_curve",
    SC + """, b AS (SELECT *, CAST(greatest(ceil(CAST(ROUND(y_prob * 100) AS INT) / 10e0) - 1, 0) AS INT) AS bin FROM scored)
    SELECT model, bin, COUNT(*) AS n, ROUND(AVG(y_true), 6) AS fraction_of_positives, ROUND(AVG(y_prob), 6) AS mean_predicted_value FROM b GROUP BY 1, 2""",
)
def q_calibration(spark, d):
    return round_all(metrics.calibration_curve(scored(spark, d)))


@query(
    "expected_cost",
    SC + f""", k AS (SELECT model, {_CELL} FROM scored GROUP BY 1)
    SELECT model, -2000e0 * tp - 200 * fp - 15000 * fn AS total_cost, ROUND((-2000e0 * tp - 200 * fp - 15000 * fn) / (tp + tn + fp + fn), 6) AS avg_cost_per_patient,
    tp, tn, fp, fn FROM k""",
)
def q_cost(spark, d):
    return round_all(metrics.expected_cost(scored(spark, d)))


def _sweep_sql(start, n):
    return f""", t AS (SELECT {start}e0 + 0.05e0 * i AS threshold FROM (SELECT unnest(range({n})) AS i)),
    k AS (SELECT model, threshold, COUNT(*) FILTER (y_true = 1 AND y_prob >= threshold) AS tp, COUNT(*) FILTER (y_true = 0 AND y_prob < threshold) AS tn,
      COUNT(*) FILTER (y_true = 0 AND y_prob >= threshold) AS fp, COUNT(*) FILTER (y_true = 1 AND y_prob < threshold) AS fn FROM scored, t GROUP BY 1, 2)"""


_COST = "-2000e0 * tp - 200 * fp - 15000 * fn"
_SWEEP = f"""SELECT model, ROUND(threshold, 6) AS threshold, {_COST} AS total_cost, ROUND(({_COST}) / (tp + tn + fp + fn), 6) AS avg_cost,
    ROUND(tp / (tp + fn), 6) AS recall, ROUND(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, ROUND(2 * tp / (2 * tp + fp + fn), 6) AS f1, tp, fp, fn, tn FROM k"""


@query("cost_sweep", SC + _sweep_sql("0.05", 19) + _SWEEP)
def q_sweep(spark, d):
    return round_all(metrics.cost_sweep(scored(spark, d)))


@query("cost_optimum", SC + _sweep_sql("0.05", 19) + _SWEEP + f" QUALIFY row_number() OVER (PARTITION BY model ORDER BY {_COST} DESC, threshold) = 1")
def q_optimum(spark, d):
    return round_all(metrics.cost_optimum(metrics.cost_sweep(scored(spark, d))))


@query("cost_optimum_smallest", SC + _sweep_sql("0.05", 19) + _SWEEP + f" QUALIFY row_number() OVER (PARTITION BY model ORDER BY {_COST}, threshold) = 1")
def q_optimum_min(spark, d):
    return round_all(metrics.cost_optimum(metrics.cost_sweep(scored(spark, d)), best="min"))


@query(
    "tune_threshold",
    SC + _sweep_sql("0.10", 17) + """, m AS (SELECT model, threshold, coalesce(tp / nullif(tp + fp, 0), 0) p, tp / (tp + fn) r, 2 * tp / (2 * tp + fp + fn) f,
      (tp / (tp + fn) + tn / (tn + fp)) / 2 b FROM k)
    SELECT model, ROUND(threshold, 6) AS threshold, ROUND(p, 6) AS precision, ROUND(r, 6) AS recall, ROUND(f, 6) AS f1, ROUND(b, 6) AS balanced_accuracy,
    CASE WHEN row_number() OVER (PARTITION BY model ORDER BY f DESC, threshold) = 1 THEN 1 ELSE 0 END AS is_best FROM m""",
)
def q_tune(spark, d):
    return round_all(metrics.tune_threshold(scored(spark, d)))


@query(
    "operating_point_compare",
    SC + """, t AS (SELECT * FROM (VALUES ('default', 0.5e0), ('screening', 0.1e0)) v(operating_point, threshold)),
    k AS (SELECT model, operating_point, threshold, COUNT(*) FILTER (y_true = 1 AND y_prob >= threshold) AS tp, COUNT(*) FILTER (y_true = 0 AND y_prob < threshold) AS tn,
      COUNT(*) FILTER (y_true = 0 AND y_prob >= threshold) AS fp, COUNT(*) FILTER (y_true = 1 AND y_prob < threshold) AS fn FROM scored, t GROUP BY 1, 2, 3) """
    + _SWEEP.replace("SELECT model,", "SELECT model, operating_point,"),
)
def q_points(spark, d):
    return round_all(metrics.operating_points(scored(spark, d), {"default": 0.5, "screening": 0.1}))


@query("threshold_map", SC + "SELECT id, model, CASE WHEN y_prob >= 0.1 THEN 1 ELSE 0 END AS y_pred FROM scored")
def q_map(spark, d):
    return scored(spark, d).select("id", "model", (F.col("y_prob") >= 0.1).cast("int").alias("y_pred"))


_REPORT = """, t AS (SELECT model, y_true l, COUNT(*) s FROM scored GROUP BY 1, 2), p AS (SELECT model, y_pred l, COUNT(*) s FROM scored GROUP BY 1, 2),
    h AS (SELECT model, y_true l, COUNT(*) s FROM scored WHERE y_true = y_pred GROUP BY 1, 2),
    c AS (SELECT t.model, t.l, h.s / p.s AS precision, h.s / t.s AS recall, 2 * h.s / (t.s + p.s) AS f1, t.s AS support, h.s AS hit
      FROM t JOIN p ON p.model = t.model AND p.l = t.l JOIN h ON h.model = t.model AND h.l = t.l)
    SELECT model, CAST(l AS VARCHAR) AS label, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1, support FROM c
    UNION ALL SELECT model, 'accuracy', ROUND(SUM(hit) / SUM(support), 6), ROUND(SUM(hit) / SUM(support), 6), ROUND(SUM(hit) / SUM(support), 6), CAST(SUM(support) AS BIGINT) FROM c GROUP BY model
    UNION ALL SELECT model, 'macro avg', ROUND(AVG(precision), 6), ROUND(AVG(recall), 6), ROUND(AVG(f1), 6), CAST(SUM(support) AS BIGINT) FROM c GROUP BY model
    UNION ALL SELECT model, 'weighted avg', ROUND(SUM(precision * support) / SUM(support), 6), ROUND(SUM(recall * support) / SUM(support), 6),
      ROUND(SUM(f1 * support) / SUM(support), 6), CAST(SUM(support) AS BIGINT) FROM c GROUP BY model"""


@query("classification_report", SC + _REPORT)
def q_report(spark, d):
    return round_all(metrics.classification_report(scored(spark, d)))


_REG = "WITH p AS (SELECT l_linenumber, l_extendedprice AS y_true, l_quantity * 1500e0 AS y_pred FROM lineitem) "


def _reg(spark, d):
    from ..bindings import table

    return table(spark, d, "lineitem").select("l_linenumber", F.col("l_extendedprice").alias("y_true"), (F.col("l_quantity") * 1500.0).alias("y_pred"))


@query(
    "regression_metrics",
    _REG + """SELECT l_linenumber, ROUND(sqrt(AVG((y_true - y_pred) ** 2)), 4) AS rmse, ROUND(AVG(abs(y_true - y_pred)), 4) AS mae,
    ROUND(1 - SUM((y_true - y_pred) ** 2) / SUM((y_true - m) ** 2), 4) AS r2 FROM (SELECT *, AVG(y_true) OVER (PARTITION BY l_linenumber) m FROM p) GROUP BY 1""",
)
def q_regression(spark, d):
    return round_all(metrics.regression_metrics(_reg(spark, d), ["l_linenumber"]), 4)


@query("residuals", _REG + "SELECT l_linenumber, ROUND(y_true - y_pred, 4) AS residual FROM p")
def q_residuals(spark, d):
    return round_all(metrics.residuals(_reg(spark, d)).select("l_linenumber", "residual"), 4)


@query(
    "oof_assembly",
    SC + "SELECT id, CASE WHEN fold < 8 THEN y_pred ELSE -1 END AS y_pred, CASE WHEN fold < 8 THEN y_prob END AS y_prob FROM scored",
)
def q_oof(spark, d):
    s = scored(spark, d)
    return metrics.assemble_oof(s.select("id"), s.where("fold < 8"), ["id"])


FOLD_METRICS = (
    _ALL
    + """, l AS (SELECT model, fold, 'f1' AS metric, f1 AS value FROM m UNION ALL SELECT model, fold, 'auc_roc', auc_roc FROM m
    UNION ALL SELECT model, fold, 'recall', recall FROM m)"""
)


def fold_metrics(spark, d):
    wide = metrics.classification_metrics(scored(spark, d)).select("model", "fold", "f1", "auc_roc", "recall")
    return cut_lineage(metrics.metrics_long(wide))  # a few numbers per model and fold, read several times


# Two-sided 95 % quantile of Student's t at 9 degrees of freedom, from the printed table.
_T9 = "2.2621571627409915e0"
_CI = f""", ci AS (SELECT model, metric, COUNT(value) AS n, AVG(value) AS mean, stddev_samp(value) AS std, {_T9} * stddev_samp(value) / sqrt(COUNT(value)) AS h FROM l GROUP BY 1, 2)"""


@query(
    "fold_ci",
    FOLD_METRICS + _CI + "SELECT model, metric, n, ROUND(mean, 6) AS mean, ROUND(std, 6) AS std, ROUND(mean - h, 6) AS ci_lower, ROUND(mean + h, 6) AS ci_upper FROM ci",
)
def q_ci(spark, d):
    return round_all(significance.fold_ci(fold_metrics(spark, d)))


_WIDE = ", ".join(
    f"ROUND(MAX({e}) FILTER (metric = '{m}'), 6) AS {m}_{s}"
    for m in ("f1", "auc_roc", "recall")
    for s, e in (("mean", "mean"), ("std", "std"), ("ci_lower", "mean - h"), ("ci_upper", "mean + h"))
)


@query("metrics_summary", FOLD_METRICS + _CI + f"SELECT model, {_WIDE}, CAST(NULL AS DOUBLE) AS kappa_mean FROM ci GROUP BY model")
def q_summary(spark, d):
    out = significance.metrics_summary(fold_metrics(spark, d), ["f1", "auc_roc", "recall", "kappa"])
    return round_all(out.drop("kappa_std", "kappa_ci_lower", "kappa_ci_upper"))


@query("leaderboard", FOLD_METRICS + _CI + "SELECT model, ROUND(mean, 6) AS f1_mean FROM ci WHERE metric = 'f1' ORDER BY mean DESC, model LIMIT 2")
def q_leader(spark, d):
    return round_all(significance.leaderboard(significance.metrics_summary(fold_metrics(spark, d), ["f1"]), 2).select("model", "f1_mean"))


@query("ci_table_for_plot", FOLD_METRICS + _CI + "SELECT model, metric, ROUND(mean, 6) AS mean, ROUND(h, 6) AS err_low, ROUND(h, 6) AS err_high FROM ci")
def q_ci_plot(spark, d):
    return round_all(significance.ci_plot_table(significance.fold_ci(fold_metrics(spark, d))))


@query(
    "concat_experiments",
    FOLD_METRICS + "SELECT 'base__' || model AS model, fold, metric, ROUND(value, 6) AS value FROM l UNION ALL SELECT 'flip__' || model, fold, metric, ROUND(1 - value, 6) FROM l",
)
def q_concat(spark, d):
    base = fold_metrics(spark, d)
    return round_all(significance.concat_experiments({"base": base, "flip": base.withColumn("value", 1 - F.col("value"))}))


_TH = "atan(abs(t) / 3)"
_PT = f"""1 - 2 / pi() * ({_TH} + sin({_TH}) * (cos({_TH}) + 2/3e0 * cos({_TH}) ** 3 + 8/15e0 * cos({_TH}) ** 5 + 48/105e0 * cos({_TH}) ** 7))"""


@query(
    "paired_tests",
    FOLD_METRICS + f""", x AS (SELECT a.model, a.fold, a.value - b.value AS g FROM l a JOIN l b ON a.fold = b.fold AND a.metric = 'f1' AND b.metric = 'f1' AND b.model = 'm0' AND a.model <> 'm0'),
    y AS (SELECT model, AVG(g) AS m, stddev_samp(g) AS s, AVG(g) / (stddev_samp(g) / sqrt(10)) AS t FROM x GROUP BY 1),
    kk AS (SELECT model, g, row_number() OVER (PARTITION BY model ORDER BY abs(g)) AS r FROM x),
    w AS (SELECT model, least(SUM(r) FILTER (g > 0), SUM(r) FILTER (g < 0)) AS w FROM kk GROUP BY 1),
    sub AS (SELECT b, SUM(CASE WHEN (b >> (i - 1)) & 1 = 1 THEN i ELSE 0 END) AS s FROM (SELECT unnest(range(1024)) AS b), (SELECT unnest(range(1, 11)) AS i) GROUP BY b),
    p AS (SELECT model, least(1, 2 * COUNT(*) / 1024e0) AS pw FROM w JOIN sub ON sub.s <= w.w GROUP BY 1)
    SELECT y.model, 'm0' AS baseline, 'f1' AS metric, ROUND(m, 6) AS mean_diff, ROUND(t, 6) AS t_stat, ROUND({_PT}, 6) AS p_value_t, ROUND(pw, 6) AS p_value_wilcoxon,
    CASE WHEN {_PT} < .05 THEN 1 ELSE 0 END AS significant_t, CASE WHEN pw < .05 THEN 1 ELSE 0 END AS significant_w FROM y JOIN p ON y.model = p.model""",
)
def q_paired(spark, d):
    return round_all(significance.paired_tests(fold_metrics(spark, d)))


@query(
    "t_critical_and_p_values",
    FOLD_METRICS + """SELECT model, metric, COUNT(value) AS n, ROUND(""" + _T9 + """, 9) AS t_crit FROM l GROUP BY 1, 2""",
)
def q_tcrit(spark, d):
    from ...functions.special import t_quantile

    out = fold_metrics(spark, d).groupBy("model", "metric").agg(F.count("value").alias("n"))
    return out.withColumn("t_crit", F.round(t_quantile(0.975, F.col("n") - 1), 9))


@query(
    "cumulative_explained_variance",
    """WITH v AS (SELECT p_brand, var_pop(p_retailprice) * COUNT(*) AS x FROM part GROUP BY 1), t AS (SELECT SUM(x) s FROM v),
    r AS (SELECT row_number() OVER (ORDER BY x DESC, p_brand) AS component, x / s AS ratio FROM v, t),
    c AS (SELECT component, SUM(ratio) OVER (ORDER BY component) AS cum FROM r)
    SELECT level, CAST(MIN(component) AS INT) AS n_components FROM c, (SELECT unnest([0.8e0, 0.9e0, 0.95e0]) AS level) WHERE cum >= level GROUP BY level""",
)
def q_cev(spark, d):
    from pyspark.sql import Window

    from ..bindings import table

    v = table(spark, d, "part").groupBy("p_brand").agg((F.var_pop("p_retailprice") * F.count(F.lit(1))).alias("x"))
    ordered_ = Window.partitionBy(F.lit(0)).orderBy(F.desc("x"), "p_brand")
    ratio = v.select(F.row_number().over(ordered_).alias("component"), (F.col("x") / F.sum("x").over(Window.partitionBy(F.lit(0)))).alias("ratio"))
    return reduce.cumulative_explained_variance(ratio)


@query("exact_quantiles", """SELECT l_returnflag, 'l_extendedprice' AS "column", ROUND(quantile_cont(l_extendedprice, .1), 6) AS q0, ROUND(quantile_cont(l_extendedprice, .5), 6) AS q1,
    ROUND(quantile_cont(l_extendedprice, .99), 6) AS q2, COUNT(*) AS n FROM lineitem GROUP BY 1""")
def q_quantiles(spark, d):
    from ..bindings import table

    return round_all(ordered.exact_quantiles(table(spark, d, "lineitem"), ["l_extendedprice"], [0.1, 0.5, 0.99], by=["l_returnflag"]))
