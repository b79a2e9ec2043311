"""Fold-level statistics: intervals, summary tables and paired tests over (model, fold, metric, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.special import signed_rank_p_value, t_quantile, t_two_sided_p

SUMMARY_METRICS = (
    "f1", "auc_roc", "auprc", "pr_auc", "recall", "precision", "kappa", "brier_score", "balanced_accuracy",
)


def fold_ci(long: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Mean, sample deviation and t interval per (model, metric); null and NaN folds are left out."""
    value = F.when(~F.isnan("value"), F.col("value"))
    g = long.groupBy("model", "metric").agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("s")
    )
    # The quantile is looked up once per distinct fold count, not per row.
    sizes = g.select("n").where("n > 1").distinct().withColumn("t", t_quantile((1 + confidence) / 2, F.col("n") - 1))
    half = F.coalesce(F.col("t") * F.col("s") / F.sqrt("n"), F.lit(0.0))
    return g.join(sizes, "n", "left").select(
        "model",
        "metric",
        "n",
        "mean",
        F.when(F.col("n") < 2, F.lit(0.0)).otherwise(F.col("s")).alias("std"),
        (F.col("mean") - half).alias("ci_lower"),
        (F.col("mean") + half).alias("ci_upper"),
    )


def metrics_summary(long: DataFrame, metrics: Sequence[str] = SUMMARY_METRICS, confidence: float = 0.95) -> DataFrame:
    """One row per model with ``<metric>_{mean,std,ci_lower,ci_upper}``, best F1 first; absent metrics are null."""
    ci = fold_ci(long, confidence)
    aggs = [
        F.max(F.when(F.col("metric") == m, F.col(s))).alias(f"{m}_{s}")
        for m in metrics
        for s in ("mean", "std", "ci_lower", "ci_upper")
    ]
    out = ci.groupBy("model").agg(*aggs)
    return out.orderBy(F.desc_nulls_last("f1_mean"), "model") if "f1" in metrics else out


def leaderboard(summary: DataFrame, top: int = 5, tunable: Sequence[str] | None = None) -> DataFrame:
    """The best models by mean F1, optionally only those that can be tuned."""
    out = summary.orderBy(F.desc_nulls_last("f1_mean"), "model").limit(top)
    return out.where(F.col("model").isin(list(tunable))) if tunable is not None else out


def ci_plot_table(ci: DataFrame) -> DataFrame:
    """Error-bar lengths below and above the mean."""
    return ci.select(
        "model", "metric", "mean", (F.col("mean") - F.col("ci_lower")).alias("err_low"), (F.col("ci_upper") - F.col("mean")).alias("err_high")
    )


def concat_experiments(results: dict[str, DataFrame]) -> DataFrame:
    """Stack result tables, model names prefixed by the experiment."""
    out = None
    for prefix, df in results.items():
        part = df.withColumn("model", F.concat(F.lit(f"{prefix}__"), F.col("model")))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def paired_tests(long: DataFrame, metric: str = "f1", baseline: str | None = None, alpha: float = 0.05,
                 test_train_ratio: float | None = None) -> DataFrame:
    """Paired t and signed-rank test of each model against the baseline, over common folds.

    ``test_train_ratio`` switches to the resampling-corrected t statistic (variance times
    1/n + ratio); the default is the plain paired test.
    """
    rows = long.where(F.col("metric") == metric).select("model", "fold", "value")
    if baseline is None:
        names = rows.agg(F.max((F.col("model") == "zero_r").cast("int")), F.min("model")).first()
        baseline = "zero_r" if names[0] else names[1]
    # The baseline's value is looked up inside the fold (one row per model there), not by a self-join.
    base = F.max(F.when(F.col("model") == baseline, F.struct("value"))).over(Window.partitionBy("fold"))
    diffs = (
        rows.withColumn("b", base)
        .where((F.col("model") != baseline) & F.col("b").isNotNull())
        .select("model", "fold", (F.col("value") - F.col("b.value")).alias("d"))
    )
    size = F.round(F.abs("d"), 12)  # equal gaps tie despite float noise
    ranked = (
        diffs.where(size > 0)
        .groupBy("model", size.alias("a"))
        .agg(F.count(F.lit(1)).alias("t"), F.sum((F.col("d") > 0).cast("int")).alias("up"))
    )
    # Windows over the folds of one model: a handful of rows each.
    per = Window.partitionBy("model").orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("t").over(per), F.lit(0))
    ranks = ranked.withColumn("rank", below + (F.col("t") + 1) / 2)
    w = ranks.groupBy("model").agg(
        F.sum(F.col("rank") * F.col("up")).alias("wp"),
        F.sum(F.col("rank") * (F.col("t") - F.col("up"))).alias("wm"),
        F.sum("t").alias("nz"),
        F.sum(F.col("t") * F.col("t") * F.col("t") - F.col("t")).alias("ties"),
    )
    stats = diffs.groupBy("model").agg(
        F.avg("d").alias("mean_diff"), F.stddev_samp("d").alias("s"), F.count("d").alias("n")
    )
    spread = F.col("s") * F.sqrt((1 / F.col("n")) + F.lit(float(test_train_ratio or 0.0)))
    out = stats.join(w, "model", "left").withColumn("t_stat", F.coalesce(F.when(F.col("s") > 0, F.col("mean_diff") / spread), F.lit(0.0)))
    out = out.withColumns(
        {
            "p_value_t": F.when(F.coalesce(F.col("s"), F.lit(0.0)) > 0, t_two_sided_p(F.col("t_stat"), F.greatest(F.col("n") - 1, F.lit(1)))).otherwise(F.lit(1.0)),
            "p_value_wilcoxon": F.coalesce(
                signed_rank_p_value(
                    F.least("wp", "wm"), F.col("nz"), F.col("ties"), ((F.col("ties") == 0) & (F.col("nz") == F.col("n"))).cast("int")
                ),
                F.lit(1.0),
            ),
        }
    )
    return out.select(
        "model",
        F.lit(baseline).alias("baseline"),
        F.lit(metric).alias("metric"),
        "mean_diff",
        "t_stat",
        "p_value_t",
        "p_value_wilcoxon",
        (F.col("p_value_t") < alpha).cast("int").alias("significant_t"),
        (F.col("p_value_wilcoxon") < alpha).cast("int").alias("significant_w"),
    ).orderBy(F.desc("mean_diff"), "model")
