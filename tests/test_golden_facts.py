"""Published facts that need no dataset: closed forms, table values and recorded totals."""

import math

import pytest
from pyspark.sql import functions as F

from cohortforge.functions import special
from cohortforge.operators import metrics, profile, rules, significance


def scored(spark, rows):
    return spark.createDataFrame(rows, "id long, model string, fold int, y_true int, y_pred int, y_prob double")


def test_constant_score(spark):
    rows = [(i, "m", 0, int(i % 4 == 0), 0, 0.3) for i in range(100)]
    out = metrics.classification_metrics(scored(spark, rows)).first()
    assert out["auc_roc"] == pytest.approx(0.5)
    assert out["auprc"] == pytest.approx(0.25)
    assert out["pr_auc"] == pytest.approx((0.25 + 1) / 2)
    assert out["kappa"] == pytest.approx(0)
    assert out["precision"] == 0 and out["f1"] == 0


def test_single_class_fold_and_null_scores(spark):
    rows = [(1, "m", 0, 0, 0, 0.1), (2, "m", 0, 0, 1, 0.9), (3, "m", 1, 1, 1, None), (4, "m", 1, 0, 0, 0.2), (5, "m", 1, 1, 1, 0.8)]
    out = {r["fold"]: r for r in metrics.classification_metrics(scored(spark, rows)).collect()}
    assert out[0]["auc_roc"] is None and out[0]["balanced_accuracy"] == 0.5
    assert out[1]["auc_roc"] == 1.0
    assert metrics.roc_points(scored(spark, rows)).where("fold = 0").count() == 0


def test_student_t():
    assert special.student_quantile(0.975, 9) == pytest.approx(2.2621571627, abs=1e-9)
    assert special.student_quantile(0.975, 1) == pytest.approx(12.7062047364, abs=1e-8)
    assert special.student_quantile(0.95, 4) == pytest.approx(2.1318467863, abs=1e-9)
    assert 2 * special.student_tail(2.0, 10) == pytest.approx(0.0733880348, abs=1e-9)


def test_chi2_tail():
    assert special.chi2_tail(3.841458821, 1) == pytest.approx(0.05, abs=1e-9)
    assert special.chi2_tail(7.814727903, 3) == pytest.approx(0.05, abs=1e-9)
    assert special.chi2_tail(9.487729037, 4) == pytest.approx(0.05, abs=1e-9)


def test_signed_rank():
    assert special.signed_rank_p(0, 10, 0, True) == pytest.approx(2 / 2**10)
    assert special.signed_rank_p(0, 0, 0, False) == 1.0


def test_cluster_crosstab_chi2(spark):
    counts = {(0, 0): 33990, (0, 1): 3429, (1, 0): 26681, (1, 1): 2544, (2, 0): 3034, (2, 1): 312}
    cells = spark.createDataFrame([(a, b, float(n)) for (a, b), n in counts.items()], "a int, b int, o double")
    out = profile.chi2_from_counts(cells).first()
    assert round(out["chi2"], 2) == 4.74 and out["dof"] == 2 and round(out["p_value"], 4) == 0.0935


def test_two_by_two_uses_continuity_correction(spark):
    cells = spark.createDataFrame([(0, 0, 10.0), (0, 1, 20.0), (1, 0, 30.0), (1, 1, 40.0)], "a int, b int, o double")
    out = profile.chi2_from_counts(cells).first()
    assert out["chi2"] == pytest.approx(0.4464285714, abs=1e-9) and out["p_value"] == pytest.approx(0.5040358664, abs=1e-9)


def test_recorded_costs(spark):
    rows = [(1, 1, 12), (0, 1, 6), (1, 0, 1245), (0, 0, 100)]
    df = spark.createDataFrame([("m", t, p) for t, p, n in rows for _ in range(n)], "model string, y_true int, y_pred int")
    assert metrics.expected_cost(df).first()["total_cost"] == -18_700_200
    assert metrics.expected_cost(df.where("y_true = 1").withColumn("y_pred", F.lit(0))).first()["total_cost"] == -18_855_000


def test_capacity_truncates(spark):
    df = spark.range(13998).select("id", F.lit("m").alias("model"), (F.col("id") % 11 == 0).cast("int").alias("y_true"), (F.col("id") / 13998).alias("y_prob"))
    got = {r["label"]: r["k"] for r in metrics.topk_capacity(df, ["id"]).collect()}
    assert got == {"top_5pct": 699, "top_10pct": 1399, "top_15pct": 2099, "top_20pct": 2799}


def test_fold_ci_identity_and_edge_cases(spark):
    rows = [("a", i, "f1", 0.1 * i) for i in range(10)] + [("b", 0, "f1", 0.5), ("b", 1, "f1", None), ("b", 2, "f1", float("nan"))]
    rows += [("c", i, "f1", 0.3) for i in range(4)]
    out = {r["model"]: r for r in significance.fold_ci(spark.createDataFrame(rows, "model string, fold int, metric string, value double")).collect()}
    a = out["a"]
    assert a["ci_upper"] - a["mean"] == pytest.approx(2.2621571627 * a["std"] / math.sqrt(10), abs=1e-9)
    assert out["b"]["std"] == 0 and out["b"]["ci_lower"] == out["b"]["mean"] == 0.5
    assert out["c"]["std"] == 0 and out["c"]["ci_upper"] == pytest.approx(0.3)


def test_paired_tests(spark):
    rows = [("zero_r", i, "f1", 0.0) for i in range(10)] + [("up", i, "f1", 0.1 + 0.01 * i) for i in range(10)]
    rows += [("same", i, "f1", 0.0) for i in range(10)] + [("flat", i, "f1", 0.25) for i in range(10)]
    out = {r["model"]: r for r in significance.paired_tests(spark.createDataFrame(rows, "model string, fold int, metric string, value double")).collect()}
    assert out["up"]["p_value_wilcoxon"] == pytest.approx(0.001953125) and out["up"]["significant_t"] == 1
    assert out["same"]["t_stat"] == 0 and out["same"]["p_value_t"] == 1 and out["same"]["p_value_wilcoxon"] == 1
    assert out["flat"]["t_stat"] == 0 and out["flat"]["p_value_t"] == 1  # no spread between folds


def test_recorded_rule(spark):
    sets = spark.createDataFrame([(["a"], 0.1714), (["b"], 1 / 1.4067), (["a", "b"], 0.1714)], "items array<string>, support double")
    out = rules.association_rules(sets, "lift", 1.2).where(F.array_contains("antecedents", "a")).first()
    assert out["support"] == 0.1714 and out["confidence"] == 1 and out["lift"] == pytest.approx(1.4067) and math.isinf(out["conviction"])
