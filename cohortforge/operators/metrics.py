"""Evaluation of a scored table (keys..., y_true, y_pred, y_prob), always per group of ``keys``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_col, count_where, melt, ratio
from ..session import shuffle_width
from .ordered import BUCKET, hash_order, running_totals

KEYS = ("model", "fold")

# Cost of each outcome.
COSTS = {"TP": -2000.0, "TN": 0.0, "FP": -200.0, "FN": -15000.0}
TOP_FRACTIONS = (0.05, 0.10, 0.15, 0.20)
TUNE_METRICS = ("precision", "recall", "f1", "balanced_accuracy")
SWEEP_GRID = tuple(0.05 + 0.05 * i for i in range(19))
TUNE_GRID = tuple(0.10 + 0.05 * i for i in range(17))


def _cells(true: Column, pred: Column) -> dict[str, Column]:
    return {
        "tp": count_where((true == 1) & (pred == 1)),
        "tn": count_where((true == 0) & (pred == 0)),
        "fp": count_where((true == 0) & (pred == 1)),
        "fn": count_where((true == 1) & (pred == 0)),
    }


def confusion_matrix(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Counts per (true, predicted) label."""
    return df.groupBy(*keys, "y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))


def confusion_counts(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return df.groupBy(*keys).agg(*[v.alias(k) for k, v in _cells(F.col("y_true"), F.col("y_pred")).items()])


def hard_metric_columns() -> dict[str, Column]:
    """Metrics from tp, tn, fp, fn columns; undefined precision, recall and F1 are 0."""
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    n, pos, neg = tp + tn + fp + fn, tp + fn, tn + fp
    f1 = ratio(2 * tp, 2 * tp + fp + fn)
    f0 = ratio(2 * tn, 2 * tn + fp + fn)
    chance = ratio((tp + fp) * pos + (tn + fn) * neg, n * n, None)
    both = ratio(tp, pos, None), ratio(tn, neg, None)
    return {
        "accuracy": ratio(tp + tn, n, None),
        "balanced_accuracy": F.when(both[0].isNull(), both[1]).when(both[1].isNull(), both[0]).otherwise((both[0] + both[1]) / 2),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, pos),
        "f1": f1,
        "f1_weighted": ratio(f1 * pos + f0 * neg, n, None),
        "kappa": ratio(ratio(tp + tn, n, None) - chance, 1 - chance, None),
    }


def hard_metrics(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return confusion_counts(df, keys).select(*keys, *[v.alias(k) for k, v in hard_metric_columns().items()])


def brier(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    d = F.col("y_prob") - F.col("y_true")
    return df.where(F.col("y_prob").isNotNull()).groupBy(*keys).agg(F.avg(d * d).alias("brier_score"))


def score_curve(df: DataFrame, keys: Sequence[str] = KEYS, following: bool = False) -> DataFrame:
    """One row per distinct score, descending: own and cumulative positives and negatives, and the totals."""
    rows = df.where(F.col("y_prob").isNotNull() & ~F.isnan("y_prob")).withColumnRenamed("y_prob", "score")
    per_score = (
        rows.groupBy(*keys, "score")
        .agg(F.sum((F.col("y_true") == 1).cast("long")).alias("pos"), F.sum((F.col("y_true") != 1).cast("long")).alias("neg"))
    )
    return running_totals(per_score, keys, "score", ["pos", "neg"], descending=True, following=following, raw=rows)


def curve_metrics(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """AUC (ties count half), average precision and trapezoidal PR area from one shared curve.

    Groups with a single class have no row, as those areas are undefined there.
    """
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "cum_pos", "cum_neg"))
    all_pos, all_neg = F.col("total_pos").cast("double"), F.col("total_neg").cast("double")
    before_tp, before_fp = tp - pos, fp - neg
    precision = tp / (tp + fp)
    before = F.when(before_tp + before_fp > 0, F.try_divide(before_tp, before_tp + before_fp)).otherwise(F.lit(1.0))
    return (
        score_curve(df, keys)
        .where((F.col("total_pos") > 0) & (F.col("total_neg") > 0))
        .groupBy(*keys)
        .agg(
            F.sum(pos * (all_neg - fp + neg / 2) / (all_pos * all_neg)).alias("auc_roc"),
            F.sum(pos / all_pos * precision).alias("auprc"),
            F.sum(pos / all_pos * (precision + before) / 2).alias("pr_auc"),
        )
    )


def classification_metrics(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The full suite, one row per group; score metrics are null where undefined."""
    hard = hard_metrics(df, keys)
    soft = curve_metrics(df, keys).join(brier(df, keys), list(keys))
    return hard.join(soft, list(keys), "left")


def metrics_long(wide: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return melt(wide, keys, [c for c in wide.columns if c not in keys], "double", "metric", "value")


def topk_capacity(df: DataFrame, ids: Sequence[str], keys: Sequence[str] = ("model",),
                  fractions: Sequence[float] = TOP_FRACTIONS, seed: int = 0) -> DataFrame:
    """Precision and recall among the top fraction by score; ties are cut in hash order of the id.

    Whole scores above the cut are counted from the score curve. Only the rows tied at a cut are
    ranked one by one, in even hash buckets, so even a score shared by most rows is spread out.
    """
    curve = score_curve(df, keys).withColumn("n", F.col("total_pos") + F.col("total_neg"))
    cuts = F.array(
        *[
            F.struct(F.lit(f"top_{int(f * 100)}pct").alias("label"), F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(float(f)))).alias("k"))
            for f in fractions
        ]
    )
    tp, seen = F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")
    edge = (
        curve.withColumn("cut", F.explode(cuts))
        .where((seen >= F.col("cut.k")) & (seen - F.col("pos") - F.col("neg") < F.col("cut.k")))
        .select(
            *keys,
            F.col("cut.label").alias("label"),
            F.col("cut.k").alias("k"),
            F.col("score"),
            F.col("total_pos"),
            F.col("pos"),
            F.col("neg"),
            (tp - F.col("pos")).alias("tp_above"),
            (F.col("cut.k") - (seen - F.col("pos") - F.col("neg"))).alias("need"),
        )
    )
    tie_keys = [*keys, "score"]
    tied = (
        df.withColumnRenamed("y_prob", "score")
        .join(edge.select(*tie_keys).distinct(), tie_keys, "left_semi")
        .select(*tie_keys, (F.col("y_true") == 1).cast("long").alias("hit"), hash_order(seed, *ids).alias("h"))
        .withColumn(BUCKET, F.substring("h", 1, 2 if shuffle_width(df.sparkSession) <= 64 else 3))
    )
    sums = tied.groupBy(*tie_keys, BUCKET).agg(F.count(F.lit(1)).alias("bn"), F.sum("hit").alias("bhit"))
    per = Window.partitionBy(*tie_keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offs = sums.select(
        *tie_keys,
        BUCKET,
        F.coalesce(F.sum("bn").over(per), F.lit(0)).alias("o_n"),
        F.coalesce(F.sum("bhit").over(per), F.lit(0)).alias("o_hit"),
        "bn",
    )
    # The bucket in which each cut falls, then the rows of that bucket only.
    at = edge.join(offs, tie_keys).where((F.col("o_n") < F.col("need")) & (F.col("o_n") + F.col("bn") >= F.col("need")))
    inside = Window.partitionBy(*tie_keys, BUCKET).orderBy("h")
    ranked = tied.join(at.select(*tie_keys, BUCKET).distinct(), [*tie_keys, BUCKET], "left_semi").select(
        *tie_keys, BUCKET, "hit", F.row_number().over(inside).alias("r")
    )
    return (
        at.join(ranked, [*tie_keys, BUCKET])
        .groupBy(*keys, "label", "k")
        .agg(
            (
                F.first("tp_above")
                + F.first("o_hit")
                + count_where((F.col("hit") == 1) & (F.col("r") <= F.col("need") - F.col("o_n")))
            ).alias("tp_at_k"),
            F.first("total_pos").alias("total_pos"),
        )
        .select(
            *keys,
            "label",
            "k",
            ratio(F.col("tp_at_k"), F.col("k")).alias("precision_at_k"),
            ratio(F.col("tp_at_k"), F.col("total_pos")).alias("recall_at_k"),
        )
    )


def roc_points(df: DataFrame, keys: Sequence[str] = KEYS, drop_collinear: bool = True) -> DataFrame:
    """(fpr, tpr, threshold) with the start point (0, 0, inf); inner points on a straight line are dropped."""
    curve = score_curve(df, keys, following=drop_collinear).where((F.col("total_pos") > 0) & (F.col("total_neg") > 0))
    pts = curve
    if drop_collinear:
        first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
        bend = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
        pts = pts.where(first | F.col("next_pos").isNull() | bend)
    pts = pts.select(
        *keys,
        (F.col("cum_neg") / F.col("total_neg")).alias("fpr"),
        (F.col("cum_pos") / F.col("total_pos")).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    start = curve.select(*keys).distinct().select(
        *keys, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    return pts.unionByName(start)


def pr_points(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(recall, precision, threshold, prevalence) with the end point (0, 1)."""
    curve = score_curve(df, keys).where(F.col("total_pos") > 0)
    base = F.col("total_pos") / (F.col("total_pos") + F.col("total_neg"))
    pts = curve.select(
        *keys,
        (F.col("cum_pos") / F.col("total_pos")).alias("recall"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.col("score").alias("threshold"),
        base.alias("prevalence"),
    )
    end = curve.groupBy(*keys).agg(F.first(base).alias("prevalence")).select(
        *keys, F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"), F.lit(None).cast("double").alias("threshold"), "prevalence"
    )
    return pts.unionByName(end)


def calibration_curve(df: DataFrame, keys: Sequence[str] = ("model",), bins: int = 10) -> DataFrame:
    """Observed and predicted rate per uniform bin; a score on an inner edge belongs to the lower bin."""
    p = F.col("y_prob")
    slot = F.lit(0)
    for i in range(1, bins):
        slot = slot + (p > F.lit(i / bins)).cast("int")
    return (
        df.where(p.isNotNull() & ~F.isnan(p))
        .groupBy(*keys, slot.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.col("y_true").cast("double")).alias("fraction_of_positives"),
            F.avg(p).alias("mean_predicted_value"),
        )
    )


def _cost(costs: Mapping[str, float]) -> Column:
    return sum((F.col(k.lower()) * F.lit(float(costs[k])) for k in ("TP", "TN", "FP", "FN")), F.lit(0.0))


def expected_cost(df: DataFrame, keys: Sequence[str] = ("model",), costs: Mapping[str, float] = COSTS) -> DataFrame:
    n = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    return (
        confusion_counts(df, keys)
        .withColumn("total_cost", _cost(costs))
        .withColumn("avg_cost_per_patient", ratio(F.col("total_cost"), n))
        .select(*keys, "total_cost", "avg_cost_per_patient", "tp", "tn", "fp", "fn")
    )


def threshold_counts(df: DataFrame, grid: Sequence[float], keys: Sequence[str] = ("model",)) -> DataFrame:
    """tp, fp, fn, tn at every threshold in one pass over the rows.

    A row is counted once, under the number of thresholds it reaches; the running sums then go
    over that small table only, so rows are never repeated per threshold.
    """
    grid = sorted(float(g) for g in grid)
    reached = F.lit(0)
    for g in grid:
        reached = reached + F.coalesce((F.col("y_prob") >= F.lit(g)).cast("int"), F.lit(0))
    tally = df.groupBy(*keys, reached.alias("reached")).agg(
        count_where(F.col("y_true") == 1).alias("p"), count_where(F.col("y_true") != 1).alias("n")
    )
    points = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(g).alias("t")) for i, g in enumerate(grid)])
    hit = F.col("reached") >= F.col("g.i")
    total = lambda cond, c: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0)).cast("long")
    return (
        tally.withColumn("g", F.explode(points))
        .groupBy(*keys, F.col("g.t").alias("threshold"))
        .agg(total(hit, "p").alias("tp"), total(hit, "n").alias("fp"), total(~hit, "p").alias("fn"), total(~hit, "n").alias("tn"))
    )


def cost_sweep(df: DataFrame, keys: Sequence[str] = ("model",), costs: Mapping[str, float] = COSTS,
               grid: Sequence[float] = SWEEP_GRID) -> DataFrame:
    m = hard_metric_columns()
    n = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    return threshold_counts(df, grid, keys).select(
        *keys,
        "threshold",
        _cost(costs).alias("total_cost"),
        ratio(_cost(costs), n).alias("avg_cost"),
        m["recall"].alias("recall"),
        m["precision"].alias("precision"),
        m["f1"].alias("f1"),
        "tp", "fp", "fn", "tn",
    )


def cost_optimum(sweep: DataFrame, keys: Sequence[str] = ("model",), best: str = "max") -> DataFrame:
    """The sweep row with the best total cost, lowest threshold on ties.

    Costs are negative, so the best total is the largest; ``best='min'`` picks the smallest number.
    """
    if best not in ("min", "max"):
        raise ValueError("best must be 'min' or 'max'")
    order = F.col("total_cost").desc() if best == "max" else F.col("total_cost").asc()
    per = Window.partitionBy(*keys).orderBy(order, F.col("threshold"))  # one row per threshold
    return sweep.withColumn("__r", F.row_number().over(per)).where("__r = 1").drop("__r")


def tune_threshold(df: DataFrame, metric: str = "f1", keys: Sequence[str] = ("model",),
                   grid: Sequence[float] = TUNE_GRID) -> DataFrame:
    """Score table per threshold; ``is_best`` marks the lowest threshold with the best score."""
    if metric not in TUNE_METRICS:
        raise ValueError(f"unknown metric {metric!r}; use one of {', '.join(TUNE_METRICS)}")
    m = hard_metric_columns()
    table = threshold_counts(df, grid, keys).select(*keys, "threshold", *[m[c].alias(c) for c in TUNE_METRICS])
    best = table.groupBy(*keys).agg(
        F.max_by("threshold", F.struct(F.col(metric), -F.col("threshold"))).alias("__best")
    )
    return (
        table.join(best, list(keys))
        .withColumn("is_best", (F.col("threshold") == F.col("__best")).cast("int"))
        .drop("__best")
        .orderBy(*keys, F.desc(metric), "threshold")
    )


def operating_points(df: DataFrame, points: Mapping[str, float], keys: Sequence[str] = ("model",),
                     costs: Mapping[str, float] = COSTS) -> DataFrame:
    """Cost and hit rates at named thresholds, side by side."""
    name = F.lit(None).cast("string")
    sweeps = cost_sweep(df, keys, costs, sorted(set(points.values())))
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(v)).alias("v")) for k, v in points.items()])
    return (
        sweeps.withColumn("p", F.explode(pairs)).where(F.col("p.v") == F.col("threshold"))
        .withColumn("operating_point", F.coalesce(F.col("p.k"), name)).drop("p")
    )


def classification_report(df: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Per class precision, recall, F1 and support, plus accuracy, macro and weighted rows (any number of classes)."""
    cells = confusion_matrix(df, keys)
    side = lambda c: cells.groupBy(*keys, F.col(c).cast("string").alias("label")).agg(F.sum("n").alias("s"))
    hits = cells.where("y_true = y_pred").select(*keys, F.col("y_true").cast("string").alias("label"), F.col("n").alias("hit"))
    t = side("y_true").withColumnRenamed("s", "support")
    p = side("y_pred").withColumnRenamed("s", "predicted")
    per = (
        t.join(p, [*keys, "label"], "full")
        .join(hits, [*keys, "label"], "left")
        .fillna(0, ["support", "predicted", "hit"])
        .select(
            *keys,
            "label",
            ratio(F.col("hit"), F.col("predicted")).alias("precision"),
            ratio(F.col("hit"), F.col("support")).alias("recall"),
            ratio(2 * F.col("hit"), F.col("predicted") + F.col("support")).alias("f1"),
            "support",
            "hit",
        )
    )
    stats = ("precision", "recall", "f1")
    whole = per.groupBy(*keys)
    acc = F.sum("hit") / F.sum("support")
    rows = [
        per.drop("hit"),
        whole.agg(F.lit("accuracy").alias("label"), *[acc.alias(c) for c in stats], F.sum("support").alias("support")),
        whole.agg(F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in stats], F.sum("support").alias("support")),
        whole.agg(
            F.lit("weighted avg").alias("label"),
            *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in stats],
            F.sum("support").alias("support"),
        ),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def regression_metrics(df: DataFrame, keys: Sequence[str] = (), true: str = "y_true", pred: str = "y_pred") -> DataFrame:
    y, e = as_col(true).cast("double"), as_col(true) - as_col(pred)
    out = df.groupBy(*keys).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.avg(e * e), F.var_pop(y))).alias("r2"),
    )
    return out


def residuals(df: DataFrame, true: str = "y_true", pred: str = "y_pred") -> DataFrame:
    return df.withColumn("residual", as_col(true) - as_col(pred))


def assemble_oof(rows: DataFrame, predictions: DataFrame, ids: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Out-of-fold predictions for all rows: missing prediction -1, missing probability null."""
    scored = predictions.select(*ids, *[k for k in keys if k not in ids], "y_pred", "y_prob")
    return rows.join(scored, [*ids, *[k for k in keys if k not in ids]], "left").withColumn(
        "y_pred", F.coalesce("y_pred", F.lit(-1))
    )
