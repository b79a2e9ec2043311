"""Profiling and summary statistics over whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_col, count_where, melt, numeric_cols, other_cols, present, ratio
from ..functions.special import chi2_p
from .ordered import exact_quantiles, modes, value_counts_long


def missing_profile(df: DataFrame) -> DataFrame:
    """Count and percent of missing cells (null or NaN) per column, columns without any left out."""
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[count_where(present(df, c).isNull()).alias(c) for c in df.columns])
    return (
        melt(one, ["__n"], df.columns, "bigint", "column", "n_missing")
        .where("n_missing > 0")
        .select("column", "n_missing", (ratio(F.col("n_missing"), F.col("__n")) * 100).alias("pct_missing"))
        .orderBy(F.desc("n_missing"), "column")
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier identical row (nulls equal), combined map-side."""
    return df.groupBy(*[as_col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n")).agg(
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("n_duplicates"),
        F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("n_rows"),
    )


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    rows = df.where(as_col(column).isNotNull()) if dropna else df
    return (
        rows.groupBy(as_col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")
    )


def cardinality(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column."""
    cols = list(columns or df.columns)
    if approx:
        one = df.agg(*[F.approx_count_distinct(as_col(c)).alias(c) for c in cols])
        out = melt(one, [], cols, "bigint", "column", "n_unique")
    else:
        out = value_counts_long(df, cols, "string").groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
    return out.orderBy(F.desc("n_unique"), "column")


def _moments(df: DataFrame, cols: Sequence[str], stats: dict) -> DataFrame:
    """One pass over all columns, then one row per column."""
    one = df.agg(*[F.struct(*[f(as_col(c)).alias(s) for s, f in stats.items()]).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), as_col(c).alias("s")) for c in cols])
    return one.select(F.explode(pairs).alias("p")).select("p.column", "p.s.*")


def describe_subset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _moments(
        df,
        columns,
        {
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": lambda c: F.min(c.cast("double")),
            "max": lambda c: F.max(c.cast("double")),
        },
    )


def describe_all(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """count, unique, top, freq (text columns) and mean, std, min, quartiles, max (numeric columns)."""
    df = df.select(*[as_col(c) for c in columns]) if columns else df
    nums, texts = numeric_cols(df), other_cols(df)
    head = ("column", "count", "unique", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max")
    parts = []
    if nums:
        m = _moments(
            df,
            nums,
            {
                "count": F.count,
                "mean": F.avg,
                "std": F.stddev_samp,
                "min": lambda c: F.min(c.cast("double")),
                "max": lambda c: F.max(c.cast("double")),
            },
        )
        q = exact_quantiles(df, nums, [0.25, 0.5, 0.75], approx=approx).select(
            "column", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75")
        )
        parts.append(m.join(q, "column", "left"))
    if texts:
        counts = _moments(df, texts, {"count": F.count})
        parts.append(counts.join(modes(df, texts), "column", "left"))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    blank = {"unique": "bigint", "top": "string", "freq": "bigint"} | {
        c: "double" for c in ("mean", "std", "min", "p25", "p50", "p75", "max")
    }
    return out.select(
        *[F.col(c) if c in out.columns else F.lit(None).cast(blank[c]).alias(c) for c in head]
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """Position, column, type and non-null count."""
    one = df.agg(*[F.count(as_col(c)).alias(c) for c in df.columns])
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("dtype"), as_col(c).alias("non_null"))
            for i, (c, t) in enumerate(df.dtypes)
        ]
    )
    return one.select(F.explode(pairs).alias("p")).select("p.*")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns as (a, b, corr), in one aggregation."""
    cols = list(columns or numeric_cols(df))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[F.corr(as_col(a).cast("double"), as_col(b).cast("double")).alias(f"{a}\t{b}") for a, b in pairs])
    cells = F.array(
        *[
            F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), as_col(f"{a}\t{b}").alias("corr"))
            for a, b in pairs
            for x, y in ({(a, b), (b, a)})
        ]
    )
    return one.select(F.explode(cells).alias("p")).select("p.*")


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over min..max, the last bin closed; empty bins are not listed."""
    x = as_col(column).cast("double")
    lo, hi, n = df.agg(F.min(x), F.max(x), F.count(x)).first()
    if n == 0:
        lo, hi = 0.0, 1.0
    elif lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    slot = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (
        df.where(x.isNotNull())
        .groupBy(slot.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left_edge"),
            "n",
            (F.col("n") / F.lit(float(max(n, 1)) * width)).alias("density"),
        )
    )


def boxplot_stats(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Quartiles, whiskers (furthest value inside 1.5 IQR) and outlier count per column and group."""
    ids = [by] if by else []
    counts = value_counts_long(df, columns, "double", ids)
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75], by=ids)
    q = q.withColumns(
        {"lo": F.col("q0") - 1.5 * (F.col("q2") - F.col("q0")), "hi": F.col("q2") + 1.5 * (F.col("q2") - F.col("q0"))}
    ).drop("n")
    inside = F.col("value").between(F.col("lo"), F.col("hi"))
    return (
        counts.join(q, [*ids, "column"])
        .groupBy(*ids, "column")
        .agg(
            F.sum("n").alias("n"),
            F.min("value").alias("min"),
            F.first("q0").alias("q1"),
            F.first("q1").alias("median"),
            F.first("q2").alias("q3"),
            F.max("value").alias("max"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_outliers"),
        )
    )


def skew_g1(c):
    """Bias-corrected sample skewness of a column (0 without spread, null below three values)."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.coalesce(F.try_divide(F.skewness(c) * F.sqrt(n * (n - 1)), n - 2), F.lit(0.0)))


def skewness(df: DataFrame, columns: Sequence[str], threshold: float = 1.0) -> DataFrame:
    out = _moments(df, columns, {"skew": skew_g1})
    return out.withColumn("is_skewed", F.coalesce((F.abs("skew") > threshold).cast("int"), F.lit(0)))


def crosstab_margins(df: DataFrame, a: str, b: str, margin: str = "All") -> DataFrame:
    """Contingency counts in long form with margins."""
    rows = df.where(as_col(a).isNotNull() & as_col(b).isNotNull())
    label = lambda c: F.when(F.grouping(c) == 1, F.lit(margin)).otherwise(as_col(c).cast("string"))
    return rows.cube(a, b).agg(
        label(a).alias(f"{a}_level"), label(b).alias(f"{b}_level"), F.count(F.lit(1)).alias("n")
    ).select(f"{a}_level", f"{b}_level", "n")


def chi2_independence(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson chi-squared test of two columns; 2x2 tables use the continuity correction."""
    cells = (
        df.where(as_col(a).isNotNull() & as_col(b).isNotNull())
        .groupBy(as_col(a).alias("a"), as_col(b).alias("b"))
        .agg(F.count(F.lit(1)).cast("double").alias("o"))
    )
    return chi2_from_counts(cells)


def chi2_from_counts(cells: DataFrame) -> DataFrame:
    """The test from a contingency table (a, b, o); absent cells count as zero."""
    rows = cells.groupBy("a").agg(F.sum("o").alias("r"), F.count(F.lit(1)).alias("nr"))
    cols = cells.groupBy("b").agg(F.sum("o").alias("c"), F.count(F.lit(1)).alias("nc"))
    one = (
        cells.join(rows, "a")
        .join(cols, "b")
        .agg(
            F.sum("o").alias("n"),
            F.count_distinct("a").alias("kr"),
            F.count_distinct("b").alias("kc"),
            F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))).alias("s"),
            F.sum(1 / (F.col("r") * F.col("nr"))).alias("ir"),
            F.sum(1 / (F.col("c") * F.col("nc"))).alias("ic"),
            F.max_by(F.struct("o", "r", "c"), F.struct("a", "b")).alias("cell"),
        )
    )
    gap = F.abs(F.col("cell.o") - F.col("cell.r") * F.col("cell.c") / F.col("n"))
    left = gap - F.least(F.lit(0.5), gap)
    dof = (F.col("kr") - 1) * (F.col("kc") - 1)
    return one.select(
        F.when(dof == 1, left * left * F.col("n") * F.col("ir") * F.col("ic"))
        .otherwise(F.col("n") * (F.col("s") - 1))
        .alias("chi2"),
        dof.alias("dof"),
        F.col("n").cast("long").alias("n"),
    ).withColumn("p_value", F.when(F.col("dof") == 0, F.lit(1.0)).otherwise(chi2_p(F.col("chi2"), F.greatest("dof", F.lit(1)))))


def expected_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Observed and expected count of every observed cell."""
    cells = df.groupBy(as_col(a).alias("a"), as_col(b).alias("b")).agg(F.count(F.lit(1)).alias("observed"))
    rows = cells.groupBy("a").agg(F.sum("observed").alias("r"))
    cols = cells.groupBy("b").agg(F.sum("observed").alias("c"))
    total = df.count()
    return cells.join(rows, "a").join(cols, "b").select(
        "a", "b", "observed", (F.col("r") * F.col("c") / F.lit(float(total))).alias("expected")
    )


def group_mean_profile(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(group).agg(*[F.avg(as_col(c)).alias(c) for c in columns])


def named_group_agg(df: DataFrame, group: str, target: str, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """Size, target rate and column means per group, rounded."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(as_col(target)), digits).alias("target_rate"),
        *[F.round(F.avg(as_col(c)), digits).alias(f"{c}_mean") for c in columns],
    )


def group_zscore(profile: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """z-score of group means across groups."""
    stats = profile.agg(
        *[F.avg(as_col(c)).alias(f"m_{c}") for c in columns], *[F.stddev_samp(as_col(c)).alias(f"s_{c}") for c in columns]
    ).first()
    return profile.select(
        group,
        *[
            F.try_divide(as_col(c) - F.lit(stats[f"m_{c}"]), F.lit(stats[f"s_{c}"]).cast("double")).alias(c)
            for c in columns
        ],
    )


def target_rate_by_group(df: DataFrame, group: str, target: str) -> DataFrame:
    """Mean target per group plus the overall row ``All``."""
    return (
        df.where(as_col(group).isNotNull())
        .rollup(group)
        .agg(
            F.when(F.grouping(group) == 1, F.lit("All")).otherwise(as_col(group).cast("string")).alias("level"),
            F.count(F.lit(1)).alias("n"),
            F.avg(as_col(target)).alias("target_rate"),
        )
        .select("level", "n", "target_rate")
    )


def anova_f(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """One-way F statistic of each feature against the label."""
    long = melt(df, [label], columns, "double").where(F.col("value").isNotNull())
    cells = long.groupBy("column", label).agg(
        F.count("value").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v")
    )
    per = Window.partitionBy("column")  # one row per class in each window
    grand = F.sum(F.col("n") * F.col("m")).over(per) / F.sum("n").over(per)
    ss = (
        cells.withColumn("d", F.col("m") - grand)
        .groupBy("column")
        .agg(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("k"),
            F.sum(F.col("n") * F.col("d") * F.col("d")).alias("between"),
            F.sum(F.col("n") * F.col("v")).alias("within"),
        )
    )
    return ss.select(
        "column",
        F.try_divide(F.col("between") * (F.col("n") - F.col("k")), F.col("within") * (F.col("k") - 1)).alias("f_stat"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    size, k = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    return counts.withColumn("weight", F.lit(float(size or 0)) / (F.lit(float(k)) * F.col("n")))


def scale_pos_weight(df: DataFrame, label: str) -> DataFrame:
    """negatives / positives, with at least one positive assumed."""
    return df.agg(count_where(as_col(label) == 0).alias("negatives"), count_where(as_col(label) == 1).alias("positives")).withColumn(
        "scale_pos_weight", F.col("negatives") / F.greatest(F.col("positives"), F.lit(1))
    )


def adjusted_rand_index(df: DataFrame, a: str, b: str) -> DataFrame:
    """Agreement of two labelings, from their contingency table."""
    cells = df.groupBy(as_col(a).alias("a"), as_col(b).alias("b")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    pairs = lambda c: F.sum(F.col(c) * (F.col(c) - 1) / 2)
    whole = cells.agg(pairs("n").alias("both"), F.sum("n").alias("n"))
    left = cells.groupBy("a").agg(F.sum("n").alias("n")).agg(pairs("n").alias("pa"))
    right = cells.groupBy("b").agg(F.sum("n").alias("n")).agg(pairs("n").alias("pb"))
    # Three one-row tables, put side by side as rows and summed.
    flat = whole.unionByName(left, True).unionByName(right, True).agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("both", "n", "pa", "pb")]
    )
    chance = F.col("pa") * F.col("pb") / (F.col("n") * (F.col("n") - 1) / 2)
    top = (F.col("pa") + F.col("pb")) / 2
    return flat.select(
        F.col("n").cast("long").alias("n"),
        F.coalesce(F.try_divide(F.col("both") - chance, top - chance), F.lit(1.0)).alias("ari"),
    )


def min_cluster_fraction(df: DataFrame, cluster: str, floor: float = 0.01) -> DataFrame:
    """Smallest cluster share, number of clusters, and whether the clustering is degenerate."""
    return (
        df.groupBy(cluster)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg((F.min("n") / F.sum("n")).alias("min_fraction"), F.count(F.lit(1)).alias("n_clusters"))
        .withColumn("is_degenerate", ((F.col("min_fraction") < floor) | (F.col("n_clusters") < 2)).cast("int"))
    )
