"""Row filters, column edits, imputation and outlier handling."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_col, count_where, flag, melt, numeric_cols, other_cols, present, ratio
from .ordered import exact_quantiles, modes

# Discharge codes after which no return is possible.
TERMINAL_CODES = ("11", "13", "14", "19", "20", "21")


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.distinct()


def filter_terminal(df: DataFrame, column: str = "discharge_disposition_id",
                    excluded: Sequence[str] = TERMINAL_CODES) -> DataFrame:
    """Drop rows whose trimmed code is excluded; a null code stays, a missing column is a no-op."""
    if column not in df.columns:
        return df
    code = F.coalesce(F.trim(as_col(column).cast("string")), F.lit("nan"))
    return df.where(~code.isin([str(x).strip() for x in excluded]))


def first_event_per_entity(df: DataFrame, entity: str = "patient_nbr", event: str = "encounter_id",
                           tiebreak: Sequence[str] = ()) -> DataFrame:
    """First event of each entity by numeric event id (non-numeric last).

    ``row_number() = 1`` lets Spark keep one row per entity before the shuffle
    (WindowGroupLimit), so an entity with a third of all rows costs no more than others.
    """
    if entity not in df.columns or event not in df.columns:
        return df
    order = F.expr(f"try_cast(`{event}` as double)").asc_nulls_last()
    first = Window.partitionBy(as_col(entity)).orderBy(order, as_col(event), *[as_col(c) for c in tiebreak])
    return df.withColumn("__rn", F.row_number().over(first)).where("__rn = 1").drop("__rn")


def binary_target(df: DataFrame, column: str = "readmitted", positive: str = "<30",
                  name: str = "readmitted_binary") -> DataFrame:
    return df.withColumn(name, flag(as_col(column) == positive)).drop(column)


def drop_columns(df: DataFrame, columns: Sequence[str] = ("encounter_id", "patient_nbr")) -> DataFrame:
    return df.drop(*columns)


def feature_target_split(df: DataFrame, target: str, keys: Sequence[str] = ()) -> tuple[list[str], DataFrame]:
    """Feature names and one table (keys, features, label): rows stay together, nothing is aligned by position."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    feats = [c for c in df.columns if c != target and c not in keys]
    return feats, df.select(*[as_col(c) for c in (*keys, *feats)], as_col(target).alias("label"))


def select_by_dtype(df: DataFrame, numeric: bool = True) -> DataFrame:
    return df.select(*[as_col(c) for c in (numeric_cols(df) if numeric else other_cols(df))])


def cast_to_category(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: as_col(c).cast("string") for c in columns if c in df.columns})


def fill_constant(df: DataFrame, values: dict[str, str]) -> DataFrame:
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


def fit_impute(df: DataFrame, strategy: str = "median", categorical_fill: str = "Unknown",
               approx: bool = False) -> dict[str, float | str]:
    """One fill value per column: median or mean of numbers, a constant for the rest."""
    nums = numeric_cols(df)
    if strategy == "median":
        got = {r["column"]: r["q0"] for r in exact_quantiles(df, nums, [0.5], approx=approx).collect()} if nums else {}
    elif strategy == "mean":
        row = df.agg(*[F.avg(present(df, c)).alias(c) for c in nums]).first().asDict() if nums else {}
        got = {c: v for c, v in row.items() if v is not None}
    else:
        raise ValueError(f"unknown strategy {strategy!r}; use 'median' or 'mean'")
    return {**got, **{c: categorical_fill for c in other_cols(df)}}


def apply_fill(df: DataFrame, fills: dict[str, float | str]) -> DataFrame:
    """Fill nulls and NaN; numeric columns become double so that a fractional median is not cut."""
    out = {}
    for c, v in fills.items():
        if c in df.columns:
            col = present(df, c) if isinstance(v, str) else present(df, c).cast("double")
            out[c] = F.coalesce(col, F.lit(v))
    return df.withColumns(out) if out else df


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls and NaN with the most frequent value (smallest on ties)."""
    best = {r["column"]: r["top"] for r in modes(df.withColumns({c: present(df, c) for c in columns}), columns).collect()}
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(present(df, c), F.lit(best[c]).cast(types[c])) for c in columns if c in best}
    )


def impute_group_mode(df: DataFrame, column: str, helper: str) -> DataFrame:
    """Fill nulls with the mode inside the helper group; a group without values stays null."""
    best = modes(df, [column], by=[helper]).select(
        as_col(helper).alias("__helper"), F.col("top").cast(dict(df.dtypes)[column]).alias("__mode")
    )
    return (
        df.join(best, as_col(helper).eqNullSafe(F.col("__helper")), "left")
        .withColumn(column, F.coalesce(as_col(column), F.col("__mode")))
        .drop("__helper", "__mode")
    )


def fit_iqr_fences(df: DataFrame, columns: Sequence[str], approx: bool = False) -> dict[str, tuple[float, float]]:
    got = exact_quantiles(df, columns, [0.25, 0.75], approx=approx).collect()
    return {r["column"]: (r["q0"] - 1.5 * (r["q1"] - r["q0"]), r["q1"] + 1.5 * (r["q1"] - r["q0"])) for r in got}


def iqr_filter(df: DataFrame, columns: Sequence[str], fences: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Rows with every listed column inside its fences, all fences taken from the input table."""
    fences = fences or fit_iqr_fences(df, columns)
    cond = F.lit(True)
    for c, (lo, hi) in fences.items():
        cond &= as_col(c).between(F.lit(lo), F.lit(hi))
    return df.where(cond)


def iqr_outlier_report(df: DataFrame, columns: Sequence[str],
                       fences: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    fences = fences or fit_iqr_fences(df, columns)
    one = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[count_where((as_col(c) < F.lit(lo)) | (as_col(c) > F.lit(hi))).alias(c) for c, (lo, hi) in fences.items()],
    )
    return (
        melt(one, ["__n"], list(fences), "bigint", "column", "n_outliers")
        .select("column", "n_outliers", (ratio(F.col("n_outliers"), F.col("__n")) * 100).alias("pct_outliers"))
        .orderBy(F.desc("pct_outliers"), "column")
    )


# Characters that learners reject in column names.
NAME_PATTERN = r'[\[\]{}<>:,"]+'


def sanitize_name(name: str) -> str:
    return re.sub(NAME_PATTERN, "_", name)


def sanitize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[sanitize_name(c) for c in df.columns])


def leakage_check(df: DataFrame, forbidden: Sequence[str], required: Sequence[str]) -> DataFrame:
    """One row: forbidden columns present, required columns absent, missing cells, rows, columns."""
    bad = ", ".join(c for c in forbidden if c in df.columns)
    gone = ", ".join(c for c in required if c not in df.columns)
    missing: Column = F.lit(0).cast("long")
    for c in df.columns:
        missing = missing + count_where(present(df, c).isNull())
    return df.agg(
        F.lit(bad).alias("forbidden_present"),
        F.lit(gone).alias("required_absent"),
        missing.alias("total_missing"),
        F.count(F.lit(1)).alias("n_rows"),
    ).withColumn("n_columns", F.lit(len(df.columns)))


def row_sample(df: DataFrame, ids: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows without replacement, the same rows on every run (top-k by hash, no full sort)."""
    from .ordered import hash_order

    return df.withColumn("__h", hash_order(seed, *ids)).orderBy("__h").limit(n).drop("__h")
