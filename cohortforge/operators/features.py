"""Derived columns, rule-driven numeric transforms and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.exprs import as_col, flag, ratio
from .ordered import exact_quantiles
from .profile import skew_g1

SKEW_LIMIT = 1.0
TRANSFORMS = ("none", "standardize", "log1p", "log1p_then_standardize", "optional_log1p")

# Transform per column and model.
NUMERIC_RULES: dict[str, dict[str, str]] = {
    "time_in_hospital": {"knn": "standardize", "decision_tree": "none", "logistic_regression": "standardize", "gaussian_nb": "optional_log1p"},
    "num_lab_procedures": {"knn": "standardize", "decision_tree": "none", "logistic_regression": "standardize", "gaussian_nb": "none"},
    "num_procedures": {"knn": "log1p_then_standardize", "decision_tree": "none", "logistic_regression": "log1p_then_standardize", "gaussian_nb": "log1p"},
    "num_medications": {"knn": "standardize", "decision_tree": "none", "logistic_regression": "standardize", "gaussian_nb": "none"},
    "number_outpatient": {"knn": "log1p_then_standardize", "decision_tree": "none", "logistic_regression": "log1p_then_standardize", "gaussian_nb": "log1p"},
    "number_emergency": {"knn": "log1p_then_standardize", "decision_tree": "none", "logistic_regression": "log1p_then_standardize", "gaussian_nb": "log1p"},
    "number_inpatient": {"knn": "log1p_then_standardize", "decision_tree": "none", "logistic_regression": "log1p_then_standardize", "gaussian_nb": "log1p"},
    "number_diagnoses": {"knn": "standardize", "decision_tree": "none", "logistic_regression": "standardize", "gaussian_nb": "none"},
}

# Medication columns.
MEDICATIONS = (
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride", "acetohexamide",
    "glipizide", "glyburide", "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose",
    "miglitol", "troglitazone", "tolazamide", "examide", "citoglipton", "insulin",
    "glyburide-metformin", "glipizide-metformin", "glimepiride-pioglitazone",
    "metformin-rosiglitazone", "metformin-pioglitazone",
)


def total_prior_visits(cols: Sequence[str] = ("number_outpatient", "number_emergency", "number_inpatient")) -> Column:
    out = as_col(cols[0])
    for c in cols[1:]:
        out = out + as_col(c)
    return out


def rate_per_day(amount: str, days: str) -> Column:
    """amount / days; zero or missing days give 0."""
    return ratio(as_col(amount), as_col(days), 0.0)


def row_count_where_not(cols: Sequence[str], value: str = "No") -> Column:
    """How many of the columns differ from ``value`` (a null counts as different)."""
    out = F.lit(0)
    for c in cols:
        out = out + F.coalesce((as_col(c).cast("string") != value).cast("int"), F.lit(1))
    return out


def row_count_in(cols: Sequence[str], values: Sequence[str]) -> Column:
    out = F.lit(0)
    for c in cols:
        out = out + flag(as_col(c).cast("string").isin(list(values)))
    return out


def row_distinct_count(cols: Sequence[str], ignore: Sequence[str] = ("Other", "NA", "nan", "None")) -> Column:
    """Distinct non-null values over the columns of one row, ignoring some labels."""
    values = F.array_compact(F.array_distinct(F.array(*[as_col(c).cast("string") for c in cols])))
    return F.size(F.array_except(values, F.array(*[F.lit(x) for x in ignore])))


def add_clinical_features(df: DataFrame) -> DataFrame:
    """All engineered encounter columns in one projection per dependency level."""
    meds = [c for c in MEDICATIONS if c in df.columns]
    diag = [c for c in ("diag_1", "diag_2", "diag_3") if c in df.columns]
    level1 = {
        **{f"{c}_group": codes.icd9_group(as_col(c)) for c in diag},
        "age_ordinal": codes.age_ordinal(F.col("age")),
        "total_prior_visits": total_prior_visits(),
        "labs_per_day": rate_per_day("num_lab_procedures", "time_in_hospital"),
        "meds_per_day": rate_per_day("num_medications", "time_in_hospital"),
        "num_active_meds": row_count_where_not(meds),
        "total_drug_changes": row_count_in(meds, ("Up", "Down")),
        "any_diabetes_med_change": flag(F.col("change") == "Ch"),
        "insulin_changed": flag(F.col("insulin").isin("Up", "Down")),
        "a1c_abnormal": flag(F.col("A1Cresult").isin(">7", ">8")),
        "glu_abnormal": flag(F.col("max_glu_serum").isin(">200", ">300")),
        "admission_type_group": codes.code_group(F.col("admission_type_id"), codes.ADMISSION_GROUPS),
        "discharge_group": codes.code_group(F.col("discharge_disposition_id"), codes.DISCHARGE_GROUPS),
        "admission_source_group": codes.code_group(F.col("admission_source_id"), codes.SOURCE_GROUPS),
    }
    level2 = {
        "both_abnormal": F.col("a1c_abnormal") * F.col("glu_abnormal"),
        "comorbidity_count": row_distinct_count([f"{c}_group" for c in diag]) if diag else F.lit(0),
    }
    return df.withColumns(level1).withColumns(level2)


def interaction_term(df: DataFrame, a: str, b: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"{a}_x_{b}", as_col(a) * as_col(b))


def log_transform(df: DataFrame, columns: Sequence[str], offset: float = 1.0) -> DataFrame:
    return df.withColumns({f"log_{c}": F.ln(as_col(c) + F.lit(offset)) for c in columns})


def fit_quantile_edges(df: DataFrame, column: str, bins: int = 4, approx: bool = False) -> list[float]:
    """Equal-frequency edges, duplicates dropped."""
    row = exact_quantiles(df, [column], [i / bins for i in range(bins + 1)], approx=approx).first()
    return sorted({row[f"q{i}"] for i in range(bins + 1)}) if row else []


def quantile_bin(df: DataFrame, column: str, bins: int = 4, labels: Sequence[str] | None = None,
                 edges: Sequence[float] | None = None) -> DataFrame:
    """Right-closed equal-frequency bins, lowest value included; ``<column>_bin`` is an index or a label."""
    edges = list(edges if edges is not None else fit_quantile_edges(df, column, bins))
    if labels is not None and len(labels) != len(edges) - 1:
        raise ValueError(f"{len(labels)} labels for {len(edges) - 1} bins")
    x = as_col(column)
    slot = F.lit(0)
    for e in edges[1:-1]:
        slot = slot + (x > F.lit(e)).cast("int")
    if edges:
        slot = F.when((x >= F.lit(edges[0])) & (x <= F.lit(edges[-1])), slot)
    if labels is not None:
        slot = F.element_at(F.array(*[F.lit(v) for v in labels]), slot + 1)
    return df.withColumn(f"{column}_bin", slot)


def fit_rules(df: DataFrame, model: str, rules: Mapping[str, Mapping[str, str]] = NUMERIC_RULES) -> dict[str, dict]:
    """Resolve each column's transform for ``model`` and fit its mean and deviation in one pass."""
    plan = {c: r.get(model, "none") for c, r in rules.items() if c in df.columns}
    for t in plan.values():
        if t not in TRANSFORMS:
            raise ValueError(f"unknown transform {t!r}; use one of {', '.join(TRANSFORMS)}")
    if not plan:
        return {}
    aggs = []
    for c, t in plan.items():
        x = as_col(c).cast("double")
        x = F.log1p(x) if t == "log1p_then_standardize" else x
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}"), skew_g1(x).alias(f"k_{c}")]
    row = df.agg(*aggs).first()
    out = {}
    for c, t in plan.items():
        skew = row[f"k_{c}"]
        if t == "optional_log1p":
            t = "log1p" if skew is not None and abs(skew) > SKEW_LIMIT else "none"
        out[c] = {"transform": t, "mean": row[f"m_{c}"], "std": row[f"s_{c}"] or 1.0}
    return out


def apply_rules(df: DataFrame, fitted: Mapping[str, Mapping]) -> DataFrame:
    new = {}
    for c, p in fitted.items():
        x = as_col(c).cast("double")
        if "log1p" in p["transform"]:
            x = F.log1p(x)
        if p["transform"].endswith("standardize"):
            x = (x - F.lit(p["mean"])) / F.lit(p["std"])
        if p["transform"] != "none":
            new[c] = x
    return df.withColumns(new) if new else df


def fit_scaler(df: DataFrame, columns: Sequence[str], method: str = "standard") -> dict[str, tuple[float, float]]:
    """(shift, divisor) per column: mean and population deviation, or minimum and range."""
    if method not in ("standard", "minmax"):
        raise ValueError(f"unknown method {method!r}; use 'standard' or 'minmax'")
    aggs = []
    for c in columns:
        x = as_col(c).cast("double")
        aggs += (
            [F.avg(x).alias(f"a_{c}"), F.stddev_pop(x).alias(f"d_{c}")]
            if method == "standard"
            else [F.min(x).alias(f"a_{c}"), (F.max(x) - F.min(x)).alias(f"d_{c}")]
        )
    row = df.agg(*aggs).first()
    return {c: (row[f"a_{c}"] or 0.0, row[f"d_{c}"] or 1.0) for c in columns}


def apply_scaler(df: DataFrame, fitted: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (as_col(c).cast("double") - F.lit(a)) / F.lit(d) for c, (a, d) in fitted.items()})


def scale_features(df: DataFrame, columns: Sequence[str], method: str = "standard") -> DataFrame:
    return apply_scaler(df, fit_scaler(df, columns, method))


def sigmoid(score: Column) -> Column:
    return 1 / (1 + F.exp(-score))


def threshold_predict(prob: Column, threshold: float) -> Column:
    return flag(prob >= F.lit(threshold))
