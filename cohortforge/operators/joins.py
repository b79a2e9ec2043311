"""Dictionary lookups and joins of small statistic tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import normalise_code
from ..functions.exprs import as_col


def build_lookup(dim: DataFrame, code: str, description: str, order: str | None = None) -> DataFrame:
    """(code, description) with one row per normalised code; the last line wins on duplicates."""
    rank: Column = as_col(order) if order else as_col(code)
    return (
        dim.where(as_col(code).isNotNull())
        .groupBy(normalise_code(as_col(code)).alias("__code"))
        .agg(F.max_by(F.trim(as_col(description).cast("string")), rank).alias("__desc"))
    )


def decode_codes(df: DataFrame, lookups: dict[str, tuple[DataFrame, str]], unknown: str = "Unknown") -> DataFrame:
    """Add a description per code column: ``{code column: (lookup, new column)}``.

    No broadcast hint: lookups below the size limit are broadcast by their measured size,
    larger ones fall back to a shuffled join with skew splitting.
    """
    out = df
    for column, (dim, name) in lookups.items():
        if column not in df.columns:
            continue
        out = (
            out.join(dim, normalise_code(as_col(column)) == dim["__code"], "left")
            .withColumn(name, F.coalesce("__desc", F.lit(unknown)))
            .drop("__code", "__desc")
        )
    return out


def decode_from_code_file(df: DataFrame, codes: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Decode with a file read by ``read_code_tables``: ``{code column: new column}``; tables named as the columns."""
    names = [r["table_name"] for r in codes.select("table_name").distinct().collect()]
    if len(names) < len(columns):
        raise ValueError(f"expected {len(columns)} code tables, found {len(names)}")
    return decode_codes(
        df,
        {
            c: (build_lookup(codes.where(F.col("table_name") == c), "code", "description", "line"), new)
            for c, new in columns.items()
        },
    )


def group_stat_join(df: DataFrame, stats: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Look a per-group statistic back up for every row."""
    side = stats.select(as_col(key).alias("__key"), as_col(value).alias(name))
    return df.join(side, as_col(key).eqNullSafe(F.col("__key")), "left").drop("__key")


def before_after_join(before: DataFrame, after: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Per-column statistics before and after a transform side by side, with the transform's name."""
    stats = [c for c in before.columns if c != "column"]
    b = before.select("column", *[as_col(c).alias(f"{c}_before") for c in stats])
    a = after.select("column", *[as_col(c).alias(f"{c}_after") for c in stats])
    name = F.lit("none")
    for c, t in labels.items():
        name = F.when(F.col("column") == c, F.lit(t)).otherwise(name)
    return b.join(a, "column").withColumn("transform", name)
