"""Categorical encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_col, other_cols
from ..session import cut_lineage, shuffle_width


def fit_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted levels per column: the fitted vocabulary, one output column each (``one_hot_stages`` is the sparse form)."""
    row = df.agg(*[F.array_sort(F.collect_set(as_col(c).cast("string"))).alias(c) for c in columns]).first()
    return {c: list(row[c]) for c in columns}


def one_hot(df: DataFrame, columns: Sequence[str], drop_first: bool = True,
            levels: dict[str, list[str]] | None = None) -> DataFrame:
    """0/1 columns ``<col>_<level>``; for low-cardinality columns. A null row is all zero."""
    levels = levels or fit_levels(df, columns)
    new: dict[str, Column] = {}
    for c in columns:
        for v in levels[c][1 if drop_first else 0 :]:
            new[f"{c}_{v}"] = F.coalesce((as_col(c).cast("string") == v).cast("int"), F.lit(0))
    return df.select(*[as_col(c) for c in df.columns if c not in columns], *[v.alias(k) for k, v in new.items()])


def one_hot_auto(df: DataFrame, target: str, ids: Sequence[str] = (), drop_first: bool = True,
                 drop_ids: bool = False) -> DataFrame:
    """One-hot every non-numeric column except ids and target."""
    cols = [c for c in other_cols(df) if c != target and c not in ids]
    out = one_hot(df, cols, drop_first) if cols else df
    return out.drop(*ids) if drop_ids else out


def one_hot_stages(columns: Sequence[str], drop_first: bool = True) -> list:
    """Sparse one-hot for wide vocabularies: one vector per column instead of thousands of columns.

    Indexing in descending order puts the smallest level last, which is the one that is dropped.
    """
    idx = StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}__i" for c in columns], stringOrderType="alphabetDesc", handleInvalid="error"
    )
    enc = OneHotEncoder(
        inputCols=[f"{c}__i" for c in columns], outputCols=[f"{c}__v" for c in columns], dropLast=drop_first
    )
    return [idx, enc]


def items_of(columns: Sequence[str], sep: str = "=") -> Column:
    """``col=value`` items of a row (nulls give no item): the sparse form of a boolean matrix."""
    cells = [
        F.when(as_col(c).isNotNull(), F.concat(F.lit(f"{c}{sep}"), as_col(c).cast("string"))) for c in columns
    ]
    return F.array_compact(F.array(*cells))


def one_hot_items(df: DataFrame, columns: Sequence[str], drop: Sequence[str] = (), name: str = "items") -> DataFrame:
    items = items_of(columns)
    if drop:
        items = F.array_except(items, F.array(*[F.lit(x) for x in drop]))
    return df.withColumn(name, items)


def fit_label_map(df: DataFrame, column: str) -> DataFrame:
    """(value, code) with codes 0..k-1 in text order.

    Levels are range-partitioned, written down (so that the ranges are fixed) and numbered inside each
    range after the ranges before it.
    """
    distinct = df.select(F.coalesce(as_col(column).cast("string"), F.lit("nan")).alias("value")).distinct()
    return _number_ranges(distinct)


def _number_ranges(distinct: DataFrame) -> DataFrame:
    width = shuffle_width(distinct.sparkSession)
    ranged = cut_lineage(distinct.repartitionByRange(width, "value").withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # one row per range
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    inside = Window.partitionBy("__part").orderBy("value")
    return ranged.join(offsets, "__part").select(
        "value", (F.col("__o") + F.row_number().over(inside) - 1).cast("int").alias("code")
    )


def label_encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    out = df
    for c in columns:
        codes = fit_label_map(df, c).select(F.col("value").alias("__v"), F.col("code").alias("__code"))
        out = (
            out.join(codes, F.coalesce(as_col(c).cast("string"), F.lit("nan")) == F.col("__v"), "left")
            .withColumn(c, F.col("__code"))
            .drop("__v", "__code")
        )
    return out


def assemble_vector(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid="error").transform(df)
