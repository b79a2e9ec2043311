"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_col(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """num/den as double; a zero or null divisor gives ``default``."""
    q = F.try_divide(num.cast("double"), den.cast("double"))
    return q if default is None else F.coalesce(q, F.lit(float(default)))


def flag(cond: Column) -> Column:
    """0/1 integer, null counts as false."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def count_where(cond: Column) -> Column:
    return F.coalesce(F.sum(flag(cond).cast("long")), F.lit(0).cast("long"))


def present(df: DataFrame, c: str) -> Column:
    """The column with NaN as null: both count as missing."""
    return F.when(~F.isnan(as_col(c)), as_col(c)) if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else as_col(c)


def numeric_cols(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def other_cols(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType) and f.name not in skip]


def round_all(df: DataFrame, digits: int = 6, keep: Sequence[str] = ()) -> DataFrame:
    """Round every double column, for stable output of float sums."""
    return df.select(
        *[
            F.round(as_col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in keep
            else as_col(f.name)
            for f in df.schema.fields
        ]
    )


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], cast: str, name: str = "column",
         value: str = "value") -> DataFrame:
    """Wide to long over ``cols``, all values cast to one type."""
    return df.select(*[as_col(c) for c in ids], *[as_col(c).cast(cast).alias(c) for c in cols]).unpivot(
        [as_col(c) for c in ids], [as_col(c) for c in cols], name, value
    )
