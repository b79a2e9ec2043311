"""Synthetic minority oversampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_col
from .neighbors import knn_join
from .ordered import hash_order, hash_rank


def hash_unit(seed: int, *cols: str) -> Column:
    """A reproducible number in [0, 1) per row."""
    return F.conv(F.substring(hash_order(seed, *cols), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def smote_plan(df: DataFrame, label: str, counts: dict | None = None) -> dict:
    """How many synthetic rows each smaller class needs to reach the largest one (one entry per class)."""
    counts = counts or {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    top = max(counts.values())
    return {c: (n, top - n) for c, n in sorted(counts.items()) if n < top}


def smote(df: DataFrame, label: str, row_id: str = "id", vector: str = "vector", k: int = 5, seed: int = 42,
          counts: dict | None = None) -> DataFrame:
    """Synthetic rows only: (base_id, neighbor_id, copy, u, label, vector).

    Each row of a smaller class is the base of an equal number of points (the remainder goes to the
    first rows in hash order); each point lies between the base and one of its ``k`` nearest rows of
    the same class.
    """
    out = None
    for cls, (size, need) in smote_plan(df, label, counts).items():
        if size < 2:
            raise ValueError(f"class {cls!r} has {size} row(s); neighbours need at least 2")
        small = df.where(as_col(label) == cls).select(
            as_col(row_id).alias("base_id"), as_col(vector).cast("array<double>").alias("base")
        )
        near = knn_join(small, small, min(k, size - 1), "base_id", "base_id", "base", exclude_self=True)
        width = min(k, size - 1)
        each, rest = divmod(need, size)
        copies = F.lit(each) + (F.col("__r") <= rest).cast("int")
        draws = (
            hash_rank(small, [], ["base_id"], seed, "__r")
            .where(copies > 0)
            .withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
            .withColumn("rank", (F.floor(hash_unit(seed + 1, "base_id", "copy") * width) + 1).cast("int"))
            .withColumn("u", hash_unit(seed + 2, "base_id", "copy"))
            .drop("__r")
        )
        picked = draws.join(near.withColumnRenamed("query_id", "base_id").drop("distance"), ["base_id", "rank"])
        other = small.select(F.col("base_id").alias("neighbor_id"), F.col("base").alias("__to"))
        part = picked.join(other, "neighbor_id").select(
            "base_id",
            "neighbor_id",
            "copy",
            "u",
            F.lit(cls).cast(dict(df.dtypes)[label]).alias(label),
            F.zip_with("base", "__to", lambda a, b: a + F.col("u") * (b - a)).alias(vector),
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        kind = dict(df.dtypes)
        out = df.sparkSession.createDataFrame(
            [], f"base_id {kind[row_id]}, neighbor_id {kind[row_id]}, copy int, u double, {label} {kind[label]}, {vector} array<double>"
        )
    return out


def oversample(df: DataFrame, label: str, row_id: str = "id", vector: str = "vector", k: int = 5, seed: int = 42,
               counts: dict | None = None) -> DataFrame:
    """Original rows plus synthetic ones, as (row_id text, label, vector)."""
    real = df.select(as_col(row_id).cast("string").alias(row_id), as_col(label), as_col(vector).cast("array<double>").alias(vector))
    made = smote(df, label, row_id, vector, k, seed, counts)
    key = F.concat_ws("#", F.col("base_id").cast("string"), F.col("copy").cast("string"))
    return real.unionByName(made.select(key.alias(row_id), label, vector))
