"""Reproducible splits and folds as columns; nothing depends on row order or partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import as_col
from .ordered import hash_rank


def stratified_split(df: DataFrame, label: str, ids: Sequence[str], test_size: float = 0.2, seed: int = 42,
                     name: str = "is_test") -> DataFrame:
    """1 for the test share of each label, 0 for train."""
    ranked = hash_rank(df, [label], ids, seed, "__rank", "__size")
    cut = F.round(F.lit(float(test_size)) * F.col("__size"))
    return ranked.withColumn(name, (F.col("__rank") <= cut).cast("int")).drop("__rank", "__size")


def plain_split(df: DataFrame, ids: Sequence[str], test_size: float = 0.2, seed: int = 42,
                name: str = "is_test") -> DataFrame:
    ranked = hash_rank(df, [], ids, seed, "__rank", "__size")
    cut = F.ceil(F.lit(float(test_size)) * F.col("__size"))
    return ranked.withColumn(name, (F.col("__rank") <= cut).cast("int")).drop("__rank", "__size")


def stratified_kfold(df: DataFrame, label: str, ids: Sequence[str], k: int = 10, seed: int = 42,
                     name: str = "fold") -> DataFrame:
    """Fold 0..k-1 dealt round-robin in hash order inside each label."""
    ranked = hash_rank(df, [label], ids, seed, "__rank")
    return ranked.withColumn(name, F.pmod(F.col("__rank") - 1, F.lit(k)).cast("int")).drop("__rank")


def plain_kfold(df: DataFrame, ids: Sequence[str], k: int = 10, seed: int = 42, name: str = "fold") -> DataFrame:
    ranked = hash_rank(df, [], ids, seed, "__rank")
    return ranked.withColumn(name, F.pmod(F.col("__rank") - 1, F.lit(k)).cast("int")).drop("__rank")


def group_folds(df: DataFrame, label: str, group: str, k: int = 10, seed: int = 42) -> DataFrame:
    """(group, positives, size, fold): groups dealt in snake order from most to fewest positives.

    Groups of one positive count form a class; a class is ranked by hash in even buckets, and the
    classes only pass on how many groups came before them. Distinct counts that sum to at most N
    rows are at most sqrt(2N), so the class table is small at any scale.
    """
    sizes = df.groupBy(as_col(group).alias("group")).agg(
        F.sum((as_col(label) == 1).cast("long")).alias("positives"), F.count(F.lit(1)).alias("size")
    )
    ranked = hash_rank(sizes, ["positives"], ["group"], seed, "__rank")
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, -1)
    classes = (
        sizes.groupBy(F.col("positives").alias("p"))
        .agg(F.count(F.lit(1)).alias("__c"))
        .select("p", F.coalesce(F.sum("__c").over(order), F.lit(0)).alias("__before"))
    )
    place = F.col("__before") + F.col("__rank") - 1
    lap, seat = F.floor(place / k), F.pmod(place, F.lit(k))
    fold = F.when(F.pmod(lap, F.lit(2)) == 0, seat).otherwise(F.lit(k - 1) - seat)
    return ranked.join(classes, ranked["positives"] == classes["p"]).select(
        "group", "positives", "size", fold.cast("int").alias("fold")
    )


def stratified_group_kfold(df: DataFrame, label: str, group: str, k: int = 10, seed: int = 42,
                           name: str = "fold") -> DataFrame:
    """A group never spans folds; label shares stay close."""
    folds = group_folds(df, label, group, k, seed).select(F.col("group").alias("__g"), F.col("fold").alias(name))
    return df.join(folds, as_col(group).eqNullSafe(F.col("__g"))).drop("__g")


def target_type(df: DataFrame, target: str) -> DataFrame:
    """One row: binary, multiclass or continuous."""
    kind = df.schema[target].dataType
    x = as_col(target)
    fractional = isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType))
    broken = F.max((x != F.floor(x)).cast("int")) if fractional else F.lit(0)
    # Two distinct values are enough to know "binary"; min and max find them without a distinct.
    third = F.max(F.when((x != F.col("__lo")) & (x != F.col("__hi")), F.lit(1)).otherwise(F.lit(0)))
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    rows = df.withColumns({"__lo": F.lit(lo), "__hi": F.lit(hi)})
    one = rows.agg(F.coalesce(broken, F.lit(0)).alias("broken"), F.coalesce(third, F.lit(0)).alias("third"))
    return one.select(
        F.lit(target).alias("target"),
        F.when(F.col("broken") == 1, "continuous").when(F.col("third") == 1, "multiclass").otherwise("binary").alias("kind"),
    )


def nested_folds(df: DataFrame, label: str, ids: Sequence[str], outer: int = 10, inner: int = 5, seed: int = 42,
                 group: str | None = None) -> DataFrame:
    """Outer fold and, for each outer fold left out, the inner fold of every training row.

    ``inner_fold`` is an array indexed by outer fold (null where the row itself is held out), so
    nested folds cost one column, not one copy of the data per outer fold. With ``group`` no group
    spans outer folds, nor inner folds of any left-out one; folds are then dealt group by group.
    """
    if group is not None:
        dealt = hash_rank(group_folds(df, label, group, outer, seed), ["fold", "positives"], ["group"], seed + 1, "__r")
        cells = [
            F.when(F.col("fold") != o, F.pmod(F.col("__r") - 1 + F.col("positives") + F.pmod(F.col("fold") + o, F.lit(inner)), F.lit(inner)).cast("int"))
            for o in range(outer)
        ]
        of = dealt.select(F.col("group").alias("__g"), F.col("fold").alias("outer_fold"), F.array(*cells).alias("inner_fold"))
        return df.join(of, as_col(group).eqNullSafe(F.col("__g"))).drop("__g")
    base = stratified_kfold(df, label, ids, outer, seed, "outer_fold")
    # Inner folds: rank inside (label, own outer fold), shifted per left-out fold, so that each training
    # set is dealt evenly from all its outer folds.
    ranked = hash_rank(base, [label, "outer_fold"], ids, seed + 1, "__r")
    cells = [
        F.when(
            F.col("outer_fold") != o,
            F.pmod(F.col("__r") - 1 + F.pmod(F.col("outer_fold") + o, F.lit(inner)), F.lit(inner)).cast("int"),
        )
        for o in range(outer)
    ]
    return ranked.withColumn("inner_fold", F.array(*cells)).drop("__r")


