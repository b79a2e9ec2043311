"""Frequent itemsets and multi-item association rules over item arrays."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_col
from ..session import shuffle_width, spread

_LOW_BITS = 12
#: Baskets in a partition: FP-growth keeps each partition as objects and reads it whole.
BASKETS_PER_TASK = 200_000


def drop_noise_items(df: DataFrame, prefixes: Sequence[str], keep: Sequence[str], value: str = "No",
                     items: str = "items") -> DataFrame:
    """Remove ``<prefix>=<value>`` items, except for the prefixes in ``keep``."""
    noise = [f"{p}={value}" for p in prefixes if p not in keep]
    return df.withColumn(items, F.array_except(items, F.array(*[F.lit(x) for x in noise]))) if noise else df


def frequent_itemsets(df: DataFrame, items: str = "items", min_support: float = 0.05) -> DataFrame:
    """(items sorted, freq, support): FP-growth with its conditional trees spread over the executors."""
    n = df.count()
    parts = shuffle_width(df.sparkSession)  # conditional trees are spread over this many tasks
    model = FPGrowth(itemsCol=items, minSupport=min_support, numPartitions=parts).fit(spread(df.select(items), n, BASKETS_PER_TASK))
    return model.freqItemsets.select(
        F.array_sort("items").alias("items"), "freq", (F.col("freq") / F.lit(float(max(n, 1)))).alias("support")
    )


def association_rules(itemsets: DataFrame, metric: str = "lift", min_threshold: float = 1.2,
                      consequent_has: str | None = None) -> DataFrame:
    """Every antecedent/consequent split of every itemset, with support, confidence, lift, leverage, conviction.

    Splits are numbered by bit masks, generated in two nested steps so that a long itemset never
    needs one huge array. ``consequent_has`` keeps only splits whose consequent holds an item
    containing that text, before the joins.
    """
    if metric not in ("support", "confidence", "lift", "leverage", "conviction"):
        raise ValueError(f"unknown metric {metric!r}")
    size = F.size("items")
    sets = itemsets.where(size >= 2)
    if consequent_has is not None:
        sets = sets.where(F.exists("items", lambda x: x.contains(consequent_has)))
    power = lambda e: F.pow(F.lit(2.0), e).cast("long")
    low = F.least(size, F.lit(_LOW_BITS))
    splits = (
        sets.withColumn("__hi", F.explode(F.sequence(F.lit(0).cast("long"), power(size - low) - 1)))
        .withColumn("__lo", F.explode(F.sequence(F.lit(0).cast("long"), power(low) - 1)))
        .withColumn("__mask", F.col("__hi") * F.lit(2**_LOW_BITS) + F.col("__lo"))
        .where((F.col("__mask") > 0) & (F.col("__mask") < power(size) - 1))
        .select(
            F.expr("filter(items, (x, i) -> (shiftright(__mask, i) & 1) = 1)").alias("antecedents"),
            F.expr("filter(items, (x, i) -> (shiftright(__mask, i) & 1) = 0)").alias("consequents"),
            F.col("support"),
        )
    )
    if consequent_has is not None:
        splits = splits.where(F.exists("consequents", lambda x: x.contains(consequent_has)))
    return attach_supports(splits, itemsets).where(F.col(metric) >= min_threshold)


def attach_supports(splits: DataFrame, itemsets: DataFrame) -> DataFrame:
    """Look up antecedent and consequent support by item array, then the rule metrics."""
    a = itemsets.select(F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support"))
    c = itemsets.select(F.col("items").alias("consequents"), F.col("support").alias("consequent_support"))
    sa, sc, s = F.col("antecedent_support"), F.col("consequent_support"), F.col("support")
    conf = s / sa
    return (
        splits.join(a, "antecedents")
        .join(c, "consequents")
        .select(
            "antecedents",
            "consequents",
            "antecedent_support",
            "consequent_support",
            "support",
            conf.alias("confidence"),
            (conf / sc).alias("lift"),
            (s - sa * sc).alias("leverage"),
            F.when(conf >= 1, F.lit(float("inf"))).otherwise(F.try_divide(1 - sc, 1 - conf)).alias("conviction"),
        )
    )


def touches_items(items: Sequence[str], antecedents: str = "antecedents", consequents: str = "consequents") -> Column:
    """True where a rule mentions any of the items on either side."""
    return F.arrays_overlap(F.array_union(antecedents, consequents), F.array(*[F.lit(x) for x in items]))


def consequent_contains(text: str, consequents: str = "consequents") -> Column:
    return F.exists(consequents, lambda x: x.contains(text))


def rules_involving(rules: DataFrame, items: Sequence[str]) -> DataFrame:
    """Rules touching an item, most confident first."""
    return rules.where(touches_items(items)).orderBy(F.desc("confidence"), *_tie())


def _tie() -> list[Column]:
    return [F.concat_ws(",", "antecedents"), F.concat_ws(",", "consequents")]


def top_rules(rules: DataFrame, by: Sequence[str] = ("lift",), n: int = 20) -> DataFrame:
    """The ``n`` best rules by the given columns, item text as tie break."""
    return rules.orderBy(*[F.round(as_col(c), 9).desc() for c in by], *_tie()).limit(n)


def rules_per_segment(df: DataFrame, segment: str, items: str = "items", min_support: float = 0.05,
                      min_threshold: float = 1.2, consequent_has: str | None = None, parallelism: int = 4) -> DataFrame:
    """Mine each segment on its own; a segment without itemsets adds nothing. Segments are few (clusters).

    ``parallelism`` segments are mined at a time; the threads only submit Spark jobs.
    """

    def one(value) -> DataFrame:
        sets = frequent_itemsets(df.where(as_col(segment) == value), items, min_support)
        return association_rules(sets, "lift", min_threshold, consequent_has).select(F.lit(value).alias(segment), "*")

    values = [r[0] for r in df.select(segment).where(as_col(segment).isNotNull()).distinct().orderBy(segment).collect()]
    if not values:
        raise ValueError("no segment found")
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        return functools.reduce(DataFrame.unionByName, pool.map(one, values))
