"""Connected components by alternating large and small stars, every round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (id, component): of every linked id the smallest id that it reaches.

    Large star: each node hands its larger neighbours to its smallest one. Small star: each hands itself and its
    smaller neighbours there. The rounds end when the edges stay the same: they are then stars around the
    smallest ids. A node with many edges is one partial minimum per task; edges never meet in one task.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = materialize(now, "edges"), None
    while True:
        size, mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (size, mark) == seen or not size:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        seen = (size, mark)
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialize(large, "edges")
        discard(now)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        now = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b"))).distinct()
        now = materialize(now, "edges")
        discard(large)
