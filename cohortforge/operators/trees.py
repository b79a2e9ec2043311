"""Exact explanations of fitted trees: attributions and partial dependence from the boxes of their leaves.

A leaf is a box: per feature on its path one interval, and the share of training rows that its splits on that feature
let through. Both jobs are sums over boxes, so every row is looked at once, without copies per feature order or grid
value, and nothing is shuffled but small partial sums.

Attributions: with a set S of features known, a tree predicts the mean over leaves of ``value``, times 1 or 0 for each
feature in S (the row is inside the interval or not), times the share for each other feature. The weight of S in a
Shapley value is the integral of t^|S| (1-t)^(m-1-|S|), so the sum over all S is the integral over t of a product with
one factor per feature: a polynomial, which Gauss-Legendre points give exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import as_col
from ..session import spread
from .search import Trees, read_trees

#: Rows times intervals that are held at once, and intervals that are looked at together.
CELLS, TOGETHER = 2_000_000, 20_000
#: Rows of a task that explains them: every row meets every interval, so few rows are much work.
EXPLAINED_PER_TASK = 4_000


@dataclass
class Boxes:
    """Intervals (low, high] of all leaves, sorted by leaf; ``low`` is nan where nothing bounds it (nan goes to the right)."""

    leaf: np.ndarray
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray  # of each leaf, times the weight of its tree
    constant: float  # from trees without a split

    @property
    def base(self) -> float:
        """The prediction with no feature known: the mean over the training rows of each tree."""
        if not len(self.leaf):
            return self.constant
        return self.constant + float(self.value @ np.multiply.reduceat(self.share, self.starts(self.leaf)))

    @staticmethod
    def starts(leaf: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1]))

    def blocks(self) -> Iterator[slice]:
        """Ranges of intervals of whole leaves, about TOGETHER each."""
        at = self.starts(self.leaf) if len(self.leaf) else np.zeros(0, np.int64)
        begin = 0
        while begin < len(self.leaf):
            later = at[at >= begin + TOGETHER]
            end = int(later[0]) if len(later) else len(self.leaf)
            yield slice(begin, end)
            begin = end

    def inside(self, x: np.ndarray, part: slice) -> np.ndarray:
        """(row, interval): whether the row lies inside."""
        at = x[:, self.feature[part]]
        return ~(at <= self.low[part]) & ((at <= self.high[part]) | np.isinf(self.high[part]))

    def attributions(self, x: np.ndarray) -> np.ndarray:
        """(row, feature): exact Shapley values."""
        out = np.zeros(x.shape)
        for part in self.blocks():
            starts = self.starts(self.leaf[part])
            sizes = np.diff(np.append(starts, part.stop - part.start))
            points, weights = np.polynomial.legendre.leggauss(-(-int(sizes.max()) // 2))
            share, value = self.share[part], self.value[self.leaf[part][starts]]
            order = np.argsort(self.feature[part], kind="stable")
            columns = self.feature[part][order]
            firsts = self.starts(columns)
            step = max(1, CELLS // len(share))
            for i in range(0, len(x), step):
                known = self.inside(x[i : i + step], part).astype(float)
                total = np.zeros_like(known)
                for t, w in zip((points + 1) / 2, weights / 2):
                    factor = share * (1 - t) + known * t
                    whole = np.multiply.reduceat(factor, starts, axis=1) * (value * w)
                    total += np.repeat(whole, sizes, axis=1) / factor
                gain = (known - share) * total
                out[i : i + step, columns[firsts]] += np.add.reduceat(gain[:, order], firsts, axis=1)
        return out

    def reached(self, x: np.ndarray, asked: Sequence[int]) -> np.ndarray:
        """(asked feature, leaf): rows that reach the leaf if the feature alone is left open."""
        out = np.zeros((len(asked), len(self.value)), np.int64)
        for part in self.blocks():
            leaf, feature = self.leaf[part], self.feature[part]
            starts = self.starts(leaf)
            step = max(1, CELLS // len(leaf))
            for i in range(0, len(x), step):
                outside = ~self.inside(x[i : i + step], part)
                missed = np.add.reduceat(outside, starts, axis=1, dtype=np.int32)
                for a, f in enumerate(asked):
                    open_ = missed.copy()
                    own = np.flatnonzero(feature == f)
                    open_[:, leaf[own] - leaf[0]] -= outside[:, own]
                    out[a, leaf[starts]] += (open_ == 0).sum(axis=0)
        return out


def boxes_of(trees: Trees) -> Boxes:
    """Climbs from all leaves at once; conditions on one feature become one interval."""
    nodes = np.arange(len(trees.left))
    root_of = np.searchsorted(trees.root, nodes, side="right") - 1
    weight = trees.weight if trees.boosted else trees.weight / len(trees.root)
    leaves = nodes[trees.left == nodes]
    single = trees.depth[leaves] == 0
    constant = float((trees.value[leaves] * weight[root_of[leaves]])[single].sum())
    leaves = leaves[~single]
    value = trees.value[leaves] * weight[root_of[leaves]]
    number, now, steps = np.arange(len(leaves)), leaves, []
    while len(now):
        up = trees.parent[now]
        steps.append((number, trees.feature[up], trees.left[up] == now, trees.threshold[up], trees.cover[now] / trees.cover[up]))
        deeper = trees.depth[up] > 0
        number, now = number[deeper], up[deeper]
    if not steps:
        none = np.zeros(0)
        return Boxes(none.astype(int), none.astype(int), none, none, none, none, constant)
    leaf, feature, below, threshold, share = (np.concatenate(x) for x in zip(*steps))
    order = np.lexsort((feature, leaf))
    leaf, feature, below, threshold, share = (x[order] for x in (leaf, feature, below, threshold, share))
    first = np.flatnonzero(np.append(True, (leaf[1:] != leaf[:-1]) | (feature[1:] != feature[:-1])))
    low = np.maximum.reduceat(np.where(below, -np.inf, threshold), first)
    high = np.minimum.reduceat(np.where(below, threshold, np.inf), first)
    return Boxes(leaf[first], feature[first], np.where(np.isinf(low), np.nan, low), high, np.multiply.reduceat(share, first), value, constant)


def read_boxes(model, spark: SparkSession) -> Boxes:
    """The boxes of a fitted tree, forest or boosted model of Spark ML.

    Values are the probability of class 1 (the prediction of a regression); for a boosted classifier they add up to its
    margin, which is what its attributions and partial dependence are about.
    """
    return boxes_of(read_trees(model, spark))


def tree_shapley(df: DataFrame, boxes: Boxes, names: Sequence[str], features: str = "features", row_id: str = "id") -> DataFrame:
    """(id, feature, attribution): exact attributions; those of a row and ``boxes.base`` add up to its prediction.

    Features that no split uses get 0. Rows without a vector or an id are kept out; a missing (nan) value goes the way
    the model sends it. The model is broadcast; rows are dealt out only where one partition would hold many.
    """
    kind, shared, d = dict(df.dtypes)[row_id], df.sparkSession.sparkContext.broadcast(boxes), len(names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                got = shared.value.attributions(np.stack(pdf["x"].to_numpy()))
                yield pd.DataFrame({row_id: pdf["rid"].repeat(d).to_numpy(), "feature": list(names) * len(pdf), "attribution": got.ravel()})

    rows = df.select(as_col(row_id).alias("rid"), vector_to_array(features).alias("x")).where("rid is not null and x is not null")
    return spread(rows, df.count(), EXPLAINED_PER_TASK).mapInPandas(run, f"`{row_id}` {kind}, feature string, attribution double")


def tree_partial_dependence(df: DataFrame, boxes: Boxes, names: Sequence[str], grid: Mapping[str, Sequence[float]],
                            features: str = "features") -> DataFrame:
    """(feature, value, mean_prediction) for every value of ``grid``: the mean over the rows with that feature set to it.

    Rows count once for the leaves they reach with a feature left open; a task passes on one count per (feature, leaf),
    and the grid meets the counts only. No rows, no result.
    """
    shared = df.sparkSession.sparkContext.broadcast((boxes, {list(names).index(c): [float(v) for v in grid[c]] for c in grid}))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, wanted = shared.value
        asked, total, rows = list(wanted), np.zeros((len(wanted), len(held.value)), np.int64), 0
        for pdf in batches:
            if len(pdf):
                total += held.reached(np.stack(pdf["x"].to_numpy()), asked)
                rows += len(pdf)
        if rows:
            a, leaf = np.nonzero(total)
            yield pd.DataFrame({"f": np.array(asked)[a], "leaf": leaf, "n": total[a, leaf]})
            yield pd.DataFrame({"f": asked, "leaf": -1, "n": rows})

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, wanted = shared.value
        for pdf in batches:
            for f, part in pdf.groupby("f"):
                of = np.flatnonzero(held.feature == f)
                low, high = np.full(len(held.value), np.nan), np.full(len(held.value), np.inf)
                low[held.leaf[of]], high[held.leaf[of]] = held.low[of], held.high[of]
                real = part[part["leaf"] >= 0]
                leaf, worth = real["leaf"].to_numpy(), held.value[real["leaf"]] * real["n"]
                v = np.array(wanted[f])
                sums = [float(worth[~(x <= low[leaf]) & ((x <= high[leaf]) | np.isinf(high[leaf]))].sum()) for x in v]
                yield pd.DataFrame({"f": f, "value": v, "s": sums, "n": int(part.loc[part["leaf"] < 0, "n"].sum())})

    rows = df.select(vector_to_array(features).alias("x")).where("x is not null")
    counts = rows.mapInPandas(count, "f int, leaf int, n long").groupBy("f", "leaf").agg(F.sum("n").alias("n"))
    placed = counts.mapInPandas(place, "f int, value double, s double, n long").groupBy("f", "value").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    name = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("f") + 1)
    return placed.select(name.alias("feature"), "value", (F.col("s") / F.col("n") + F.lit(boxes.constant)).alias("mean_prediction"))
