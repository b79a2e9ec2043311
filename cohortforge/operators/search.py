"""Searches that share fits: one fit serves all settings that are its prefixes.

A boosting run of 200 stages holds those of 50 and 100 stages; a tree cut at its inner nodes is the tree of a smaller
depth; a forest of 200 trees holds forests of 50 and 100, its trees cut like others. For tree and boosting this equals
separate fits. A sub-forest differs from a separate fit in its draws only: Spark draws bootstrap weights tree by tree
from one stream per partition, and the features of nodes in the order in which nodes are grown.

A fitted model is written, read as a table of nodes and broadcast as flat arrays (the driver holds the model anyway);
held-out rows descend once, in Arrow batches, and every batch returns four counts per setting.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .metrics import classification_metrics

#: Parameters whose smaller values are prefixes of a fit at the largest one.
PREFIXES: dict[str, tuple[str, ...]] = {
    "decision_tree": ("maxDepth",),
    "random_forest": ("numTrees", "maxDepth"),
    "gradient_boosting": ("maxIter",),
}
COUNTS = ("tp", "fp", "tn", "fn")


def settings_of(grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations, the first parameter slowest."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def shared_fits(model: str, settings: Sequence[dict]) -> list[tuple[dict, list[int]]]:
    """Parameters to fit with, and the places of the settings that each fit serves."""
    groups: dict[tuple, list[int]] = {}
    prefixes = PREFIXES.get(model, ())
    for i, s in enumerate(settings):
        groups.setdefault(tuple((k, v) for k, v in s.items() if k not in prefixes), []).append(i)
    out = []
    for rest, places in groups.items():
        most = {k: max(settings[i][k] for i in places) for k in prefixes if k in settings[places[0]]}
        out.append((dict(rest) | most, places))
    return out


@dataclass
class Trees:
    """Nodes of all trees after each other; a leaf leads to itself."""

    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    parent: np.ndarray
    depth: np.ndarray
    value: np.ndarray  # probability of class 1, or the value of a regression tree
    weight: np.ndarray  # of each tree
    boosted: bool
    cover: np.ndarray  # weight of the training rows of each node

    def leaves_at(self, depth: int) -> np.ndarray:
        """Per node the node that answers for it once trees are cut at ``depth`` and two leaves of one class are one."""
        leaf = (self.left == np.arange(len(self.left))) | (self.depth >= depth)
        says = self.value > 0.5
        for d in range(min(depth, int(self.depth.max(initial=0))) - 1, -1, -1):
            at = np.flatnonzero((self.depth == d) & ~leaf)
            l, r = self.left[at], self.right[at]
            leaf[at] = leaf[l] & leaf[r] & (says[l] == says[r])
        answer = np.arange(len(leaf))
        for d in range(1, int(self.depth.max(initial=0)) + 1):
            at = np.flatnonzero(self.depth == d)
            up = self.parent[at]
            covered = leaf[up] | (answer[up] != up)
            answer[at[covered]] = answer[up[covered]]
        return answer

    def descend(self, x: np.ndarray) -> np.ndarray:
        """(tree, row) -> leaf."""
        node = np.repeat(self.root[:, None], len(x), axis=1)
        row = np.arange(len(x))[None, :]
        for _ in range(int(self.depth.max(initial=0))):
            node = np.where(x[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return node

    def probabilities(self, x: np.ndarray, settings: Sequence[dict]) -> np.ndarray:
        """(setting, row) -> probability of class 1."""
        leaf, out = self.descend(x), []
        values: dict[int | None, np.ndarray] = {}
        for s in settings:
            depth = None if self.boosted else s.get("maxDepth")
            if depth not in values:
                values[depth] = np.cumsum(self.value[leaf if depth is None else self.leaves_at(depth)[leaf]] * self.weight[:, None], axis=0)
            n = s.get("maxIter" if self.boosted else "numTrees", len(self.root))
            total = values[depth][min(n, len(self.root)) - 1]
            out.append(1 / (1 + np.exp(-2 * total)) if self.boosted else total / min(n, len(self.root)))
        return np.array(out)


def read_trees(model, spark: SparkSession) -> Trees:
    """Flat arrays of a fitted tree, forest or boosted classifier of Spark ML."""
    path = scratch_path(spark, "nodes")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data")
    rows = rows.select("treeID", "nodeData.*") if "treeID" in rows.columns else rows.select(F.lit(0).alias("treeID"), "*")
    nodes = rows.select(
        F.col("treeID").alias("tree"), "id", "prediction", "impurityStats", "leftChild", "rightChild",
        F.col("split.featureIndex").alias("feature"), F.try_element_at(F.col("split.leftCategoriesOrThreshold"), F.lit(1)).alias("threshold"), F.col("split.numCategories").alias("categories"),
    ).toPandas().sort_values(["tree", "id"], ignore_index=True)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    if (nodes["categories"] >= 0).any():
        raise ValueError("categorical splits are not supported")
    boosted = hasattr(model, "treeWeights") and "GBT" in type(model).__name__
    sizes = nodes.groupby("tree").size().to_numpy()
    start = np.cumsum(sizes) - sizes
    base, own = np.repeat(start, sizes), np.arange(len(nodes))
    inner = nodes["leftChild"].to_numpy() >= 0
    left = np.where(inner, base + nodes["leftChild"].to_numpy(), own)
    right = np.where(inner, base + nodes["rightChild"].to_numpy(), own)
    parent, depth = own.copy(), np.zeros(len(own), np.int32)
    parent[left[inner]] = own[inner]
    parent[right[inner]] = own[inner]
    now = start
    while len(now):  # by levels
        now = now[inner[now]]
        below = np.append(left[now], right[now])
        depth[below] = depth[parent[below]] + 1
        now = below
    classes = hasattr(model, "numClasses") and not boosted
    value = np.array([s[1] / sum(s) for s in nodes["impurityStats"]]) if classes else nodes["prediction"].to_numpy()
    # the statistics of a node are counts per class, or count, sum and sum of squares
    cover = np.array([sum(s) if classes else s[0] for s in nodes["impurityStats"]])
    weight = np.array(model.treeWeights) if boosted else np.ones(len(sizes))
    return Trees(start, np.maximum(nodes["feature"].to_numpy(), 0), nodes["threshold"].fillna(0.0).to_numpy(), left, right, parent, depth, value, weight, boosted, cover)


def prefix_scores(model, settings: Sequence[dict], spark: SparkSession) -> Callable[[DataFrame, str, str], DataFrame]:
    """Scorer of all settings that one fitted model holds: rows -> (setting, y_true, y_prob, n), equal ones added up."""
    trees = read_trees(model, spark)
    shared = spark.sparkContext.broadcast((trees, list(settings)))

    def score(rows: DataFrame, features: str, label: str) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            t, wanted = shared.value
            for pdf in batches:
                p = t.probabilities(np.stack(pdf["x"].to_numpy()), wanted)
                y = pdf["y"].to_numpy()
                for i, line in enumerate(p):
                    pairs, n = np.unique(np.stack([y, line]), axis=1, return_counts=True)
                    yield pd.DataFrame({"setting": i, "y_true": pairs[0].astype(int), "y_prob": pairs[1], "n": n})

        plain = rows.select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y"))
        return plain.mapInPandas(run, "setting int, y_true int, y_prob double, n long")

    return score


def counts_of(scored: DataFrame) -> dict[int, tuple]:
    """(setting, y_true, y_prob, n) -> setting -> (tp, fp, tn, fn); class 1 needs more than half of the probability."""
    said, n = F.col("y_prob") > 0.5, F.col("n")
    cell = lambda true, says: F.coalesce(F.sum(F.when((F.col("y_true") == true) & (said if says else ~said), n)), F.lit(0))
    rows = scored.groupBy("setting").agg(cell(1, True).alias("tp"), cell(0, True).alias("fp"), cell(0, False).alias("tn"), cell(1, False).alias("fn"))
    return {r["setting"]: tuple(r[c] for c in COUNTS) for r in rows.collect()}  # one row per setting


def measure(counts: tuple, scoring: str) -> float:
    """f1, precision, recall of class 1 or accuracy; 0 where nothing can be divided."""
    tp, fp, tn, fn = counts
    parts = {"f1": (2 * tp, 2 * tp + fp + fn), "precision": (tp, tp + fp), "recall": (tp, tp + fn), "accuracy": (tp + tn, tp + fp + tn + fn)}
    if scoring not in parts:
        raise ValueError(f"unknown scoring {scoring!r}")
    over, under = parts[scoring]
    return over / under if under else 0.0


def scores_of(scored: DataFrame, n: int, scoring: str) -> list[float]:
    """One figure per setting."""
    if scoring != "roc_auc":
        counts = counts_of(scored)
        return [measure(counts.get(i, (0, 0, 0, 0)), scoring) for i in range(n)]
    long = scored.select(F.col("setting").cast("string").alias("model"), F.lit(0).alias("fold"), "y_true", "y_prob", (F.col("y_prob") > 0.5).cast("int").alias("y_pred"), F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    auc = {r["model"]: r["auc_roc"] for r in classification_metrics(long).select("model", "auc_roc").collect()}
    return [auc[str(i)] if auc.get(str(i)) is not None else 0.0 for i in range(n)]


def search_splits(splits: Mapping, settings: Sequence[dict], model: str, fit: Callable[[object, dict], tuple], features: str, label: str,
                  scoring: str, parallelism: int = 8) -> dict[object, list[float]]:
    """Split -> score of every setting. ``splits`` maps a key to (training rows, held-out rows).

    ``fit(key, params)`` returns (fitted Spark ML model, the held-out rows as the model takes them, their features
    column). Fits of all splits run ``parallelism`` at a time; the threads only submit Spark jobs.
    """
    jobs = [(key, params, places) for key in splits for params, places in shared_fits(model, settings)]

    def one(job: tuple) -> list[tuple]:
        key, params, places = job
        fitted, held, vec = fit(key, params)
        if model in PREFIXES:
            scored = prefix_scores(fitted, [settings[i] for i in places], held.sparkSession)(held, vec, label)
        else:
            prob = vector_to_array(F.col("probability"))[1]
            scored = fitted.transform(held).select(F.lit(0).alias("setting"), F.col(label).cast("int").alias("y_true"), prob.alias("y_prob"))
            scored = scored.groupBy("setting", "y_true", "y_prob").agg(F.count("*").alias("n"))
        return [(key, i, s) for i, s in zip(places, scores_of(scored, len(places), scoring))]

    out = {key: [0.0] * len(settings) for key in splits}
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        for found in pool.map(one, jobs):
            for key, i, s in found:
                out[key][i] = s
    return out
