"""Trees and boosted trees of many settings, grown side by side from counts of binned rows.

Spark ML bins every feature before it grows a tree (32 bins at most), and the tree sees nothing but the bins. Rows with
the same bins and label are one cell here, with its count in training and held out. Cells are counted by Spark over the
whole table; a task then grows the trees of one setting from the cells of one split. What Spark ML does in one job per
level of each tree is a few sums over arrays, so hundreds of boosting runs need as many tasks and not millions of jobs.

Thresholds follow Spark ML's rule on the values of all training rows (Spark ML looks at a sample of 10,000 rows), gains
and leaves its formulas, so trees are those of Spark ML up to the order of sums wherever it looks at all rows too.
A task holds the cells of one split: ``HELD_NUMBERS`` bounds rows times width of the tables that are fitted here, larger
ones belong to Spark ML, which spreads each fit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_col
from .search import Trees, shared_fits

#: Parameters of a setting that are known here.
KNOWN = {
    "decision_tree": {"maxDepth", "minInstancesPerNode", "impurity"},
    "gradient_boosting": {"maxIter", "maxDepth", "stepSize", "minInstancesPerNode"},
}
DEFAULTS = {"decision_tree": {"maxDepth": 30, "impurity": "gini"}, "gradient_boosting": {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1}}
MAX_BINS = 32
#: Rows times width of a table whose cells one task may hold: at worst 8 MB of bins, and some arrays of 64 MB.
HELD_NUMBERS = 8_000_000
#: Rows that are worth a task: times the number of fits.
ROWS_PER_TASK = 5_000
#: Numbers of the histograms that are held at once.
AT_ONCE = 4_000_000
#: Spark ML's bound below which a node is pure.
EPSILON = 2.0**-52


def fits_here(model: str, settings: Sequence[dict], n_rows: int, width: int) -> bool:
    return model in KNOWN and all(set(s) <= KNOWN[model] for s in settings) and n_rows * max(width, 1) <= HELD_NUMBERS


def thresholds(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Spark ML's thresholds of a feature from its sorted distinct values and their counts: midpoints about even shares apart."""
    if len(values) <= bins:
        return (values[:-1] + values[1:]) / 2.0
    share = counts.sum() / bins
    out, seen, target = [], counts[0], share
    for i in range(1, len(values)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            out.append((values[i - 1] + values[i]) / 2.0)
            target += share
    return np.array(out)


def bin_edges(train: DataFrame, features: str, weight: str | None = None) -> list[np.ndarray]:
    """Thresholds of every feature over the training rows."""
    w = (F.col(weight) if weight else F.lit(1)).cast("double").alias("w")
    values = train.select(w, F.posexplode(vector_to_array(features)).alias("f", "v")).groupBy("f", "v").agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("rows"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("v")
        n = pdf["n"].to_numpy(float)
        edges = thresholds(pdf["v"].to_numpy() + 0.0, n, min(MAX_BINS, int(pdf["rows"].sum())))
        return pd.DataFrame({"f": [int(pdf["f"].iloc[0])], "edges": [edges]})

    found = values.groupBy("f").applyInPandas(run, "f int, edges array<double>").collect()  # features x bins numbers
    if not found:
        raise ValueError("no training rows")
    return [np.array(r["edges"], float) for r in sorted(found)]


def cells(train: DataFrame, held: DataFrame | None, edges: Sequence[np.ndarray], features: str, label: str, weight: str | None = None) -> DataFrame:
    """(bins, y, w, h): weight of training rows (their count) and number of held-out rows per bins and label."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["x"].to_numpy())
                bins = np.column_stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)]).astype(np.uint8)
                yield pd.DataFrame({"bins": [b.tobytes() for b in bins], "y": pdf["y"], "w": pdf["w"], "h": pdf["h"]})

    def plain(rows: DataFrame, w, h: int) -> DataFrame:
        return rows.select(vector_to_array(features).alias("x"), as_col(label).cast("int").alias("y"), w.cast("double").alias("w"), F.lit(h).cast("long").alias("h"))

    rows = plain(train, F.col(weight) if weight else F.lit(1), 0)
    rows = rows if held is None else rows.unionAll(plain(held, F.lit(0), 1))
    return rows.mapInPandas(run, "bins binary, y int, w double, h long").groupBy("bins", "y").agg(F.sum("w").alias("w"), F.sum("h").alias("h"))


def gini(parts: np.ndarray) -> np.ndarray:
    """Impurity of counts per class (last axis)."""
    n, out = parts.sum(axis=-1), np.ones(parts.shape[:-1])
    for k in range(parts.shape[-1]):
        share = parts[..., k] / n
        out = out - share * share
    return out


def entropy(parts: np.ndarray) -> np.ndarray:
    n, out = parts.sum(axis=-1), np.zeros(parts.shape[:-1])
    for k in range(parts.shape[-1]):
        share = parts[..., k] / n
        out = out - np.where(share > 0, share * (np.log(share) / np.log(2.0)), 0.0)
    return out


def class_gain(impurity, left: np.ndarray, total: np.ndarray) -> np.ndarray:
    right = total - left
    n, l, r = total.sum(axis=-1), left.sum(axis=-1), right.sum(axis=-1)
    return impurity(total) - l / n * impurity(left) - r / n * impurity(right)


def variance(parts: np.ndarray) -> np.ndarray:
    """Impurity of (count, sum, sum of squares)."""
    n, s, q = parts[..., 0], parts[..., 1], parts[..., 2]
    return (q - s * s / n) / n


def sum_gain(left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Drop of the variance by a split of (count, sum); sums of squares cancel out."""
    (ln, ls), (n, s) = (left[..., 0], left[..., 1]), (total[..., 0], total[..., 1])
    rn, rs = n - ln, s - ls
    return (ls * ls / ln + rs * rs / rn - s * s / n) / n


class Grower:
    """Grows trees over the cells of one training set."""

    def __init__(self, bins: np.ndarray, edges: Sequence[np.ndarray], min_rows: int):
        self.n_cells, self.width = bins.shape
        self.columns, self.flat = np.ascontiguousarray(bins.T.astype(np.int64)), bins.ravel()
        self.first = np.arange(self.n_cells) * self.width  # of each cell in ``flat``
        # Rows of a side at least; one row may weigh less than 1, so one is what is more than nothing but the error of a difference.
        self.edges, self.least = edges, min_rows if min_rows > 1 else 1e-9
        self.n_bins = max([len(e) for e in edges], default=0) + 1
        self.real = np.arange(self.n_bins - 1)[None, :] < np.array([len(e) for e in edges])[:, None]

    def best(self, rows: np.ndarray | None, at: np.ndarray, parts: Sequence[np.ndarray], gain, stat: np.ndarray) -> tuple[np.ndarray, ...]:
        """Feature, last bin to the left and gain of the best split of each node; the first of equal ones."""
        n, d, b, s = len(stat), self.width, self.n_bins, len(parts)
        where, top = np.zeros(n, np.int64), np.full(n, -np.inf)
        step = max(1, AT_ONCE // max(1, d * b * s))
        if n > step:
            order = np.argsort(at, kind="stable")
            rows, at = order if rows is None else rows[order], at[order]
        for lo in range(0, n, step):
            hi = min(n, lo + step)
            own, base = rows, at * b
            if n > step:
                i, j = np.searchsorted(at, [lo, hi])
                own, base = rows[i:j], base[i:j] - lo * b
            weights = [p if own is None else p.take(own) for p in parts]
            left = np.empty((hi - lo, d, b, s))
            for f in range(d):
                slot = base + (self.columns[f] if own is None else self.columns[f].take(own))
                for k, w in enumerate(weights):
                    left[:, f, :, k] = np.bincount(slot, w, (hi - lo) * b).reshape(-1, b)
            left = np.cumsum(left, axis=2)[:, :, :-1]
            total = stat[lo:hi, None, None, :s]
            l = left[..., 0] if gain is sum_gain else left.sum(axis=-1)
            t = total[..., 0] if gain is sum_gain else total.sum(axis=-1)
            ok = self.real & (l >= self.least) & (t - l >= self.least)
            g = np.where(ok, gain(left, total), -np.inf).reshape(hi - lo, -1)
            where[lo:hi] = g.argmax(axis=1)
            top[lo:hi] = g[np.arange(hi - lo), where[lo:hi]]
        return where // max(1, b - 1), where % max(1, b - 1), top

    def tree(self, parts: Sequence[np.ndarray], splitting: int, gain, impurity, value, max_depth: int) -> tuple[Trees, np.ndarray]:
        """A tree of the statistics ``parts`` (the first ``splitting`` of them decide splits), and the leaf of every cell."""
        rows: np.ndarray | None = None  # all cells are still in open nodes
        at, ids = np.zeros(self.n_cells, np.int64), np.zeros(1, np.int64)
        leaf, size, parent = np.zeros(self.n_cells, np.int64), 1, np.zeros(1, np.int64)
        found: list[tuple] = []  # per level: statistics of its nodes, feature, threshold, left child (-1: leaf), parent

        def stay(kept: np.ndarray) -> None:
            """Only cells of the kept nodes go on, and these are numbered anew."""
            nonlocal rows, at
            if not kept.all():
                goes = np.flatnonzero(kept.take(at))
                rows, at = goes if rows is None else rows.take(goes), (np.cumsum(kept) - 1).take(at.take(goes))

        for level in range(max_depth + 1):
            if rows is None:
                leaf = ids.take(at)
            else:
                leaf[rows] = ids.take(at)
            stat = np.stack([np.bincount(at, p if rows is None else p.take(rows), len(ids)) for p in parts], axis=1)
            feature, cut, below = np.zeros(len(ids), np.int64), np.zeros(len(ids)), np.full(len(ids), -1)
            found.append((stat, feature, cut, below, parent))
            live = np.abs(impurity(stat)) >= EPSILON
            if level == max_depth or not live.any() or self.n_bins == 1:
                break
            stay(live)
            f, b, top = self.best(rows, at, parts[:splitting], gain, stat[live])
            split = top > 0
            if not split.any():
                break
            stay(split)
            f, b, at_open = f[split], b[split], np.flatnonzero(live)[split]
            feature[at_open] = f
            cut[at_open] = [self.edges[i][j] for i, j in zip(f, b)]
            below[at_open] = size + 2 * np.arange(len(at_open))
            own = self.first if rows is None else self.first.take(rows)
            at = 2 * at + (self.flat.take(own + f.take(at)) > b.take(at))
            parent = np.repeat(ids[at_open], 2)
            ids = size + np.arange(2 * len(at_open))
            size += len(ids)
        stat = np.concatenate([x[0] for x in found])
        below, own = np.concatenate([x[3] for x in found]), np.arange(size)
        inner, depth = below >= 0, np.repeat(np.arange(len(found)), [len(x[3]) for x in found]).astype(np.int32)
        return Trees(
            np.zeros(1, np.int64), np.concatenate([x[1] for x in found]), np.concatenate([x[2] for x in found]), np.where(inner, below, own), np.where(inner, below + 1, own),
            np.concatenate([x[4] for x in found]), depth, value(stat), np.ones(1), False, stat[:, 0] if splitting < len(parts) else stat.sum(axis=1),
        ), leaf


def joined(trees: Sequence[Trees], weight: np.ndarray, boosted: bool) -> Trees:
    """Several trees as one table of nodes."""
    start = np.cumsum([0] + [len(t.left) for t in trees[:-1]])
    moved = lambda name: np.concatenate([getattr(t, name) + s for t, s in zip(trees, start)])
    plain = lambda name: np.concatenate([getattr(t, name) for t in trees])
    return Trees(start, plain("feature"), plain("threshold"), moved("left"), moved("right"), moved("parent"), plain("depth"), plain("value"), weight, boosted, plain("cover"))


def one_tree(grower: Grower, y: np.ndarray, w: np.ndarray, params: dict) -> tuple[Trees, np.ndarray]:
    """A decision tree, its depth as deep as ``maxDepth``, and the leaf of every cell."""
    impurity = {"gini": gini, "entropy": entropy}[params["impurity"]]
    parts = [np.where(y == k, w, 0.0) for k in range(max(2, int(y.max()) + 1))]
    return grower.tree(parts, len(parts), lambda left, total: class_gain(impurity, left, total), impurity, lambda s: s[:, 1] / s.sum(axis=1), params["maxDepth"])


def boosting(grower: Grower, y: np.ndarray, w: np.ndarray, params: dict) -> Iterator[tuple[Trees, np.ndarray]]:
    """Stage by stage the tree and the margin of every cell after it: log loss, the first tree in full, later ones by ``stepSize``."""
    if y.max() > 1:
        raise ValueError("boosting takes two classes")
    sign, margin = np.where(y == 1, 1.0, -1.0), np.zeros(len(y))
    for stage in range(params["maxIter"]):
        rest = 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin)) if stage else sign
        tree, leaf = grower.tree([w, w * rest, w * rest * rest], 2, sum_gain, variance, lambda s: s[:, 1] / s[:, 0], params["maxDepth"])
        margin = margin + tree.value[leaf] * (params["stepSize"] if stage else 1.0)
        yield tree, margin


def opened(pdf: pd.DataFrame, width: int) -> tuple[np.ndarray, ...]:
    """Arrays of cells, in an order of their own: sums do not depend on how rows came."""
    bins = np.frombuffer(b"".join(pdf["bins"]), np.uint8).reshape(len(pdf), width)
    y = pdf["y"].to_numpy(float)
    if not np.isin(y, np.arange(100)).all():
        raise ValueError("labels must be whole numbers from 0")
    order = np.lexsort((y, *bins.T))
    return bins[order], y[order].astype(int), pdf["w"].to_numpy(float)[order], pdf["h"].to_numpy(float)[order]


#: Empty sides of a split divide by zero; they are never taken.
SILENT = {"invalid": "ignore", "divide": "ignore"}


def probabilities(model: str, params: dict, settings: Sequence[dict], bins: np.ndarray, edges: Sequence[np.ndarray], y: np.ndarray, w: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(setting, probability of class 1 of every cell) of all settings that one fit holds."""
    params = DEFAULTS[model] | params
    grower = Grower(bins, edges, params.get("minInstancesPerNode", 1))
    if model == "decision_tree":
        tree, leaf = one_tree(grower, y, w, params)
        for i, s in enumerate(settings):
            yield i, tree.value[tree.leaves_at(s.get("maxDepth", params["maxDepth"]))[leaf]]
        return
    for stage, (_, margin) in enumerate(boosting(grower, y, w, params), 1):
        for i, s in enumerate(settings):
            if s.get("maxIter", params["maxIter"]) == stage:
                yield i, 1 / (1 + np.exp(-2 * margin))


def search_cells(train: DataFrame, held: DataFrame, model: str, settings: Sequence[dict], features: str, label: str, scoring: str, n_rows: int) -> DataFrame:
    """(setting, y_true, y_prob, n) of the held-out rows; probabilities are cut to 0 and 1 where only their side of a half counts."""
    edges, fits = bin_edges(train, features), shared_fits(model, settings)
    exact = scoring == "roc_auc"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        params, places = fits[int(pdf["fit"].iloc[0])]
        bins, y, w, h = opened(pdf, len(edges))
        out = []
        with np.errstate(**SILENT):
            for i, p in probabilities(model, params, [settings[j] for j in places], bins, edges, y, w):
                p = (p if exact else (p > 0.5).astype(float))[h > 0]
                some = pd.DataFrame({"setting": places[i], "y_true": y[h > 0], "y_prob": p, "n": h[h > 0].astype(np.int64)})
                out.append(some.groupby(["setting", "y_true", "y_prob"], as_index=False)["n"].sum())
        return pd.concat(out)

    each = cells(train, held, edges, features, label).withColumn("fit", F.explode(F.array(*[F.lit(i) for i in range(len(fits))])))
    # A task for every fit of a larger table; small tables are not worth that many.
    tasks = min(len(fits), -(-n_rows * len(fits) // ROWS_PER_TASK))
    return each.repartition(max(1, tasks), "fit").groupBy("fit").applyInPandas(run, "setting int, y_true int, y_prob double, n long")


def fit_trees(train: DataFrame, model: str, params: dict, features: str, label: str, weight: str | None = None) -> Trees:
    """The model of one setting; its nodes reach the driver, as those of Spark ML do."""
    edges, params = bin_edges(train, features, weight), DEFAULTS[model] | params
    if weight and params.get("minInstancesPerNode", 1) > 1:
        raise ValueError("weighted rows have no count")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bins, y, w, _ = opened(pdf, len(edges))
        grower = Grower(bins, edges, params.get("minInstancesPerNode", 1))
        with np.errstate(**SILENT):
            if model == "decision_tree":
                tree, _ = one_tree(grower, y, w, params)
                answer = tree.leaves_at(params["maxDepth"])
                stays = answer == np.arange(len(answer))
                tree.left, tree.right = (np.where(stays[side], side, np.arange(len(answer))) for side in (tree.left, tree.right))
                trees = [tree]
            else:
                trees = [t for t, _ in boosting(grower, y, w, params)]
        return pd.concat([pd.DataFrame({"tree": k, "node": np.arange(len(t.left))} | {c: getattr(t, c) for c in NODE}) for k, t in enumerate(trees)])

    one = cells(train, None, edges, features, label, weight).groupBy(F.lit(0).alias("fit")).applyInPandas(run, f"tree int, node long, {', '.join(f'{c} {t}' for c, t in NODE.items())}")
    nodes = one.toPandas().sort_values(["tree", "node"])
    trees = [Trees(np.zeros(1, np.int64), *[own[c].to_numpy() for c in list(NODE)[:7]], np.ones(1), False, own["cover"].to_numpy()) for _, own in nodes.groupby("tree")]
    weight = np.full(len(trees), params.get("stepSize", 1.0))
    weight[0] = 1.0
    return joined(trees, weight, model == "gradient_boosting")


#: Columns of a node, in the order of ``Trees``.
NODE = {"feature": "long", "threshold": "double", "left": "long", "right": "long", "parent": "long", "depth": "int", "value": "double", "cover": "double"}


def score_trees(trees: Trees, rows: DataFrame, features: str) -> DataFrame:
    """Rows with ``y_prob`` and ``y_pred``."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def probability(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.probabilities(np.stack(x.to_numpy()), [{}])[0] if len(x) else [], dtype=float)

    scored = rows.withColumn("y_prob", probability(vector_to_array(features)))
    return scored.withColumn("y_pred", (F.col("y_prob") > 0.5).cast("int"))
