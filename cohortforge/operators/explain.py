"""Model explanation as batch jobs. ``score`` is any function DataFrame -> DataFrame that adds ``y_pred``/``y_prob``."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_col
from ..session import shuffle_width
from .ordered import exact_quantiles, hash_rank

Scorer = Callable[[DataFrame], DataFrame]


def feature_importance(model, names: Sequence[str], spark, top: int | None = None) -> DataFrame:
    """(feature, importance), largest first."""
    weight = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    rows = [(n, float(abs(v))) for n, v in zip(names, weight.toArray())]
    out = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return out.limit(top) if top else out


def _swap(df: DataFrame, columns: Sequence[str], name: str, value: Callable[[str], Column]) -> DataFrame:
    """One copy of each row per feature, with that feature's column replaced."""
    out = df.withColumn(name, F.explode(F.array(*[F.lit(c) for c in columns])))
    return out.withColumns({c: F.when(F.col(name) == c, value(c)).otherwise(as_col(c)) for c in columns})


def permutation_importance(df: DataFrame, score: Scorer, columns: Sequence[str], label: str = "label", row_id: str = "id",
                           repeats: int = 10, seed: int = 42) -> DataFrame:
    """(feature, importance_mean, importance_std): accuracy lost when a column is shuffled.

    All repeats and features form one job: rows are ranked once in hash order, each repeat takes its partners
    an own stretch further round that order (one join), and each feature's copy swaps in the partner's value.
    """
    base = score(df).agg(F.avg((F.col("y_pred") == as_col(label)).cast("double"))).first()[0]
    ranked = hash_rank(df, [], [row_id], seed, "__place", total="__n")
    far = F.floor(F.col("__n") * (F.col("__rep") + 1) / F.lit(repeats + 1))
    left = ranked.withColumn("__rep", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn("__at", 1 + (F.col("__place") - 1 + far) % F.col("__n"))
    right = ranked.select(F.col("__place").alias("__at"), *[as_col(c).alias(f"__other_{c}") for c in columns])
    paired = left.join(right, "__at").drop("__at", "__n")
    shuffled = _swap(paired, columns, "feature", lambda c: F.col(f"__other_{c}"))
    acc = score(shuffled).groupBy("feature", "__rep").agg(F.avg((F.col("y_pred") == as_col(label)).cast("double")).alias("acc"))
    return acc.groupBy("feature").agg(
        F.avg(F.lit(base) - F.col("acc")).alias("importance_mean"),
        F.stddev_pop(F.lit(base) - F.col("acc")).alias("importance_std"),
    )


def pdp_grid(df: DataFrame, columns: Sequence[str], points: int = 100, low: float = 0.05, high: float = 0.95) -> dict[str, list[float]]:
    """Grid per feature: all distinct values if fewer than ``points``, else even steps between two quantiles."""
    few = df.agg(*[F.approx_count_distinct(as_col(c)).alias(c) for c in columns]).first()
    cuts = {r["column"]: (r["q0"], r["q1"]) for r in exact_quantiles(df, columns, [low, high]).collect()}
    out = {}
    for c in columns:
        values = None
        if few[c] <= 2 * points:
            # Bounded by points + 1 values.
            got = [r[0] for r in df.select(as_col(c).cast("double")).where(as_col(c).isNotNull()).distinct().limit(points + 1).collect()]
            values = sorted(got) if len(got) < points else None
        out[c] = values or [float(x) for x in np.linspace(*cuts[c], points)]
    return out


def partial_dependence(df: DataFrame, score: Scorer, columns: Sequence[str], grid: dict[str, list[float]] | None = None,
                       output: str = "y_prob") -> DataFrame:
    """(feature, value, mean_prediction): every row scored at every grid value, averaged before any shuffle."""
    grid = grid or pdp_grid(df, columns)
    points = F.array(
        *[F.struct(F.lit(c).alias("f"), F.lit(float(v)).alias("v")) for c in columns for v in grid[c]]
    )
    rows = df.withColumn("__p", F.explode(points)).withColumns({"feature": F.col("__p.f"), "value": F.col("__p.v")}).drop("__p")
    rows = rows.withColumns({c: F.when(F.col("feature") == c, F.col("value")).otherwise(as_col(c).cast("double")) for c in columns})
    return score(rows).groupBy("feature", "value").agg(F.avg(output).alias("mean_prediction"))


def _by_row(df: DataFrame, row_id: str) -> DataFrame:
    """Shuffle the rows once by id before they are multiplied, so that the sums per row need no shuffle after it."""
    return df.repartition(shuffle_width(df.sparkSession), as_col(row_id))


def _noise(seed: int, *ids: str) -> Column:
    """A reproducible number in [0, 1) from a fast hash."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[as_col(c) for c in ids]), 11)
    return bits.cast("double") / F.lit(9007199254740992.0)


def shapley_sampling(df: DataFrame, score: Scorer, columns: Sequence[str], background: Sequence[Sequence[float]], row_id: str = "id",
                     permutations: int = 8, output: str = "y_prob", seed: int = 42) -> DataFrame:
    """(id, feature, attribution) by sampled feature orders against a fixed background set.

    Per row and order, features switch one after another from the background to the row's value; a
    feature's attribution is the mean score change at its switch. The attributions of a row add up
    to its score minus the mean score of its background rows.
    """
    d = len(columns)
    bg = F.array(*[F.array(*[F.lit(float(x)) for x in b]) for b in background])
    # each row and draw has an order of its own: the features by their hashes
    turn = F.array(*[F.struct(F.xxhash64(F.lit(seed + j), as_col(row_id), "__perm").alias("h"), F.lit(j).alias("j")) for j in range(d)])
    places = F.array(*[F.array_position("__order", F.lit(j)).cast("int") - 1 for j in range(d)])
    rows = (
        _by_row(df, row_id)
        .withColumns({c: as_col(c).cast("double") for c in columns})
        .withColumn("__perm", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
        .withColumn("__order", F.transform(F.array_sort(turn), lambda x: x["j"]))
        .withColumn("__place", places)
        .withColumn("__bg", F.element_at(bg, F.pmod(F.col("__perm"), F.lit(len(background))) + 1))
        .withColumn("__step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    )
    swapped = rows.withColumns(
        {
            c: F.when(F.col("__place")[j] < F.col("__step"), as_col(c)).otherwise(F.col("__bg")[j])
            for j, c in enumerate(columns)
        }
    )
    v = F.col(output)
    # The score after step s counts for the feature switched at s and against the one switched next.
    gains = F.array_compact(
        F.array(
            F.when(F.col("__step") > 0, F.struct(F.try_element_at("__order", F.greatest("__step", F.lit(1))).alias("j"), v.alias("g"))),
            F.when(F.col("__step") < d, F.struct(F.try_element_at("__order", F.least(F.col("__step") + 1, F.lit(d))).alias("j"), (-v).alias("g"))),
        )
    )
    names = F.array(*[F.lit(c) for c in columns])
    return (
        score(swapped)
        .select(row_id, F.explode(gains).alias("x"))
        .groupBy(row_id, F.element_at(names, F.col("x.j") + 1).alias("feature"))
        .agg((F.sum("x.g") / permutations).alias("attribution"))
    )


def shapley_summary(values: DataFrame) -> DataFrame:
    return values.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("mean_abs_attribution"))


def local_surrogate(df: DataFrame, score: Scorer, columns: Sequence[str], row_id: str = "id", samples: int = 200,
                    output: str = "y_prob", ridge: float = 1.0, top: int = 10, seed: int = 42) -> DataFrame:
    """(id, feature, weight, rank): a kernel-weighted linear fit around every row of ``df``.

    Perturbations, scores and the weighted moment sums are plain aggregates; only the small
    per-row system (features squared) is solved in Python.
    """
    d = len(columns)
    stat = df.agg(*[F.stddev_pop(as_col(c)).alias(c) for c in columns]).first()
    scale = {c: float(stat[c] or 1.0) for c in columns}
    width = 0.75 * float(np.sqrt(d))
    rows = _by_row(df, row_id).withColumns({c: as_col(c).cast("double") for c in columns}).withColumn(
        "__s", F.explode(F.sequence(F.lit(0), F.lit(samples - 1)))
    )
    noise = {}
    for j, c in enumerate(columns):
        a, b = _noise(seed + 2 * j, row_id, "__s"), _noise(seed + 2 * j + 1, row_id, "__s")
        normal = F.sqrt(-2 * F.ln(F.greatest(a, F.lit(1e-12)))) * F.cos(F.lit(2 * np.pi) * b)
        noise[f"__g{j}"] = F.when(F.col("__s") == 0, F.lit(0.0)).otherwise(normal)  # sample 0 is the row itself
    rows = rows.withColumns(noise)
    rows = rows.withColumns({c: as_col(c) + F.col(f"__g{j}") * F.lit(scale[c]) for j, c in enumerate(columns)})
    dist2 = sum((F.col(f"__g{j}") * F.col(f"__g{j}") for j in range(d)), F.lit(0.0))
    z = [F.lit(1.0), *[F.col(f"__g{j}") for j in range(d)]]
    scored = score(rows).withColumn("__w", F.exp(-dist2 / F.lit(width * width)))
    w, y = F.col("__w"), F.col(output)
    sums = scored.groupBy(row_id).agg(
        F.array(*[F.sum(w * z[i] * z[j]) for i in range(d + 1) for j in range(i, d + 1)]).alias("xx"),
        F.array(*[F.sum(w * z[i] * y) for i in range(d + 1)]).alias("xy"),
    )
    upper = np.triu_indices(d + 1)
    names = list(columns)
    kind = dict(df.dtypes)[row_id]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            ids, weights = [], []
            for rid, xx, xy in zip(b[row_id], b["xx"], b["xy"]):
                a = np.zeros((d + 1, d + 1))
                a[upper] = xx
                a = a + np.triu(a, 1).T + np.diag([0.0] + [ridge] * d)
                ids.append(rid)
                weights.append(np.linalg.solve(a, np.asarray(xy))[1:])
            yield pd.DataFrame({row_id: np.repeat(ids, d), "feature": names * len(ids), "weight": np.concatenate(weights)})

    fitted = sums.mapInPandas(solve, f"{row_id} {kind}, feature string, weight double")
    from pyspark.sql import Window

    best = Window.partitionBy(row_id).orderBy(F.abs("weight").desc(), "feature")  # one row per feature
    return fitted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


_SPLIT = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>|in|not in) (.+)\)$")
_LEAF = re.compile(r"^( *)Predict: (.+)$")


def tree_paths(debug: str, names: Sequence[str], max_depth: int | None = None) -> list[tuple[int, str, float | None, list]]:
    """(leaf, rule text, prediction, conditions) from a fitted tree's printed form.

    Paths are cut at ``max_depth``; a cut one stands for its whole subtree, its text ends in ``...`` and it has no prediction.
    """
    path: list[tuple[int, str, float]] = []
    indents: list[int] = []
    out, seen = [], set()
    for line in debug.splitlines():
        hit = _SPLIT.match(line)
        if hit:
            pad = len(hit[1])
            while indents and indents[-1] >= pad:
                indents.pop()
                path.pop()
            indents.append(pad)
            value = [float(x) for x in hit[5].strip("{}").split(",")] if "in" in hit[4] else float(hit[5])
            path.append((int(hit[3]), hit[4], value))
            continue
        leaf = _LEAF.match(line)
        if leaf:
            pad = len(leaf[1])
            while indents and indents[-1] >= pad:
                indents.pop()
                path.pop()
            kept = list(path[:max_depth] if max_depth else path)
            cut = len(kept) < len(path)
            text = (" AND ".join(f"{names[f]} {op} {v!r}" for f, op, v in kept) or "TRUE") + " AND ..." * cut
            if text not in seen:
                seen.add(text)
                out.append((len(out), text, None if cut else float(leaf[2]), kept))
    return out


def tree_rules(model, df: DataFrame, names: Sequence[str], label: str = "label", max_depth: int | None = None, n_trees: int = 3) -> DataFrame:
    """(tree, leaf, rule, prediction, n, n_positive): readable rules with their coverage counted on ``df``.

    Works for a tree or the first ``n_trees`` of a forest; ``names`` are columns of ``df``. A rule cut
    by ``max_depth`` covers its whole subtree, is marked by ``...`` and predicts the majority of the rows it covers (0 on ties).
    """
    trees = list(model.trees)[:n_trees] if hasattr(model, "trees") else [model]
    table, tags = [], []
    for t, tree in enumerate(trees):
        tag = F.lit(-1)
        for leaf, text, pred, conds in reversed(tree_paths(tree.toDebugString, names, max_depth)):
            cond = F.lit(True)
            for f, op, v in conds:
                x = as_col(names[f])
                cond &= {"<=": lambda: x <= v, ">": lambda: x > v, "in": lambda: x.isin(v), "not in": lambda: ~x.isin(v)}[op]()
            tag = F.when(cond, F.lit(leaf)).otherwise(tag)
            table.append((t, leaf, text, pred))
        tags.append(F.struct(F.lit(t).alias("tree"), tag.alias("leaf")))
    rules = df.sparkSession.createDataFrame(table, "tree int, leaf int, rule string, prediction double")
    cover = (
        df.select(as_col(label).alias("__y"), F.explode(F.array(*tags)).alias("t"))
        .groupBy("t.tree", "t.leaf")
        .agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("__y") == 1).cast("long")).alias("n_positive"))
    )
    out = rules.join(cover, ["tree", "leaf"], "left").fillna(0, ["n", "n_positive"])
    return out.withColumn("prediction", F.coalesce("prediction", (F.col("n_positive") * 2 > F.col("n")).cast("double")))


