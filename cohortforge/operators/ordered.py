"""Global order statistics without a one-partition window.

Running totals, row numbers and exact quantiles over a whole table need a global order.
Here the order is cut into buckets, the (small) bucket totals give each bucket its offset,
and the rows are only sorted inside their bucket, so no task ever holds a whole group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_col, melt, numeric_cols
from ..session import shuffle_width

BUCKET = "__bucket"


def _cut_points(df: DataFrame, order: str, parts: int) -> list[float]:
    """At most ``parts - 1`` cut points that balance the buckets; they never change a result.

    They come from a mergeable sketch of the raw rows (no shuffle): between two cuts lie at most
    1/parts of the rows, so at most that many distinct values, however often one value repeats.
    """
    if parts < 2:
        return []
    probs = [i / parts for i in range(1, parts)]
    got = df.agg(F.percentile_approx(F.col(order).cast("double"), probs, 100 * parts)).first()[0]
    return sorted({float(x) for x in got}) if got else []


def _with_buckets(df: DataFrame, order: str, parts: int | None, raw: DataFrame | None) -> DataFrame:
    parts = parts or shuffle_width(df.sparkSession)
    cuts = _cut_points(df if raw is None else raw, order, parts)
    if not cuts:
        return df.withColumn(BUCKET, F.lit(0))
    lookup = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="__order", outputCol=BUCKET)
    return (
        lookup.transform(df.withColumn("__order", F.col(order).cast("double")))
        .drop("__order")
        # Never null, so no null filter is pushed into one use only and the counted rows are shared.
        .withColumn(BUCKET, F.coalesce(F.col(BUCKET).cast("int"), F.lit(0)))
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str],
    descending: bool = False,
    following: bool = False,
    parts: int | None = None,
    raw: DataFrame | None = None,
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive) and ``total_<c>`` for every column in ``sums``.

    ``df`` holds one row per (keys, order): aggregate first, so that tied values are one row
    and a hot value is combined before the shuffle. With ``following`` the next row's values
    are added as ``next_<c>`` (null on the last row). Keys and order must not be null. ``raw`` is
    the table ``df`` was counted from, if it still has the ``order`` column.
    """
    rows = _with_buckets(df, order, parts, raw)
    turn = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    edge = F.max_by if descending else F.min_by
    head = F.struct(*[as_col(c) for c in sums])
    totals = rows.groupBy(*keys, BUCKET).agg(
        *[F.sum(as_col(c)).alias(f"__s_{c}") for c in sums], edge(head, F.col(order)).alias("__head")
    )
    # One row per key and bucket: at most `parts` rows in any window of this small table.
    by_key = Window.partitionBy(*([as_col(k) for k in keys] or [F.lit(0)]))
    before = by_key.orderBy(turn(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        BUCKET,
        *[F.coalesce(F.sum(f"__s_{c}").over(before), F.lit(0)).alias(f"__o_{c}") for c in sums],
        *[F.sum(f"__s_{c}").over(by_key).alias(f"total_{c}") for c in sums],
        F.lead("__head").over(by_key.orderBy(turn(BUCKET))).alias("__after"),
    )
    inside = Window.partitionBy(*[as_col(k) for k in keys], BUCKET).orderBy(turn(order))
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(offsets, [*keys, BUCKET])
    cols: dict[str, Column] = {
        f"cum_{c}": F.col(f"__o_{c}") + F.sum(as_col(c)).over(upto) for c in sums
    }
    if following:
        nxt = F.coalesce(F.lead(head).over(inside), F.col("__after"))
        cols |= {f"next_{c}": nxt[c] for c in sums}
    return out.select(
        *[as_col(c) for c in df.columns],
        *[v.alias(k) for k, v in cols.items()],
        *[F.col(f"total_{c}") for c in sums],
    )


def hash_order(seed: int, *ids: str) -> Column:
    """A reproducible shuffle key: the same row gets the same place whatever the partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[as_col(c).cast("string") for c in ids]))


def hash_rank(
    df: DataFrame,
    keys: Sequence[str],
    ids: Sequence[str],
    seed: int = 42,
    rank: str = "rank",
    total: str | None = None,
) -> DataFrame:
    """1-based row number in hash order within ``keys`` (all rows if empty), plus the key's row count.

    The hash is uniform, so its leading digits cut every group, hot or not, into even buckets.
    """
    digits = 2 if shuffle_width(df.sparkSession) <= 64 else 3
    rows = df.withColumn("__h", hash_order(seed, *ids)).withColumn(BUCKET, F.substring("__h", 1, digits))
    sizes = rows.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    by_key = Window.partitionBy(*([as_col(k) for k in keys] or [F.lit(0)]))
    before = by_key.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[as_col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col(BUCKET).alias("__kb"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"),
        F.sum("__n").over(by_key).alias("__total"),
    )
    inside = Window.partitionBy(*[as_col(k) for k in keys], BUCKET).orderBy("__h")
    same = F.col(BUCKET) == F.col("__kb")
    for i, k in enumerate(keys):
        same &= as_col(k).eqNullSafe(F.col(f"__k{i}"))
    out = rows.join(offsets, same).select(
        *[as_col(c) for c in df.columns],
        (F.col("__o") + F.row_number().over(inside)).cast("long").alias(rank),
        F.col("__total").alias(total or "__total"),
    )
    return out if total else out.drop("__total")


def value_counts_long(df: DataFrame, cols: Sequence[str], cast: str, ids: Sequence[str] = ()) -> DataFrame:
    """(ids, column, value, n) over non-null values, combined map-side."""
    long = melt(df, ids, cols, cast).where(F.col("value").isNotNull())
    if cast == "double":
        long = long.where(~F.isnan("value"))
    return long.groupBy(*ids, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    approx: bool = False,
) -> DataFrame:
    """Linear-interpolated quantiles, one row per (by, column): columns ``q0``, ``q1``, ... and ``n``.

    Exact and distributed. Over a whole table a sketch brackets every quantile, a second pass counts the rows
    below and inside each bracket, and only the rows inside (a few in ten thousand, equal ones combined) are moved
    and ordered. Per group, distinct values are counted first, then located by running counts.
    ``approx=True`` is one pass with a sketch, for columns where exactness is not needed.
    """
    if not by and not approx:
        return _bracketed_quantiles(df, cols, probs)
    if approx:
        long = melt(df, by, cols, "double").where(F.col("value").isNotNull() & ~F.isnan("value"))
        return long.groupBy(*by, "column").agg(
            *[F.percentile_approx("value", p, 10000).alias(f"q{i}") for i, p in enumerate(probs)],
            F.count(F.lit(1)).alias("n"),
        )
    for c in by:
        df = df.where(as_col(c).isNotNull())  # a null group has no quantile row
    counts = value_counts_long(df, cols, "double", by)
    parts = shuffle_width(df.sparkSession)
    keys = [*by, "column"]
    if parts > 1:
        cut = [i / parts for i in range(1, parts)]
        # Bounded: one short array per profiled column, from one pass of sketches.
        got = df.agg(*[F.percentile_approx(as_col(c).cast("double"), cut, 100 * parts).alias(c) for c in cols]).first()
        bucket = F.lit(0)
        for c in cols:
            edges = F.array(*[F.lit(float(x)) for x in sorted(set(got[c] or []))]).cast("array<double>")
            below = F.size(F.filter(edges, lambda e: e <= F.col("value")))
            bucket = F.when(F.col("column") == c, below).otherwise(bucket)
        rows = counts.withColumn(BUCKET, F.coalesce(bucket, F.lit(0)))
    else:
        rows = counts.withColumn(BUCKET, F.lit(0))
    totals = rows.groupBy(*keys, BUCKET).agg(F.sum("n").alias("__s"))
    by_key = Window.partitionBy(*[as_col(k) for k in keys])
    offsets = totals.select(
        *keys,
        BUCKET,
        F.coalesce(
            F.sum("__s").over(by_key.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__o"),
        F.sum("__s").over(by_key).alias("__n"),
    )
    inside = (
        Window.partitionBy(*[as_col(k) for k in keys], BUCKET)
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = (
        rows.join(offsets, [*keys, BUCKET])
        .withColumn("__hi", F.col("__o") + F.sum("n").over(inside))
        .withColumn("__lo", F.col("__hi") - F.col("n"))
    )
    aggs = [F.first("__n").alias("n")]
    for i, p in enumerate(probs):
        place = F.lit(float(p)) * (F.col("__n") - 1)
        for tag, at in (("a", F.floor(place)), ("b", F.ceil(place))):
            hit = (F.col("__lo") <= at) & (at < F.col("__hi"))
            aggs.append(F.max(F.when(hit, F.col("value"))).alias(f"__{tag}{i}"))
    found = placed.groupBy(*keys).agg(*aggs)
    return found.select(
        *keys,
        *[
            (
                F.col(f"__a{i}")
                + (F.lit(float(p)) * (F.col("n") - 1) - F.floor(F.lit(float(p)) * (F.col("n") - 1)))
                * (F.col(f"__b{i}") - F.col(f"__a{i}"))
            ).alias(f"q{i}")
            for i, p in enumerate(probs)
        ],
        "n",
    )


SKETCH = 10_000  # rank error of the sketch: one in so many rows


def _bracketed_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    rows = df.select(*[F.nanvl(as_col(c).cast("double"), F.lit(None)).alias(f"x{j}") for j, c in enumerate(cols)])
    xs, inf = [F.col(f"x{j}") for j in range(len(cols))], float("inf")
    slots = [(j, i) for j in range(len(cols)) for i in range(len(probs))]
    ends: dict[tuple[int, int], tuple[float, float]] = {}
    below: dict[tuple[int, int], int] = {}
    todo, reach, sizes = slots, 2 / SKETCH, []
    while todo:
        # One short row per column and round: the brackets, then how many rows lie below and inside.
        want = sorted({min(max(p + s * reach, 0.0), 1.0) for p in probs for s in (-1, 1)})
        got = rows.agg(*[F.percentile_approx(x, want, SKETCH) for x in xs], *[F.count(x) for x in xs]).first()
        sizes = [int(n) for n in got[len(xs) :]]
        todo = [(j, i) for j, i in todo if sizes[j]]
        for j, i in todo:
            at = dict(zip(want, got[j]))
            low, high = probs[i] - reach, probs[i] + reach
            ends[j, i] = (at[low] if low > 0 else -inf, at[high] if high < 1 else inf)
        if not todo:
            break
        seen = rows.agg(*[f for j, i in todo for f in (F.count(F.when(xs[j] < ends[j, i][0], 1)), F.count(F.when(xs[j] <= ends[j, i][1], 1)))]).first()
        missed = []
        for k, (j, i) in enumerate(todo):
            place = probs[i] * (sizes[j] - 1)
            below[j, i] = seen[2 * k]
            if not (seen[2 * k] <= math.floor(place) and math.ceil(place) < seen[2 * k + 1]):
                missed.append((j, i))
        todo, reach = missed, reach * 8
    none = ", ".join(f"q{i} double" for i in range(len(probs)))
    if not ends:
        return df.sparkSession.createDataFrame([], f"column string, {none}, n long")
    places = {(j, i): probs[i] * (sizes[j] - 1) for j, i in ends}
    of = list(ends)
    lookup = lambda kind, values: F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("slot"))
    cells = [F.when(xs[j].between(F.lit(ends[j, i][0]), F.lit(ends[j, i][1])), F.struct(F.lit(k).alias("slot"), xs[j].alias("value"))) for k, (j, i) in enumerate(of)]
    inside = rows.select(F.explode(F.array_compact(F.array(*cells))).alias("c")).groupBy("c.slot", "c.value").agg(F.count(F.lit(1)).alias("n"))
    upto = inside.withColumn("upto", F.sum("n").over(Window.partitionBy("slot").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)))
    at = lambda r: F.max(F.when((F.col("upto") - F.col("n") <= r) & (r < F.col("upto")), F.col("value")))
    low = lookup("long", [math.floor(places[o]) - below[o] for o in of])
    high = lookup("long", [math.ceil(places[o]) - below[o] for o in of])
    part = lookup("double", [places[o] - math.floor(places[o]) for o in of])
    found = upto.groupBy("slot").agg(at(low).alias("a"), at(high).alias("b")).withColumn("q", F.col("a") + part * (F.col("b") - F.col("a")))
    found = found.withColumns({"column": lookup("string", [cols[j] for j, _ in of]), "i": lookup("int", [i for _, i in of]), "n": lookup("long", [sizes[j] for j, _ in of])})
    return found.groupBy("column", "n").agg(*[F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"q{i}") for i in range(len(probs))]).select("column", *[f"q{i}" for i in range(len(probs))], "n")


def modes(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), cast: str = "string") -> DataFrame:
    """Most frequent value per (by, column): (by, column, top, freq, unique). Ties go to the smallest value, numbers by size."""
    counts = value_counts_long(df, cols, cast, by)
    numbers = [c for c in numeric_cols(df) if c in cols]
    size = F.when(F.col("column").isin(numbers), F.col("value").try_cast("double")) if numbers else F.lit(None).cast("double")
    best = F.min_by(F.struct("value", "n"), F.struct((-F.col("n")).alias("k"), size.alias("s"), F.col("value")))
    return (
        counts.groupBy(*by, "column")
        .agg(best.alias("b"), F.count(F.lit(1)).alias("unique"))
        .select(*by, "column", F.col("b.value").alias("top"), F.col("b.n").alias("freq"), "unique")
    )
