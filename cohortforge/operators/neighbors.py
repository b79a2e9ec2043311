"""Exact k-nearest-neighbour join.

Rows are cut into cells around a bounded set of pivots. Distances to the pivots give, by the
triangle inequality, a radius that must hold the k nearest rows of a query, so whole cells outside
it are skipped. Neighbouring cells are packed into blocks of bounded size (a dense cell, even one
holding a third of the rows, is split by hash), and so are the queries. A query is sent once to each
block that can hold one of its neighbours, whatever number of cells it asks there; a task compares one
block of queries with one block of rows, cell by cell, and passes on only the k best per query.

Inside a task a matrix product bounds all distances of a cell at once; only rows that can be among
the k best are measured exactly. Every array is bounded by the block, so memory does not grow with the tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_col
from ..session import cut_lineage
from .clean import row_sample

MAX_PIVOTS = 1024
#: Rows of a cell at least, on average.
CELL_ROWS = 256
#: Bytes of the vectors of a block, and numbers held at once in a task's arrays.
BLOCK_BYTES, AT_ONCE = 64_000_000, 2_000_000


def _matrix(col: pd.Series) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype="float64") for v in col])


def _packed(m: np.ndarray) -> list[bytes]:
    return [v.tobytes() for v in np.ascontiguousarray(m)]


def _unpacked(col: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col), dtype="float64").reshape(len(col), width)


def _steps(n: int, size: int) -> Iterator[slice]:
    for i in range(0, n, size):
        yield slice(i, min(i + size, n))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Plain differences (no expanded square), so equal rows give exactly equal distances; both sides bounded."""
    out = np.empty((len(a), len(b)))
    step = max(1, 2_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        d = a[i : i + step, None, :] - b[None, :, :]
        out[i : i + step] = np.sqrt((d * d).sum(axis=2))
    return out


def _squares(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances as one matrix product, and per row of ``a`` a bound of their error."""
    width = a.shape[1]
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    top = max(aa.max(initial=0.0), bb.max(initial=0.0))
    kind = np.float32 if width > 16 and 1e-12 < top < 1e30 else np.float64
    left = np.column_stack([-2 * a, aa, np.ones(len(a))]).astype(kind)
    right = np.column_stack([b, np.ones(len(b)), bb]).astype(kind)
    unit, tiny = (6e-8, 1e-35) if kind is np.float32 else (1.2e-16, 1e-300)
    return left @ right.T, 4 * (width + 8) * unit * (aa + bb.max(initial=0.0)) + tiny


@dataclass
class Cells:
    """Pivots in an order that keeps neighbours together, and what is known about the rows around each (lists of pivots only)."""

    pivots: np.ndarray
    radius: np.ndarray  # -1 where a cell is empty
    gaps: np.ndarray  # of the k rows nearest to the pivot, at most
    between: np.ndarray
    error: float = 0.0

    @classmethod
    def around(cls, pivots: np.ndarray, k: int) -> Cells:
        n = len(pivots)
        return cls(pivots, np.full(n, -1.0), np.full((n, k), np.inf), _distances(pivots, pivots))

    def measure(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, pivot) distances, and per row how far they may be off."""
        at = self.pivots.mean(axis=0)
        a, p = x - at, self.pivots - at
        aa, pp = (a * a).sum(axis=1)[:, None], (p * p).sum(axis=1)[None, :]
        off = 8 * (x.shape[1] + 8) * 1.2e-16 * (aa + pp.max(initial=0.0)) + 1e-300
        return np.sqrt(np.maximum(aa + pp - 2 * (a @ p.T), 0.0)), np.sqrt(off)

    def know(self, cell: int, radius: float, gaps: list[float]) -> None:
        self.radius[cell] = radius
        self.gaps[cell, : len(gaps)] = gaps
        at = self.pivots.mean(axis=0)
        far = float(np.sqrt(((self.pivots[cell] - at) ** 2).sum())) + radius
        self.error = max(self.error, 8 * (self.pivots.shape[1] + 8) * 1.2e-16 * 2 * far * far)

    def limits(self, d: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Per query a distance within which at least k rows lie."""
        k = self.gaps.shape[1]
        m = min(len(self.pivots), 2 * k + 8)
        some = np.argpartition(d, m - 1, axis=1)[:, :m]

        def nth(rows: np.ndarray, cells: np.ndarray) -> np.ndarray:
            reach = (np.take_along_axis(d[rows], cells, axis=1) + off[rows])[:, :, None] + self.gaps[cells]
            return np.partition(reach.reshape(len(rows), -1), k - 1, axis=1)[:, k - 1]

        out = nth(np.arange(len(d)), some)
        short = np.flatnonzero(np.isinf(out)) if m < len(self.pivots) else []
        every = np.arange(len(self.pivots))[None, :]
        for i in short:  # few rows around the closest pivots
            out[i] = nth(np.array([i]), every)[0]
        return out * (1 + 1e-9) + 1e-12

    def may_hold(self, d: np.ndarray, off: np.ndarray, home: np.ndarray, nearest: np.ndarray, limit: np.ndarray, cells: np.ndarray | None = None) -> np.ndarray:
        """(query, cell): whether the cell can hold a row within the query's limit; ``d`` has the columns of ``cells``."""
        cells = np.arange(len(self.pivots)) if cells is None else cells
        radius, limit = self.radius[cells][None, :], limit[:, None]
        apart = self.between[home[:, None], cells]
        plane = np.full(d.shape, -np.inf)
        np.divide(d**2 - nearest[:, None] ** 2 - 2 * (off**2 + self.error), 2 * apart, out=plane, where=apart > 0)
        return (radius >= 0) & (d - off - radius <= limit) & (plane <= limit + 1e-9)


def _in_order(points: np.ndarray) -> np.ndarray:
    """Places of the points, halved again and again along their widest column, so that neighbours follow each other."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        part = todo.pop()
        spread = np.ptp(points[part], axis=0)
        if len(part) < 3 or not spread.size or not spread.max() > 0:
            out.extend(part)
            continue
        part = part[np.argsort(points[part, int(spread.argmax())], kind="stable")]
        half = len(part) // 2
        todo += [part[half:], part[:half]]
    return np.array(out, dtype=int)


def _pack(counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First block and number of blocks of every cell, and the number of all: small cells share a block, large ones are split."""
    first, parts = np.zeros(len(counts), dtype="int64"), np.ones(len(counts), dtype="int64")
    block, filled = 0, 0
    for c, n in enumerate(counts):
        if filled and filled + n > most:
            block, filled = block + 1, 0
        first[c] = block
        if n > most:
            parts[c] = -(-int(n) // most)
            block += int(parts[c])
        else:
            filled += int(n)
    return first, parts, block + 1


def knn_join(
    queries: DataFrame,
    rows: DataFrame,
    k: int = 5,
    query_id: str = "id",
    row_id: str = "id",
    vector: str = "vector",
    exclude_self: bool = False,
    block_rows: int = 65_536,
    seed: int = 42,
) -> DataFrame:
    """(query_id, neighbor_id, distance, rank): the ``k`` nearest rows of every query, ties by row id.

    ``vector`` is an array of doubles on both sides; with ``exclude_self`` a row is not its own neighbour.
    Rows and queries without a vector, or with a component that is null or not finite, take no part.

    Copies are compared once: among equal rows only the first few ids can be among the nearest, and
    equal queries share one search. So a group of copies of any size adds no quadratic work.
    """
    need = k + (1 if exclude_self else 0)
    usable = F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    asked = queries.select(as_col(query_id).alias("qid"), as_col(vector).cast("array<double>").alias("vec")).where(usable)
    held = rows.select(as_col(row_id).alias("rid"), as_col(vector).cast("array<double>").alias("vec")).where(usable)
    copies = Window.partitionBy("vec").orderBy("rid")
    held = held.withColumn("__c", F.row_number().over(copies)).where(F.col("__c") <= need).drop("__c")
    heads = cut_lineage(asked.groupBy("vec").agg(F.min("qid").alias("head")))
    found = _search(heads, cut_lineage(held), need, block_rows, seed)
    served = asked.join(heads, "vec").select("qid", "head").join(found, "head")
    if exclude_self:
        served = served.where(F.col("qid") != F.col("rid"))
    order = Window.partitionBy("qid").orderBy("distance", "rid")
    return (
        served.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(F.col("qid").alias("query_id"), F.col("rid").alias("neighbor_id"), "distance", "rank")
    )


def _search(q: DataFrame, r: DataFrame, k: int, block_rows: int, seed: int) -> DataFrame:
    """(head, rid, distance): at least the ``k`` nearest rows of every query vector."""
    spark = r.sparkSession
    q = q.select(F.col("head").alias("qid"), "vec")
    n_rows, n_queries = r.count(), q.count()
    id_type, row_type = dict(q.dtypes)["qid"], dict(r.dtypes)["rid"]
    if n_rows == 0 or n_queries == 0:
        return spark.createDataFrame([], f"head {id_type}, rid {row_type}, distance double")
    n_pivots = int(min(MAX_PIVOTS, max(1, -(-n_rows // CELL_ROWS))))
    # Bounded: at most MAX_PIVOTS rows.
    pivots = _matrix(pd.Series([x["vec"] for x in row_sample(r, ["rid"], n_pivots, seed).collect()]))
    cells = Cells.around(pivots[_in_order(pivots)], k)
    width, n_pivots = pivots.shape[1], len(pivots)
    # A few tasks for each core, blocks of one size on both sides.
    share = int(np.sqrt(n_rows * n_queries / (4 * max(1, spark.sparkContext.defaultParallelism))))
    block = max(1, min(block_rows, BLOCK_BYTES // (8 * max(1, width)), max(CELL_ROWS, share)))
    together = max(1, AT_ONCE // (n_pivots + (2 * k + 8) * k))

    def to_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in _steps(len(b), together):
                x = _matrix(b["vec"].iloc[part])
                d, off = cells.measure(x)
                cell = d.argmin(axis=1)
                yield pd.DataFrame({"rid": b["rid"].iloc[part].to_numpy(), "vec": _packed(x), "cell": cell.astype("int32"), "gap": d[np.arange(len(x)), cell] + off[:, 0]})

    # Read three times (sizes, closest rows, comparison), so the pivot distances are computed once.
    placed = cut_lineage(r.mapInPandas(to_cell, f"rid {row_type}, vec binary, cell int, gap double"))
    near = Window.partitionBy("cell").orderBy("gap")
    closest = (
        placed.select("cell", "gap")
        .withColumn("i", F.row_number().over(near))
        .where(F.col("i") <= k)
        .groupBy("cell")
        .agg(F.sort_array(F.collect_list("gap")).alias("gaps"))
    )
    sizes = np.zeros(n_pivots, dtype="int64")
    # Bounded: one line per pivot with `k` numbers.
    for c in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("radius")).join(closest, "cell").collect():
        sizes[c["cell"]] = c["n"]
        cells.know(c["cell"], c["radius"], c["gaps"])
    first, parts, n_blocks = _pack(sizes, block)
    in_block = np.zeros((n_pivots, n_blocks), dtype="float32")
    for c in np.flatnonzero(sizes):
        in_block[c, first[c] : first[c] + parts[c]] = 1

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in _steps(len(b), together):
                x = _matrix(b["vec"].iloc[part])
                d, off = cells.measure(x)
                home = d.argmin(axis=1)
                limit = cells.limits(d, off)
                hit = cells.may_hold(d, off, home, d[np.arange(len(x)), home], limit).astype("float32") @ in_block > 0
                blocks = [np.flatnonzero(h).astype("int32") for h in hit]
                yield pd.DataFrame({"qid": b["qid"].iloc[part].to_numpy(), "vec": _packed(x), "home": home.astype("int32"), "limit": limit, "blocks": blocks})

    asked = cut_lineage(q.mapInPandas(ask, f"qid {id_type}, vec binary, home int, limit double, blocks array<int>"))
    homes = np.zeros(n_pivots, dtype="int64")
    for c in asked.groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect():  # one number per pivot
        homes[c["home"]] = c["n"]

    def place(cell: str, key: str, at: tuple) -> F.Column:
        """The block of a row: that of its cell, or one of its cell's blocks by hash."""
        one, many = (F.element_at(F.array(*[F.lit(int(x)) for x in v]), F.col(cell) + 1) for v in at[:2])
        return (one + F.pmod(F.xxhash64(key), many)).cast("int")

    asked = asked.select("qid", "vec", "home", "limit", place("home", "qid", _pack(homes, block)).alias("chunk"), F.explode("blocks").alias("block"))
    # Rows of a block meet every chunk of queries that asks it.
    pairs = asked.select(F.col("chunk").alias("by"), F.col("block").alias("of")).distinct()
    held = placed.select("rid", "vec", "cell", place("cell", "rid", (first, parts)).alias("at")).join(pairs, F.col("at") == F.col("of"))

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"head": a["qid"].iloc[:0], "rid": b["rid"].iloc[:0], "distance": np.zeros(0)})
        b = b.sort_values("rid", kind="stable")
        rid, cell = b["rid"].to_numpy(), b["cell"].to_numpy()
        best, at = _nearest(_unpacked(a["vec"], width), a["home"].to_numpy(), a["limit"].to_numpy(), _unpacked(b["vec"], width), cell, cells, k)
        qi, rank = np.nonzero(at >= 0)
        return pd.DataFrame({"head": a["qid"].to_numpy()[qi], "rid": rid[at[qi, rank]], "distance": best[qi, rank]})

    partial = (
        asked.groupBy("block", "chunk")
        .cogroup(held.groupBy("of", "by"))
        .applyInPandas(compare, f"head {id_type}, rid {row_type}, distance double")
    )
    # The k best of each block, merged per query before they are handed to its copies.
    order = Window.partitionBy("head").orderBy("distance", "rid")
    return partial.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= k).drop("__r")


def _nearest(x: np.ndarray, home: np.ndarray, limit: np.ndarray, y: np.ndarray, cell: np.ndarray, cells: Cells, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances and places in ``y`` of the ``k`` nearest rows within every query's limit; -1 where there are fewer."""
    best, at, limit = np.full((len(x), k), np.inf), np.full((len(x), k), -1, dtype="int64"), limit.copy()
    by_cell = np.argsort(cell, kind="stable")
    present, starts = np.unique(cell[by_cell], return_index=True)
    members = dict(zip(present, np.split(by_cell, starts[1:])))
    for part in _steps(len(x), max(1, min(8192, AT_ONCE // len(cells.pivots)))):
        d, off = cells.measure(x[part])
        nearest = d[np.arange(len(d)), home[part]]
        d = d[:, present]
        for j in np.argsort(d.mean(axis=0), kind="stable"):
            c = present[j : j + 1]
            asks = np.flatnonzero(cells.may_hold(d[:, j : j + 1], off, home[part], nearest, limit[part], c)[:, 0])
            rows = members[c[0]]
            for some in _steps(len(asks), max(1, AT_ONCE // len(rows))):
                _improve(x, part.start + asks[some], y, rows, cells.pivots[c[0]], best, at, limit, k)
    return best, at


def _improve(x: np.ndarray, q: np.ndarray, y: np.ndarray, rows: np.ndarray, pivot: np.ndarray, best: np.ndarray, at: np.ndarray,
             limit: np.ndarray, k: int) -> None:
    """Takes the rows of one cell into the best of the queries ``q``; a query's limit shrinks to its k-th distance."""
    square, off = _squares(x[q] - pivot, y[rows] - pivot)
    reach = limit[q] ** 2 * (1 + 1e-9) + off
    may = ~(square > reach[:, None])
    if len(rows) > k and may.sum() > 8 * k * len(q):
        reach = np.minimum(reach, np.partition(square, k - 1, axis=1)[:, k - 1] + 2 * off)
        may = ~(square > reach[:, None])
    del square
    qi, ri = np.nonzero(may)
    dist = np.empty(len(qi))
    for s in _steps(len(qi), max(1, AT_ONCE // max(1, x.shape[1]))):
        diff = x[q[qi[s]]] - y[rows[ri[s]]]  # plain differences: equal rows give exactly equal distances
        dist[s] = np.sqrt((diff * diff).sum(axis=1))
    near = dist <= limit[q[qi]]
    qi, place, dist = q[qi[near]], rows[ri[near]], dist[near]
    if not len(qi):
        return
    hit = np.unique(qi)
    qi, dist, place = np.append(qi, np.repeat(hit, k)), np.append(dist, best[hit].ravel()), np.append(place, at[hit].ravel())
    order = np.lexsort((place, dist, qi))
    first = np.searchsorted(qi[order], hit)
    order = order[first[:, None] + np.arange(k)]
    best[hit], at[hit] = dist[order], place[order]
    limit[hit] = np.minimum(limit[hit], best[hit, k - 1])


def knn_classify(neighbors: DataFrame, labels: DataFrame, row_id: str = "id", label: str = "label",
                 weights: str = "uniform", positive: int = 1) -> DataFrame:
    """Vote of the neighbours: (query_id, y_pred, y_prob); smallest label on equal votes."""
    if weights not in ("uniform", "distance"):
        raise ValueError("weights must be 'uniform' or 'distance'")
    vote = F.lit(1.0)
    if weights == "distance":
        exact = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy("query_id"))
        neighbors = neighbors.withColumn("__exact", exact)
        vote = F.when(F.col("__exact") == 1, (F.col("distance") == 0).cast("double")).otherwise(
            F.try_divide(F.lit(1.0), F.col("distance"))
        )
    side = labels.select(as_col(row_id).alias("neighbor_id"), as_col(label).alias("__label"))
    votes = neighbors.join(side, "neighbor_id").groupBy("query_id", "__label").agg(F.sum(vote).alias("v"))
    return votes.groupBy("query_id").agg(
        F.min_by("__label", F.struct((-F.col("v")).alias("v"), F.col("__label"))).alias("y_pred"),
        (F.sum(F.when(F.col("__label") == positive, F.col("v")).otherwise(F.lit(0.0))) / F.sum("v")).alias("y_prob"),
    )
