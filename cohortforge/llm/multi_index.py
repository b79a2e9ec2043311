"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut in two halves, each quantised by its own codebook of ``cells`` centroids; a pair of centroids is a
cell. A query walks the pairs by growing summed distance with a heap over the two sorted lists until the cells it
has passed hold the share ``visit`` of all rows; the rows in those cells are reranked by exact distance.

Codebooks, and the share that finds ``recall`` of the true neighbours, are fitted on a bounded sample
(``sample`` vectors, ``probes`` of them as queries); every row is indexed. A share fitted so serves data without
clusters too, at the price of visiting much of it. Whatever the walk leaves out is the approximation; there is no
other cap, and a walk always goes on until ``k`` candidates are found or all cells are passed.

At scale: equal vectors are indexed once with their k + 1 smallest ids (more can't be among the k nearest); cells
are packed in order into buckets of about ``BUCKET`` rows, larger cells are split by hash; a bucket meets a block of
at most ``BLOCK`` queries at a time, each query only in buckets on its walk, and passes on k rows a query.

Edge cases: vectors that are null, empty, zero, of another length than the most common one or hold null or
non-finite values take no part; null ids take no part; repeated rows (id and vector) count once; ties go to the
smaller id; an empty table gives no rows; columns beside the id and the vector are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import Shared, materialize

BUCKET, BLOCK = 8192, 4096


@dataclass
class Index:
    books: tuple[np.ndarray, np.ndarray]
    visit: float
    counts: np.ndarray | None = None  # rows per cell [cells, cells]
    buckets: dict | None = None  # cell -> (first bucket, how many it is split into)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec array<double>) of the rows that take part."""
    vec = F.col(vec_col).cast("array<double>")
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), vec.alias("vec")).where(
        F.col("vec_id").isNotNull() & (F.size("vec") > 0) & F.forall("vec", sound) & F.exists("vec", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vec") == (sizes[0]["n"] if sizes else 0))


def _nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book**2).sum(1) - 2 * x @ book.T).argmin(1)


def _codebook(x: np.ndarray, cells: int, turns: int = 12) -> np.ndarray:
    book = x[np.random.default_rng(0).permutation(len(x))[:cells]].copy()
    for _ in range(turns):
        at = _nearest(x, book)
        for c in np.unique(at):
            book[c] = x[at == c].mean(0)
    return book


def walk(q: np.ndarray, index: Index, k: int) -> list[tuple[int, int]]:
    """Cells with rows by summed distance of their centroids, until they hold the share of all rows."""
    half = index.books[0].shape[1]
    d = [((b - x) ** 2).sum(1) for b, x in zip(index.books, (q[:half], q[half:]))]
    order = [x.argsort(kind="stable") for x in d]
    u, v = d[0][order[0]].tolist(), d[1][order[1]].tolist()
    a, b = order[0].tolist(), order[1].tolist()
    want, got, out = max(index.visit * index.counts.sum(), k + 1), 0, []
    heap, counts, reached = [(u[0] + v[0], 0, 0)], index.counts, [0] * len(a)
    while heap and got < want:
        _, i, j = heapq.heappop(heap)
        n = counts[a[i], b[j]]
        if n:
            got += int(n)
            out.append((a[i], b[j]))
        reached[i] = j + 1
        if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (u[i] + v[j + 1], i, j + 1))
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(heap, (u[i + 1] + v[j], i + 1, j))
    return out


def fit(rows: DataFrame, k: int, recall: float, sample: int, probes: int) -> Index | None:
    """Codebooks and share from the rows with the smallest hashes, at most ``sample``."""
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vec").toPandas()["vec"]
    if not len(some):
        return None
    x = np.stack(some.to_numpy())
    half = (x.shape[1] + 1) // 2
    cells = int(np.clip(round((len(x) / 16) ** 0.5), 1, 64))
    index = Index((_codebook(x[:, :half], cells), _codebook(x[:, half:], cells)), 1.0)
    cells = len(index.books[0])
    at = _nearest(x[:, :half], index.books[0]), _nearest(x[:, half:], index.books[1])
    index.counts = np.zeros((cells, cells), np.int64)
    np.add.at(index.counts, at, 1)
    shares, own = [], at[0] * cells + at[1]
    for i in range(min(probes, len(x))):
        dist = ((x - x[i]) ** 2).sum(1)
        dist[i] = np.inf
        near = np.argsort(dist, kind="stable")[: min(k, len(x) - 1)]
        order = walk(x[i], index, k)
        place = {a * cells + b: p for p, (a, b) in enumerate(order)}
        passed = np.cumsum([index.counts[c] for c in order]) / len(x)
        shares += [passed[place[c]] for c in own[near].tolist()]
    if shares:
        index.visit = float(min(1.0, np.quantile(shares, recall, method="higher")))
    return index


def search(
    vectors: DataFrame, is_query, k: int = 10, recall: float = 0.96, sample: int = 20_000, probes: int = 200,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that ``is_query`` (a condition on vec_id)."""
    spark = vectors.sparkSession
    rows = materialize(usable(vectors, id_col, vec_col).dropDuplicates(["vec_id", "vec"]), "vectors")
    index = fit(rows, k, recall, sample, probes)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if index is None:
        return empty
    shared = Shared(spark, index)
    half = index.books[0].shape[1]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        books = shared.value.books
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["vec"].to_numpy())
                yield pdf.assign(c1=_nearest(x[:, :half], books[0]).astype(np.int32), c2=_nearest(x[:, half:], books[1]).astype(np.int32))

    # of equal vectors the k + 1 smallest ids
    w = Window.partitionBy("vec").orderBy("vec_id")
    fewer = rows.withColumn("copy", F.row_number().over(w)).where(F.col("copy") <= k + 1)
    kinds = fewer.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    cells = materialize(kinds.mapInPandas(assign, "vec array<double>, ids array<long>, c1 int, c2 int"), "cells")
    n = len(index.books[0])
    index.counts = np.zeros((n, n), np.int64)
    for r in cells.groupBy("c1", "c2").count().collect():  # at most one row per cell
        index.counts[r["c1"], r["c2"]] = r["count"]
    index.buckets, bucket, filled = {}, 0, 0
    for c in range(n * n):
        size = int(index.counts[c // n, c % n])
        if not size:
            continue
        parts = -(-size // BUCKET)
        if parts > 1 or filled + size > BUCKET:
            bucket, filled = bucket + (filled > 0), 0
        index.buckets[c] = (bucket, parts)
        bucket, filled = (bucket + parts, 0) if parts > 1 else (bucket, filled + size)
    placed = Shared(spark, index)

    def to_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cell = pdf["c1"].to_numpy(np.int64) * n + pdf["c2"].to_numpy(np.int64)
            first = np.array([placed.value.buckets[c] for c in cell.tolist()], dtype=np.int64).reshape(-1, 2)
            ids = np.array([i[0] for i in pdf["ids"]], dtype=np.int64)
            yield pd.DataFrame({"bucket": first[:, 0] + ids % first[:, 1], "cell": cell, "ids": pdf["ids"], "vec": pdf["vec"]})

    def to_walks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, vec in zip(pdf["vec_id"], pdf["vec"]):
                by: dict[int, list[int]] = {}
                for a, b in walk(np.asarray(vec), placed.value, k):
                    first, parts = placed.value.buckets[a * n + b]
                    for p in range(parts):
                        by.setdefault(first + p, []).append(a * n + b)
                yield pd.DataFrame({"bucket": list(by), "query_id": i, "vec": [vec] * len(by), "cells": list(by.values())})

    def rerank(key, queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(entries):
            x, cell = np.stack(entries["entry"].to_numpy()), entries["cell"].to_numpy()
            ids = entries["ids"].tolist()
            for q, vec, visited in zip(queries["query_id"], queries["vec"], queries["cells"]):
                some = np.flatnonzero(np.isin(cell, visited))
                dist = np.sqrt(((x[some] - vec) ** 2).sum(1))
                # the query's own row may be among the nearest
                near = some[dist <= np.partition(dist, k)[k]] if len(some) > k + 1 else some
                dist = np.sqrt(((x[near] - vec) ** 2).sum(1))
                found = sorted((d, i) for d, s in zip(dist.tolist(), near.tolist()) for i in ids[s] if i != q)[:k]
                out += [(q, i, d) for d, i in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    entries = cells.mapInPandas(to_buckets, "bucket long, cell long, ids array<long>, vec array<double>")
    queries = rows.where(is_query).mapInPandas(to_walks, "bucket long, query_id long, vec array<double>, cells array<long>")
    queries = materialize(queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(max(1, -(-rows.where(is_query).count() // BLOCK))))), "walks")
    wanted = queries.select("bucket", "block").distinct()
    entries = entries.join(wanted, "bucket").select(F.col("bucket").alias("in_bucket"), F.col("block").alias("in_block"), "cell", "ids", F.col("vec").alias("entry"))
    found = queries.groupBy("bucket", "block").cogroup(entries.groupBy("in_bucket", "in_block")).applyInPandas(rerank, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
