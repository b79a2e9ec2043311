"""Work on rows in order without a group in memory: range partitions, runs of a key, digests of whole sequences.

``in_order`` deals rows by ranges of their key and order, so that a key with very many rows lies in many neighbouring
partitions, each sorted. What runs over such partitions sees a key as one or more stretches; only the first and the
last key of a partition can go on in another one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialize

#: Characters of one key that a task holds before it passes them on as a piece.
PIECE = 1 << 20


def in_order(df: DataFrame, by: list[str], within: list[str]) -> DataFrame:
    """Rows dealt by ranges of ``by``, sorted by ``by`` and ``within`` in every partition; nulls first."""
    return df.repartitionByRange(*by).sortWithinPartitions(*by, *within)


def partition_id() -> int:
    return TaskContext.get().partitionId()


def runs(values: pd.Series) -> list[tuple[int, int]]:
    """[i, j) of equal neighbouring values; nulls are equal."""
    if not len(values):
        return []
    before = values.shift()
    new = (values != before) & ~(values.isna() & before.isna())
    new.iloc[0] = True
    at = [*new.to_numpy().nonzero()[0].tolist(), len(values)]
    return list(zip(at, at[1:]))


def ordered_digests(rows: DataFrame, key: str, texts: dict[str, str], sums: list[str]) -> DataFrame:
    """Rows as ``in_order`` gives them -> (key, one digest per column of ``texts``, ``sums`` added up): one row per key.

    A digest is the lowercase SHA-256 of the column's values in order with the given separator between them; a null
    value adds nothing, not even a separator. A key that ends inside a partition is hashed there. The pieces of others
    (joined to at most about PIECE characters) are hashed in order by one task per key, which holds one of them at a
    time: a digest can't be computed in parts.
    """
    kind = rows.schema[key].dataType
    names = list(texts)
    schema = f"`{key}` string, part long, no long, " + ", ".join([*(f"`{t}` string" for t in names), *(f"`{s}` long" for s in sums)])

    def joined(values: list, sep: str) -> str | None:
        values = [v for v in values if v is not None]
        return sep.join(values) if values else None

    def finish(values: dict) -> dict:
        return {t: hashlib.sha256((values[t] or "").encode("utf-8", "replace")).hexdigest() for t in names}

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, no = partition_id(), 0
        held: dict[str, list] = {t: [] for t in names}
        total, size, current, whole, began = dict.fromkeys(sums, 0), 0, None, False, False
        out: list[dict] = []

        def put(closed: bool) -> None:
            nonlocal held, total, size, no
            values = {t: joined(held[t], texts[t]) for t in names}
            out.append({key: current, "part": -1 if closed else part, "no": no, **(finish(values) if closed else values), **total})
            held, total, size, no = {t: [] for t in names}, dict.fromkeys(sums, 0), 0, no + 1

        for pdf in batches:
            columns = {t: pdf[t].astype(object).where(pdf[t].notna(), None).tolist() for t in names}
            counts = {s: pdf[s].tolist() for s in sums}
            for i, j in runs(pdf[key]):
                value = pdf[key].iloc[i]
                value = None if pd.isna(value) else value
                if not began or value != current:
                    if began:
                        put(whole)
                    # the first key of a partition may have begun in the one before
                    current, whole, began = value, began, True
                for t in names:
                    held[t] += columns[t][i:j]
                    size += sum(len(v) for v in columns[t][i:j] if v is not None)
                for s in sums:
                    total[s] += sum(counts[s][i:j])
                if size > PIECE:
                    put(False)
                    whole = False
            if out:
                yield pd.DataFrame(out, columns=[key, "part", "no", *names, *sums])
                out.clear()
        if began:
            put(False)
            yield pd.DataFrame(out, columns=[key, "part", "no", *names, *sums])

    def rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, total, current, began, out = {}, {}, None, False, []

        def put() -> None:
            out.append({key: current, **{t: hashes[t][0].hexdigest() for t in names}, **total})

        for pdf in batches:
            for r in pdf.to_dict("records"):
                value = None if pd.isna(r[key]) else r[key]
                if not began or value != current:
                    if began:
                        put()
                    current, began = value, True
                    hashes, total = {t: [hashlib.sha256(), False] for t in names}, dict.fromkeys(sums, 0)
                for t in names:
                    if r[t] is not None:
                        hashes[t][0].update(((texts[t] if hashes[t][1] else "") + r[t]).encode("utf-8", "replace"))
                        hashes[t][1] = True
                for s in sums:
                    total[s] += r[s]
            if out:
                yield pd.DataFrame(out, columns=[key, *names, *sums])
                out.clear()
        if began:
            put()
            yield pd.DataFrame(out, columns=[key, *names, *sums])

    # keys travel as text: whole numbers beside nulls would become floating point
    done = materialize(rows.select(F.col(key).cast("string"), *names, *sums).mapInPandas(scan, schema), "digests")
    closed = done.where("part < 0").select(key, *names, *sums)
    pieces = done.where("part >= 0").repartition(key).sortWithinPartitions(key, "part", "no")
    return closed.unionAll(pieces.mapInPandas(rest, closed.schema)).withColumn(key, F.col(key).cast(kind))
