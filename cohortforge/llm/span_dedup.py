"""Substring dedup: runs of consecutive sentences that occur again lose all but their first occurrence.

Sentences end at ``.``, ``!``, ``?`` or a newline, with the white space after it. They are compared in lower case
with single spaces; sentences without a letter or digit take no part. A run is any consecutive sentences, at least
``sentences`` of them with ``words`` words. Hashed are the shortest run from every sentence on and the shortest run up
to every sentence: inside a longer repeated run the first ones reach from its start to the start of the shortest run
up to its end, which covers the rest, so that all runs are covered without hashing every length. Runs are hashed (128
bits) and joined over the whole corpus; the first by (doc_id, version of the text, place) stays, and sentences that
any other repeated run covers go.

Edge cases: null and empty texts and texts with no full run stay as they are; a null doc_id sorts first; rows with
the same id and text are one document and treated alike, another text under the same id is a document of its own
(told apart by 64 bits of its hash); very long texts are cut whole; an empty table gives no rows;
columns beside ``doc_id`` and ``text`` are carried along. A common run is one partial count per task before the
shuffle; the join of its places with its first is left to Spark's split of skewed joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import bounded_batches, materialize, packed

_cut = re.compile(r"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+").findall
_sign = re.compile(r"[^\W_]").search
RUNS = "array<struct<place: int, upto: int, h1: long, h2: long>>"
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def sentences_of(text: str) -> list[str]:
    """The parts of a text; joined they give it back."""
    return _cut(text)


def runs_of(text: str, sentences: int, words: int) -> list[tuple[int, int, int, int]]:
    """(first sentence, last sentence, two hashes) of the shortest runs from and up to every sentence of a whole text."""
    places, hashes, sizes = [], [], []
    for i, s in enumerate(_cut(text)):
        w = s.lower().split()
        if w and (len(w) > 1 or _sign(s)):
            places.append(i)
            hashes.append(xxhash.xxh3_64_intdigest(" ".join(w)))
            sizes.append(len(w))
    n = len(places)
    if n < sentences:
        return []
    ends = np.append(0, np.cumsum(sizes))
    last = np.maximum(np.searchsorted(ends, ends[:-1] + words) - 1, np.arange(n) + sentences - 1)
    start = np.flatnonzero(last < n)
    if not len(start):
        return []
    stop = last[start]
    # up to every sentence: the latest start whose shortest run ends there or before; most are runs already
    end = np.arange(stop[0], n)
    back = start[np.searchsorted(stop, end, side="right") - 1]
    new = last[back] < end
    start, stop = np.append(start, back[new]), np.append(stop, end[new])
    h = np.array(hashes, dtype=np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for m in MIX:
            # order-aware sums: prefix sums of hashes weighted by powers, brought to the run's own start
            power = np.cumprod(np.append(np.uint64(1), np.full(n, m, np.uint64)))
            inverse = np.cumprod(np.append(np.uint64(1), np.full(n, np.uint64(pow(int(m), -1, 1 << 64)), np.uint64)))
            own = (h ^ (h >> np.uint64(31))) * m
            sums = np.append(np.uint64(0), np.cumsum(own * power[:n]))
            value = (sums[stop + 1] - sums[start]) * inverse[start]
            value = (value ^ (value >> np.uint64(29))) * m
            out.append((value ^ (value >> np.uint64(32))).view(np.int64).tolist())
    p = np.array(places)
    return list(zip(p[start].tolist(), p[stop].tolist(), *out))


def sentence_runs(docs: DataFrame, sentences: int = 2, words: int = 12) -> DataFrame:
    """(doc, ver, place, upto, h1, h2): one row per run, from its first to its last sentence."""
    bounded_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("doc", docs.schema["doc_id"].dataType), *(T.StructField(n, t) for n, t in (
        ("ver", T.LongType()), ("place", T.IntegerType()), ("upto", T.IntegerType()), ("h1", T.LongType()), ("h2", T.LongType())))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [runs_of(t, sentences, words) for t in pdf["text"]]
            sizes = [len(f) for f in found]
            flat = [r for f in found for r in f]
            if flat:
                place, upto, h1, h2 = zip(*flat)
                yield pd.DataFrame({"doc": pdf["doc_id"].repeat(sizes).to_numpy(), "ver": pdf["ver"].repeat(sizes).to_numpy(), "place": place, "upto": upto, "h1": h1, "h2": h2})

    return docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("ver"), "text").mapInPandas(run, schema)


def repeated_runs(docs: DataFrame, sentences: int = 2, words: int = 12) -> DataFrame:
    """(doc, ver, place, upto, first_doc): every run that repeats an earlier one, and where that one is."""
    runs = materialize(sentence_runs(docs, sentences, words), "sentence-runs")
    first = runs.groupBy("h1", "h2").agg(F.min(F.struct("doc", "ver", "place")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = materialize(first.select("h1", "h2", "first"), "first-runs")  # a plain shuffle on both sides can be split where it is skewed
    again = runs.join(first, ["h1", "h2"]).where(~F.struct("doc", "ver", "place").eqNullSafe(F.col("first")))
    return again.select("doc", "ver", "place", "upto", F.col("first.doc").alias("first_doc"))


def drop_repeated_runs(docs: DataFrame, sentences: int = 2, words: int = 12, only_changed: bool = False) -> DataFrame:
    """(row, removed, first_docs, kept): rows packed, places of the removed sentences, where they are kept, the rest of the text."""
    hits = repeated_runs(docs, sentences, words).groupBy("doc", "ver").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.sequence("place", "upto"))))).alias("removed"),
        F.array_sort(F.collect_set("first_doc")).alias("first_docs"),
    )

    @F.pandas_udf(T.StringType())
    def rest(texts: pd.Series, gone: pd.Series) -> pd.Series:
        out = []
        for text, places in zip(texts, gone):
            if text is None or places is None or not len(places):
                out.append(text)
                continue
            drop = set(places.tolist())
            out.append("".join(s for i, s in enumerate(_cut(text)) if i not in drop))
        return pd.Series(out, dtype=object)

    rows = packed(docs).withColumn("key", F.xxhash64("row.text"))
    joined = rows.join(hits, F.col("row.doc_id").eqNullSafe(F.col("doc")) & (F.col("key") == F.col("ver")), "inner" if only_changed else "left")
    # a covered blank sentence stands between two that go
    return joined.select("row", "removed", "first_docs", rest(F.col("row.text"), F.col("removed")).alias("kept"))
