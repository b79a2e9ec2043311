"""Helpers shared by the operators: tables, scratch tables, bounded Arrow batches, row packing."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, shared_dir

BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: computed once, outlives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, once everything made from them is written itself."""
    for df in tables:
        spark = df.sparkSession
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            if folder.rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/") == shared_dir(spark).split(":", 1)[-1].strip("/"):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches end at a number of bytes, so that many long texts never meet in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Return freed memory of this Python process to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that gives memory back to the system once its task has ended: workers are used again by later stages."""

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return wrapped


class Shared:
    """A broadcast value that workers can read without having this package installed."""

    def __init__(self, spark: SparkSession, value: object):
        self.data = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if "read" not in self.__dict__:
            self.read = pickle.loads(self.data.value)
        return self.read

    def __getstate__(self) -> dict:
        return {"data": self.data}


def packed(df: DataFrame) -> DataFrame:
    """All columns as one struct ``row``: working columns beside it can't clash with theirs."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4: remainder 2 is held out of every fit."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4, F.lit(0))


def smallest_hashes(df: DataFrame, key: str, ids: list[str], most: int) -> DataFrame:
    """The rows of each key with the smallest hashes of ``ids``, at most ``most`` of them.

    Counts come first; then only rows whose hash is below twice the share that is wanted go into the ranking, so what a
    task ranks is about as small as the result however many rows a key has.
    """
    hashed = df.withColumn("__hash", F.xxhash64(*ids))
    sizes = hashed.groupBy(F.col(key).alias("__key")).agg((F.lit(2.0 * most) / F.count("*")).alias("__share"))
    low = hashed.join(sizes, F.col(key) == F.col("__key")).where(F.col("__hash") / 2.0**64 + 0.5 < F.col("__share"))
    place = F.row_number().over(Window.partitionBy(key).orderBy("__hash", *ids))
    return low.withColumn("__place", place).where(F.col("__place") <= most).drop("__hash", "__key", "__share", "__place")


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of neighbouring items of at most ``limit`` in all (one item at least)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
