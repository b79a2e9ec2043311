"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "cohortforge", cpus: int | str = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a fresh temporary folder; on a cluster a missing
    setting is an error, because a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if path:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(path)
        return path
    active = sc.getCheckpointDir()
    if active is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cohortforge-"))
        active = sc.getCheckpointDir()
    return active


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for a written table or a saved model."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


#: Rows in one partition of a fit at most: a forest keeps a weight per row and tree, and every pass reads a partition whole.
FIT_ROWS = 50_000


def spread(df: DataFrame, n_rows: int, most: int = FIT_ROWS) -> DataFrame:
    """The rows in partitions of at most about ``most``; tables that have as many partitions already stay as they are.

    A small file can hold millions of rows: what a library keeps per partition would grow with them, and few cores work.
    """
    parts = -(-n_rows // most)
    return df.repartition(parts) if parts > max(1, df.rdd.getNumPartitions()) else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: rows read many times (folds, sweeps) are computed once and outlive executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
