"""Scans and sinks: resolved files, several-tables-in-one-file, result tables, models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_table(
    spark: SparkSession,
    name: str,
    roots: Sequence[str] = ("data/raw",),
    schema: T.StructType | str | None = None,
    fmt: str | None = None,
    **options: str,
) -> DataFrame:
    """Read ``name`` as given, else below the first root that holds it; CSV (with header) or parquet."""
    fmt = fmt or ("csv" if name.endswith((".csv", ".tsv", ".txt")) else "parquet")
    absolute = name.startswith("/") or "://" in name
    tried = [name] if absolute else [name, *[f"{r.rstrip('/')}/{name}" for r in roots]]
    for path in tried:
        reader = spark.read.format(fmt).options(**({"header": "true"} if fmt == "csv" else {})).options(**options)
        if schema is not None:
            reader = reader.schema(schema)
        try:
            return reader.load(path)
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"{name} not found; tried: {', '.join(tried)}")


def sentinel_to_null(df: DataFrame, sentinel: str = "?", keep: dict[str, str] | None = None) -> DataFrame:
    """Null for the missing marker in every text column; columns in ``keep`` get their own category back."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    out = df.replace(sentinel, None, subset=text) if text else df
    return out.fillna({c: v for c, v in (keep or {}).items() if c in df.columns})


def read_code_tables(spark: SparkSession, path: str, delimiter: str = ",\n", null_text: str = "NULL") -> DataFrame:
    """A code file holding several CSV tables -> (table_name, line, code, description).

    Tables are separated by a line holding only a comma. One table of the file is one record:
    code files are dictionaries, fact tables are never read this way.
    """
    blocks = spark.read.text(path, lineSep=delimiter).where(F.trim("value") != "")
    lines = blocks.select(F.filter(F.split("value", "\r?\n"), lambda s: F.trim(s) != "").alias("lines"))
    row = F.from_csv(F.col("text"), "code string, description string")
    return (
        lines.select(
            F.split(F.element_at("lines", 1), ",")[0].alias("table_name"),
            F.posexplode(F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 1, F.lit(0)))).alias("line", "text"),
        )
        .withColumn("r", row)
        .select(
            F.trim("table_name").alias("table_name"),
            "line",
            F.trim("r.code").alias("code"),
            F.nullif(F.trim("r.description"), F.lit(null_text)).alias("description"),
        )
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Write a result table (CSV gets a header row)."""
    out = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        out = out.option("header", "true")
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.save(path)
    return path


def flatten_items(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Item arrays as one sorted, duplicate-free text, ready for a CSV report."""
    return df.withColumns({c: F.concat_ws(", ", F.array_sort(F.array_distinct(c))) for c in cols})


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
