"""Composed plans: the cohort preparation chain and the flagship readmission profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean, encode, features, joins, profile
from ..sources.tables import load_table, sentinel_to_null, write_table


def preprocess(df: DataFrame, outlier_columns: Sequence[str] | None = None, categorical_columns: Sequence[str] | None = None,
               target: str | None = None, drop_ids: bool = False, strategy: str = "median",
               ids: Sequence[str] = ("encounter_id", "patient_nbr")) -> DataFrame:
    """dedup -> impute -> outlier filter -> one-hot -> drop ids."""
    out = clean.drop_duplicates(df)
    fills = {c: v for c, v in clean.fit_impute(out, strategy).items() if c != target and c not in ids}
    out = clean.apply_fill(out, fills)
    if outlier_columns:
        out = clean.iqr_filter(out, outlier_columns)
    if categorical_columns:
        out = encode.one_hot(out, categorical_columns)
    return clean.drop_columns(out, ids) if drop_ids else out


def run_preprocess(spark: SparkSession, raw: str, processed: str, roots: Sequence[str] = ("data/raw",),
                   schema: T.StructType | str | None = None, reader: dict[str, str] | None = None, **options) -> DataFrame:
    """Read a raw table, run ``preprocess`` with ``options`` and write the result; returns the written table.

    A CSV has no types of its own: give its ``schema``, or ask for a pass that finds them with ``reader={"inferSchema": "true"}``.
    Without either all its columns are text and are filled as such.
    """
    write_table(preprocess(load_table(spark, raw, roots, schema, **(reader or {})), **options), processed)
    return load_table(spark, processed, fmt="parquet")


def prepare_encounters(raw: DataFrame) -> DataFrame:
    """Sentinel and constant fills, terminal filter, first event per patient, target, engineered columns.

    The order is fixed: a filter moved across the first-event step would change its result.
    """
    out = sentinel_to_null(raw, "?", {"max_glu_serum": "None", "A1Cresult": "None"})
    out = clean.fill_constant(out, {c: "NA" for c in ("race", "payer_code", "medical_specialty", "diag_1", "diag_2", "diag_3")})
    out = clean.filter_terminal(out)
    out = clean.first_event_per_entity(out)
    out = clean.binary_target(out)
    return features.add_clinical_features(out)


def readmission_profile(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """First order per customer, decoded to nation and segment, with the urgent rate of each segment."""
    rows = orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")))
    rows = clean.filter_terminal(rows, "o_orderstatus", ["P"])
    first = clean.first_event_per_entity(rows, "o_custkey", "o_orderkey")
    first = clean.binary_target(first, "o_orderpriority", "1-URGENT", "urgent")
    who = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    dim = joins.build_lookup(nation, "n_nationkey", "n_name")
    rows = joins.decode_codes(
        first.join(who, first["o_custkey"] == who["c_custkey"]), {"c_nationkey": (dim, "nation")}
    )
    rates = profile.named_group_agg(
        rows.withColumn("group", F.concat_ws(" / ", "nation", "c_mktsegment")), "group", "urgent", ["o_totalprice"], 6
    )
    return rates.orderBy(F.desc("target_rate"), F.desc("n"), "group")
