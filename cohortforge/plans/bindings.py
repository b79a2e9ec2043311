"""The engine's roles (encounters, scored rows, transactions, vectors) bound to the given tables.

Each binding is one SELECT that both Spark and the oracle can run, so that the query and its check
start from the same whole table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"\{(\w+)\}")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def view(spark: SparkSession, d: str, text: str) -> DataFrame:
    """Run a binding; ``{orders}`` and the like are the given tables."""
    return spark.sql(text, **{n: table(spark, d, n) for n in set(_NAME.findall(text))})


def plain(text: str) -> str:
    """The same binding for the oracle, where tables are views."""
    return _NAME.sub(r"\1", text)


def _pick(expr: str, *values: str, other: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {expr} {whens} ELSE {other} END"


def _dose(mult: int) -> str:
    return _pick(f"(o_orderkey * {mult}) % 7", "'Steady'", "'Up'", "'Down'", other="'No'")


def _diag(mult: int) -> str:
    number = f"CAST((o_orderkey * {mult}) % 1000 AS STRING)"
    return (
        f"CASE WHEN (o_orderkey * {mult}) % 29 = 0 THEN 'V57' WHEN (o_orderkey * {mult}) % 31 = 0 THEN 'E909' "
        f"WHEN (o_orderkey * {mult}) % 37 = 0 THEN '?' WHEN (o_orderkey * {mult}) % 41 = 0 THEN 'abc' "
        f"WHEN (o_orderkey * {mult}) % 7 = 0 THEN '250.' || lpad(CAST(o_orderkey % 100 AS STRING), 2, '0') "
        f"WHEN (o_orderkey * {mult}) % 5 = 0 THEN {number} || '.5' ELSE {number} END"
    )


ENCOUNTERS = f"""
SELECT o_orderkey AS encounter_id, o_custkey AS patient_nbr,
  {_pick('o_custkey % 6', "'?'", "'Asian'", "'Caucasian'", "'Hispanic'", "'Other'", other="'AfricanAmerican'")} AS race,
  CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CASE WHEN o_custkey % 97 = 0 THEN 'unknown' ELSE
    '[' || CAST(o_custkey % 10 * 10 AS STRING) || '-' || CAST(o_custkey % 10 * 10 + 10 AS STRING) || ')' END AS age,
  CASE WHEN o_orderkey % 3 > 0 THEN '?' ELSE
    '[' || CAST(o_orderkey % 7 * 25 AS STRING) || '-' || CAST(o_orderkey % 7 * 25 + 25 AS STRING) || ')' END AS weight,
  o_orderkey % 8 + 1 AS admission_type_id,
  CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE '' END || CAST((o_orderkey * 7) % 30 + 1 AS STRING)
    || CASE WHEN o_orderkey % 4 = 0 THEN '.0' ELSE '' END AS discharge_disposition_id,
  (o_orderkey * 3) % 25 + 1 AS admission_source_id,
  o_orderkey % 15 AS time_in_hospital,
  (o_orderkey * 31) % 132 + 1 AS num_lab_procedures,
  (o_orderkey * 5) % 7 AS num_procedures,
  (o_orderkey * 11) % 81 + 1 AS num_medications,
  CASE WHEN o_orderkey % 6 = 0 THEN o_orderkey % 43 ELSE 0 END AS number_outpatient,
  CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey % 77 ELSE 0 END AS number_emergency,
  CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 22 ELSE 0 END AS number_inpatient,
  {_diag(13)} AS diag_1, {_diag(17)} AS diag_2, {_diag(19)} AS diag_3,
  (o_orderkey * 3) % 16 + 1 AS number_diagnoses,
  {_pick('o_orderkey % 9', "'>200'", "'>300'", "'Norm'", other='NULL')} AS max_glu_serum,
  {_pick('o_orderkey % 8', "'>7'", "'>8'", "'Norm'", other='NULL')} AS A1Cresult,
  {_dose(1)} AS metformin, {_dose(2)} AS glipizide, {_dose(3)} AS insulin, {_dose(4)} AS examide,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Ch' ELSE 'No' END AS change,
  CASE o_orderpriority WHEN '1-URGENT' THEN '<30' WHEN '2-HIGH' THEN '>30' ELSE 'NO' END AS readmitted,
  o_totalprice AS total_charge
FROM {{orders}}"""

_SCORE = "(CAST(ROUND(l_discount * 100) AS INT) * 5 + CAST(l_quantity AS INT))"
# (order, line number) is not unique in the tables; with part, supplier and price it is.
_LINE_ID = """CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)
    || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS STRING)"""
SCORED = f"""
SELECT {_LINE_ID} AS id,
  'm' || CAST(l_linenumber % 3 AS STRING) AS model,
  CAST(l_suppkey % 10 AS INT) AS fold,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y_true,
  CASE WHEN {_SCORE} >= 50 THEN 1 ELSE 0 END AS y_pred,
  {_SCORE} / 100e0 AS y_prob
FROM {{lineitem}}"""

_QTY = "CAST(CAST(l_quantity AS INT) % 5 AS STRING)"
TRANSACTIONS = f"""
SELECT l_returnflag AS flag, l_linestatus AS status,
  CASE WHEN l_discount < 0.035 THEN 'low' WHEN l_discount < 0.075 THEN 'mid' ELSE 'high' END AS disc,
  CASE WHEN l_returnflag = 'R' AND CAST(l_quantity AS INT) % 5 < 2 THEN '0' ELSE {_QTY} END AS qty,
  CASE WHEN l_linestatus = 'O' AND l_returnflag <> 'N' THEN 'yes' ELSE 'no' END AS target,
  CAST(l_linenumber % 3 AS INT) AS segment
FROM {{lineitem}}"""

VECTORS = "SELECT vec_id AS id, label, CAST(embedding AS {array}) AS vector FROM {embeddings}"

# Numeric risk table: one row per order line, used by the closed-form learners and scorers.
LINES = f"""
SELECT {_LINE_ID} AS id,
  l_quantity AS qty, l_discount AS disc, l_tax AS tax, l_extendedprice AS price,
  CASE WHEN l_extendedprice > 40000 AND l_quantity > 20 THEN 1 ELSE 0 END AS label
FROM {{lineitem}}"""

PARTS = """
SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price,
  CAST(CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN 1 ELSE 0 END AS DOUBLE) AS cheap_type,
  CAST(length(p_name) AS DOUBLE) AS name_length,
  CASE WHEN p_size > 38 OR (p_type = 'PROMO' AND p_size > 20) THEN 1 ELSE 0 END AS label
FROM {part}"""

DOCS = """
SELECT d.doc_id AS id, d.lang, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars,
  CAST(length(d.text) - length(replace(d.text, ' ', '')) AS DOUBLE) AS n_spaces,
  CAST(length(d.text) - length(replace(d.text, '.', '')) AS DOUBLE) AS n_stops,
  l.quality, l.toxic
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id"""
