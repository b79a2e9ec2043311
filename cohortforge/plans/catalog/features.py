"""Derived columns, transforms, scaling, encoding, splits and folds."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ...functions import codes
from ...functions.exprs import round_all
from ...operators import clean, encode, features, folds
from ..bindings import table, view
from ..cohort import prepare_encounters
from ..registry import query
from .clean import _NORM, ENC, GAPS, enc
from .profile import TRX, plain, trx

_X = "TRY_CAST(trim({c}) AS DOUBLE)"


def icd_sql(c):
    x = _X.format(c=c)
    ranges = [
        ("Diabetes", f"trunc({x}) = 250"),
        ("Circulatory", f"{x} BETWEEN 390 AND 459 OR trunc({x}) = 785"),
        ("Respiratory", f"{x} BETWEEN 460 AND 519 OR trunc({x}) = 786"),
        ("Digestive", f"{x} BETWEEN 520 AND 579 OR trunc({x}) = 787"),
        ("Injury", f"{x} BETWEEN 800 AND 999"),
        ("Musculoskeletal", f"{x} BETWEEN 710 AND 739"),
        ("Genitourinary", f"{x} BETWEEN 580 AND 629 OR trunc({x}) = 788"),
        ("Neoplasms", f"{x} BETWEEN 140 AND 239"),
    ]
    return "CASE " + " ".join(f"WHEN {cond} THEN '{label}'" for label, cond in ranges) + " ELSE 'Other' END"


@query("icd9_group", ENC + f"SELECT encounter_id, diag_1, {icd_sql('diag_1')} AS diag_1_group, {icd_sql('diag_2')} AS diag_2_group FROM enc")
def q_icd(spark, d):
    return enc(spark, d).select(
        "encounter_id", "diag_1", codes.icd9_group(F.col("diag_1")).alias("diag_1_group"), codes.icd9_group(F.col("diag_2")).alias("diag_2_group")
    )


_AGE = "CASE WHEN age LIKE '[%' THEN CAST(regexp_extract(age, '[0-9]+') AS INT) // 10 + 1 ELSE 0 END"


@query("age_ordinal", ENC + f"SELECT encounter_id, {_AGE} AS age_ordinal FROM enc")
def q_age(spark, d):
    return enc(spark, d).select("encounter_id", codes.age_ordinal(F.col("age")).alias("age_ordinal"))


@query("total_prior_visits", ENC + "SELECT encounter_id, number_outpatient + number_emergency + number_inpatient AS total_prior_visits FROM enc")
def q_prior(spark, d):
    return enc(spark, d).select("encounter_id", features.total_prior_visits().alias("total_prior_visits"))


_RATE = "ROUND(coalesce({c} / nullif(time_in_hospital, 0), 0), 6)"


@query("rate_per_day", ENC + f"SELECT encounter_id, {_RATE.format(c='num_lab_procedures')} AS labs_per_day, {_RATE.format(c='num_medications')} AS meds_per_day FROM enc")
def q_rate(spark, d):
    return round_all(
        enc(spark, d).select(
            "encounter_id",
            features.rate_per_day("num_lab_procedures", "time_in_hospital").alias("labs_per_day"),
            features.rate_per_day("num_medications", "time_in_hospital").alias("meds_per_day"),
        )
    )


_MEDS = ("metformin", "glipizide", "insulin", "examide")
_ACTIVE = " + ".join(f"CASE WHEN {m} <> 'No' THEN 1 ELSE 0 END" for m in _MEDS)
_CHANGES = " + ".join(f"CASE WHEN {m} IN ('Up', 'Down') THEN 1 ELSE 0 END" for m in _MEDS)


@query("row_count_where", ENC + f"SELECT encounter_id, {_ACTIVE} AS num_active_meds FROM enc")
def q_active(spark, d):
    return enc(spark, d).select("encounter_id", features.row_count_where_not(_MEDS).alias("num_active_meds"))


@query("row_count_in", ENC + f"SELECT encounter_id, {_CHANGES} AS total_drug_changes FROM enc")
def q_changes(spark, d):
    return enc(spark, d).select("encounter_id", features.row_count_in(_MEDS, ("Up", "Down")).alias("total_drug_changes"))


def _flag(cond):
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


_FLAGS = {
    "any_diabetes_med_change": "change = 'Ch'",
    "insulin_changed": "insulin IN ('Up', 'Down')",
    "a1c_abnormal": "A1Cresult IN ('>7', '>8')",
    "glu_abnormal": "max_glu_serum IN ('>200', '>300')",
    "both_abnormal": "A1Cresult IN ('>7', '>8') AND max_glu_serum IN ('>200', '>300')",
}
_FLAG_SQL = ", ".join(f"{_flag(v)} AS {k}" for k, v in _FLAGS.items())


@query("flags", ENC + f"SELECT encounter_id, {_FLAG_SQL} FROM enc")
def q_flags(spark, d):
    return features.add_clinical_features(enc(spark, d)).select("encounter_id", *_FLAGS)


def group_sql(c, groups):
    text = f"trim(CAST({c} AS VARCHAR))"
    return "CASE " + " ".join(f"WHEN {text} IN ({', '.join(repr(x) for x in v)}) THEN '{k}'" for k, v in groups.items()) + " ELSE 'other' END"


_GROUPS = {
    "admission_type_group": ("admission_type_id", codes.ADMISSION_GROUPS),
    "discharge_group": ("discharge_disposition_id", codes.DISCHARGE_GROUPS),
    "admission_source_group": ("admission_source_id", codes.SOURCE_GROUPS),
}


@query("code_group_map", ENC + "SELECT encounter_id, " + ", ".join(f"{group_sql(c, g)} AS {n}" for n, (c, g) in _GROUPS.items()) + " FROM enc")
def q_groups(spark, d):
    return enc(spark, d).select("encounter_id", *[codes.code_group(F.col(c), g).alias(n) for n, (c, g) in _GROUPS.items()])


@query(
    "row_distinct_count",
    ENC + f"""SELECT encounter_id, CAST(len(list_distinct(list_filter([{icd_sql('diag_1')}, {icd_sql('diag_2')}, {icd_sql('diag_3')}], lambda x: x <> 'Other'))) AS INT)
    AS comorbidity_count FROM enc""",
)
def q_distinct(spark, d):
    return features.add_clinical_features(enc(spark, d)).select("encounter_id", "comorbidity_count")


@query(
    "prepared_encounters",
    ENC + f""", t AS (SELECT * FROM enc WHERE trim(discharge_disposition_id) NOT IN ('11','13','14','19','20','21')),
    f AS (SELECT *, row_number() OVER (PARTITION BY patient_nbr ORDER BY encounter_id) rn FROM t)
    SELECT encounter_id, CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS readmitted_binary, {_AGE} AS age_ordinal, {_FLAG_SQL},
    {_ACTIVE} AS num_active_meds, {group_sql('discharge_disposition_id', codes.DISCHARGE_GROUPS)} AS discharge_group, {icd_sql('diag_1')} AS diag_1_group
    FROM f WHERE rn = 1""",
)
def q_prepared(spark, d):
    return prepare_encounters(enc(spark, d)).select(
        "encounter_id", "readmitted_binary", "age_ordinal", *_FLAGS, "num_active_meds", "discharge_group", "diag_1_group"
    )


@query("interaction_term", "SELECT p_partkey, p_size * p_retailprice AS p_size_x_p_retailprice FROM part")
def q_inter(spark, d):
    return features.interaction_term(table(spark, d, "part"), "p_size", "p_retailprice").select("p_partkey", "p_size_x_p_retailprice")


@query("log_transform", "SELECT event_id, ROUND(ln(value + 1), 6) AS log_value FROM events")
def q_log(spark, d):
    return round_all(features.log_transform(table(spark, d, "events"), ["value"]).select("event_id", "log_value"))


@query(
    "quantile_bin",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, .25) a, quantile_cont(l_extendedprice, .5) b, quantile_cont(l_extendedprice, .75) c FROM lineitem)
    SELECT l_extendedprice, CAST((CASE WHEN l_extendedprice > a THEN 1 ELSE 0 END) + (CASE WHEN l_extendedprice > b THEN 1 ELSE 0 END)
    + (CASE WHEN l_extendedprice > c THEN 1 ELSE 0 END) AS INT) AS l_extendedprice_bin FROM lineitem, q""",
)
def q_bin(spark, d):
    return features.quantile_bin(table(spark, d, "lineitem"), "l_extendedprice", 4).select("l_extendedprice", "l_extendedprice_bin")


@query(
    "quantile_bin_labels",
    """WITH q AS (SELECT quantile_cont(p_size, 1/3e0) a, quantile_cont(p_size, 2/3e0) b FROM part)
    SELECT p_partkey, CASE WHEN p_size > b THEN 'high' WHEN p_size > a THEN 'mid' ELSE 'low' END AS p_size_bin FROM part, q""",
)
def q_bin_labels(spark, d):
    return features.quantile_bin(table(spark, d, "part"), "p_size", 3, ["low", "mid", "high"]).select("p_partkey", "p_size_bin")


_RULED = {
    "number_outpatient": {"gaussian_nb": "log1p", "knn": "log1p_then_standardize"},
    "num_medications": {"gaussian_nb": "none", "knn": "standardize"},
    "number_emergency": {"gaussian_nb": "optional_log1p"},
}


@query(
    "numeric_rule_transform",
    ENC + """SELECT encounter_id, CAST(number_emergency AS DOUBLE) AS number_emergency,
    ROUND((num_medications - (SELECT AVG(num_medications) FROM enc)) / (SELECT stddev_pop(num_medications) FROM enc), 6) AS num_medications,
    ROUND((ln(1 + number_outpatient) - (SELECT AVG(ln(1 + number_outpatient)) FROM enc)) / (SELECT stddev_pop(ln(1 + number_outpatient)) FROM enc), 6) AS number_outpatient
    FROM enc""",
)
def q_rules(spark, d):
    e = enc(spark, d)
    out = features.apply_rules(e, features.fit_rules(e, "knn", _RULED))
    return round_all(out.select("encounter_id", F.col("number_emergency").cast("double").alias("number_emergency"), "num_medications", "number_outpatient"))


@query(
    "numeric_rule_optional_log",
    ENC + """SELECT encounter_id, ROUND(CASE WHEN (SELECT abs(skewness(number_emergency)) FROM enc) > 1 THEN ln(1 + number_emergency) ELSE number_emergency END, 6) AS number_emergency,
    num_medications, ROUND(ln(1 + number_outpatient), 6) AS number_outpatient FROM enc""",
)
def q_rules_nb(spark, d):
    e = enc(spark, d)
    out = features.apply_rules(e, features.fit_rules(e, "gaussian_nb", _RULED))
    return round_all(out.select("encounter_id", F.col("number_emergency").cast("double").alias("number_emergency"), "num_medications", "number_outpatient"))


@query(
    "scale_features",
    """WITH m AS (SELECT AVG(p_size) a, stddev_pop(p_size) s, AVG(p_retailprice) b, stddev_pop(p_retailprice) t FROM part)
    SELECT p_partkey, ROUND((p_size - a) / s, 6) AS p_size, ROUND((p_retailprice - b) / t, 6) AS p_retailprice FROM part, m""",
)
def q_scale(spark, d):
    return round_all(features.scale_features(table(spark, d, "part"), ["p_size", "p_retailprice"]).select("p_partkey", "p_size", "p_retailprice"))


@query(
    "scale_features_minmax",
    """WITH m AS (SELECT MIN(p_size) a, MAX(p_size) - MIN(p_size) s FROM part) SELECT p_partkey, ROUND((p_size - a) / s, 6) AS p_size, 0e0 AS constant FROM part, m""",
)
def q_minmax(spark, d):
    rows = table(spark, d, "part").withColumn("constant", F.lit(5))
    return round_all(features.scale_features(rows, ["p_size", "constant"], "minmax").select("p_partkey", "p_size", "constant"))


@query("id_normalise", ENC + f"SELECT encounter_id, {_NORM.format(c='discharge_disposition_id')} AS code, {_NORM.format(c='diag_1')} AS diag_code FROM enc")
def q_norm(spark, d):
    return enc(spark, d).select("encounter_id", codes.normalise_code(F.col("discharge_disposition_id")).alias("code"), codes.normalise_code(F.col("diag_1")).alias("diag_code"))


@query("sigmoid", "SELECT event_id, ROUND(1 / (1 + exp(-(value - 50) / 25)), 6) AS p FROM events")
def q_sigmoid(spark, d):
    return round_all(table(spark, d, "events").select("event_id", features.sigmoid((F.col("value") - 50) / 25).alias("p")))


@query("threshold_predict", "SELECT event_id, CASE WHEN value / 500 >= 0.1 THEN 1 ELSE 0 END AS y_pred FROM events")
def q_threshold(spark, d):
    return table(spark, d, "events").select("event_id", features.threshold_predict(F.col("value") / 500, 0.1).alias("y_pred"))


_DISC = ("high", "low", "mid")
_FLAG3 = ("A", "N", "R")


@query(
    "one_hot",
    TRX + "SELECT segment, " + ", ".join(f"CASE WHEN disc = '{v}' THEN 1 ELSE 0 END AS disc_{v}" for v in _DISC[1:]) + ", "
    + ", ".join(f"CASE WHEN flag = '{v}' THEN 1 ELSE 0 END AS flag_{v}" for v in _FLAG3[1:]) + " FROM trx",
)
def q_onehot(spark, d):
    return encode.one_hot(trx(spark, d).select("segment", "disc", "flag"), ["disc", "flag"])


@query(
    "one_hot_auto",
    f"WITH g AS ({plain(GAPS)}) SELECT p_size, p_retailprice, " + ", ".join(f"CASE WHEN p_type = '{v}' THEN 1 ELSE 0 END AS p_type_{v}" for v in ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")) + " FROM g",
)
def q_onehot_auto(spark, d):
    out = encode.one_hot_auto(view(spark, d, GAPS), "p_size", ["p_partkey"], drop_first=False, drop_ids=True)
    return out


@query(
    "one_hot_sparse",
    "SELECT p_brand, CAST(24 AS INT) AS width, CASE WHEN p_brand = (SELECT MIN(p_brand) FROM part) THEN 0 ELSE 1 END AS n_set, COUNT(*) AS n FROM part GROUP BY 1, 2, 3",
)
def q_onehot_sparse(spark, d):
    part = table(spark, d, "part")
    out = Pipeline(stages=encode.one_hot_stages(["p_brand"])).fit(part).transform(part)
    v = vector_to_array("p_brand__v")
    return out.groupBy("p_brand", F.size(v).alias("width"), F.aggregate(v, F.lit(0.0), lambda a, x: a + x).cast("int").alias("n_set")).agg(
        F.count(F.lit(1)).alias("n")
    )


_ITEM = ", ".join(f"CASE WHEN {c} IS NOT NULL AND NOT ({c} = 'No' AND '{c}' = 'examide') THEN '{c}=' || {c} END" for c in ("race", "metformin", "examide", "A1Cresult"))


@query("one_hot_items", ENC + f"SELECT encounter_id, array_to_string(list_filter([{_ITEM}], lambda x: x IS NOT NULL), ',') AS items FROM enc")
def q_items(spark, d):
    out = encode.one_hot_items(enc(spark, d), ["race", "metformin", "examide", "A1Cresult"], ["examide=No"])
    return out.select("encounter_id", F.concat_ws(",", "items").alias("items"))


@query("label_encode", "SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INT) AS p_type, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INT) AS p_brand FROM part")
def q_label(spark, d):
    return encode.label_encode(table(spark, d, "part"), ["p_type", "p_brand"]).select("p_partkey", "p_type", "p_brand")


@query("assemble_vector", "SELECT p_partkey, CAST(2 AS INT) AS width, p_size + p_retailprice AS total FROM part")
def q_assemble(spark, d):
    out = encode.assemble_vector(table(spark, d, "part"), ["p_size", "p_retailprice"])
    v = vector_to_array("features")
    return out.select("p_partkey", F.size(v).alias("width"), (v[0] + v[1]).alias("total"))


def _rank(part, ids, seed=42):
    by = f"PARTITION BY {part} " if part else ""
    return f"row_number() OVER ({by}ORDER BY md5('{seed}|' || {ids}))"


_OID = "CAST(o_orderkey AS VARCHAR)"


@query(
    "stratified_split",
    f"""WITH r AS (SELECT o_orderkey, o_orderpriority, {_rank('o_orderpriority', _OID)} r, COUNT(*) OVER (PARTITION BY o_orderpriority) n FROM orders)
    SELECT o_orderkey, o_orderpriority, CASE WHEN r <= round(0.2 * n) THEN 1 ELSE 0 END AS is_test FROM r""",
)
def q_split(spark, d):
    return folds.stratified_split(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["o_orderkey"])


@query(
    "plain_split",
    f"""WITH r AS (SELECT event_id, {_rank('', 'CAST(event_id AS VARCHAR)')} AS r, COUNT(*) OVER () AS n FROM events)
    SELECT event_id, CASE WHEN r <= ceil(0.2 * n) THEN 1 ELSE 0 END AS is_test FROM r""",
)
def q_plain_split(spark, d):
    return folds.plain_split(table(spark, d, "events").select("event_id"), ["event_id"])


@query("stratified_kfold", f"SELECT o_orderkey, o_orderpriority, CAST(({_rank('o_orderpriority', _OID)} - 1) % 10 AS INT) AS fold FROM orders")
def q_kfold(spark, d):
    return folds.stratified_kfold(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["o_orderkey"])


@query(
    "stratified_group_kfold",
    f"""WITH g AS (SELECT o_custkey, SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) p FROM orders GROUP BY 1),
    r AS (SELECT o_custkey, row_number() OVER (ORDER BY p DESC, md5('42|' || CAST(o_custkey AS VARCHAR))) - 1 AS i FROM g)
    SELECT o_orderkey, o.o_custkey, CAST(CASE WHEN (i // 5) % 2 = 0 THEN i % 5 ELSE 4 - i % 5 END AS INT) AS fold FROM orders o JOIN r ON r.o_custkey = o.o_custkey""",
)
def q_group_kfold(spark, d):
    rows = clean.binary_target(table(spark, d, "orders"), "o_orderpriority", "1-URGENT", "y").select("o_orderkey", "o_custkey", "y")
    return folds.stratified_group_kfold(rows, "y", "o_custkey", 5).drop("y")


@query("plain_kfold", f"SELECT event_id, CAST(({_rank('', 'CAST(event_id AS VARCHAR)')} - 1) % 7 AS INT) AS fold FROM events")
def q_plain(spark, d):
    return folds.plain_kfold(table(spark, d, "events").select("event_id"), ["event_id"], 7)


@query(
    "target_type",
    "SELECT 'toxic' AS target, 'binary' AS kind, COUNT(DISTINCT toxic) AS n FROM labels UNION ALL SELECT 'label', 'multiclass', COUNT(DISTINCT label) FROM embeddings UNION ALL SELECT 'value', 'continuous', COUNT(DISTINCT value) FROM events",
)
def q_type(spark, d):
    out = None
    for t, c in (("labels", "toxic"), ("embeddings", "label"), ("events", "value")):
        rows = table(spark, d, t)
        n = rows.agg(F.count_distinct(c).alias("n"))
        part = folds.target_type(rows, c).withColumn("n", n.scalar())
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "nested_folds",
    """WITH c AS (SELECT unnest(range(4)) AS o) SELECT CAST(o AS INT) AS left_out, COUNT(*) FILTER (TRUE) AS n_rows, COUNT(*) FILTER (outer_fold <> o) AS n_train, CAST(3 AS BIGINT) AS n_inner
    FROM (SELECT (row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR))) - 1) % 4 AS outer_fold FROM orders) f, c GROUP BY o""",
)
def q_nested(spark, d):
    rows = folds.nested_folds(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["o_orderkey"], 4, 3)
    long = rows.select(F.posexplode("inner_fold").alias("left_out", "inner"))
    return long.groupBy("left_out").agg(F.count(F.lit(1)).alias("n_rows"), F.count("inner").alias("n_train"), F.count_distinct("inner").alias("n_inner"))


@query(
    "nested_group_folds",
    """WITH g AS (SELECT o_custkey, COUNT(*) AS n, SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS p FROM orders GROUP BY 1),
    r AS (SELECT *, row_number() OVER (ORDER BY p DESC, md5('42|' || CAST(o_custkey AS VARCHAR))) - 1 AS i FROM g),
    f AS (SELECT *, CASE WHEN (i // 4) % 2 = 0 THEN i % 4 ELSE 3 - i % 4 END AS fold FROM r),
    c AS (SELECT unnest(range(4)) AS o)
    SELECT CAST(o AS INT) AS left_out, CAST(SUM(n) AS BIGINT) AS n_rows, CAST(SUM(CASE WHEN fold <> o THEN n ELSE 0 END) AS BIGINT) AS n_train,
      CAST(3 AS BIGINT) AS n_inner, CAST(0 AS BIGINT) AS n_split FROM f, c GROUP BY o""",
)
def q_nested_group(spark, d):
    """Rows of nested folds by customer; n_split counts customers in more than one inner fold."""
    rows = clean.binary_target(table(spark, d, "orders"), "o_orderpriority", "1-URGENT", "y").select("o_orderkey", "o_custkey", "y")
    long = folds.nested_folds(rows, "y", ["o_orderkey"], 4, 3, group="o_custkey").select("o_custkey", F.posexplode("inner_fold").alias("left_out", "inner"))
    each = long.groupBy("left_out", "o_custkey").agg(F.count("*").alias("n"), F.count("inner").alias("t"), F.min("inner").alias("low"), F.max("inner").alias("high"))
    return each.groupBy("left_out").agg(
        F.sum("n").alias("n_rows"), F.sum("t").alias("n_train"), F.count_distinct("low").alias("n_inner"), F.sum((F.col("low") != F.col("high")).cast("long")).alias("n_split")
    ).fillna(0, ["n_split"])
