"""Scans, sinks, filters, imputation, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import clean, joins, learners, ordered, profile
from ...session import scratch_path
from ...sources import tables as src
from ..bindings import ENCOUNTERS, PARTS, plain, table, view
from ..cohort import preprocess, readmission_profile, run_preprocess
from ..registry import query

ENC = f"WITH enc AS ({plain(ENCOUNTERS)}) "


def enc(spark, d):
    return view(spark, d, ENCOUNTERS)


@query(
    "readmission_profile",
    """
    WITH f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) rn FROM orders WHERE o_orderstatus <> 'P'),
    j AS (SELECT n_name || ' / ' || c_mktsegment AS g, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END urgent, o_totalprice
          FROM f JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey WHERE rn = 1)
    SELECT g AS "group", COUNT(*) AS n, ROUND(AVG(urgent), 6) AS target_rate, ROUND(AVG(o_totalprice), 6) AS o_totalprice_mean
    FROM j GROUP BY g ORDER BY target_rate DESC, n DESC, g""",
)
def q_readmission(spark, d):
    return readmission_profile(table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "nation"))


@query("scan_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_scan(spark, d):
    return src.load_table(spark, "customer.parquet", [d])


@query(
    "sentinel_to_null",
    ENC + """SELECT encounter_id, nullif(race, '?') AS race, nullif(weight, '?') AS weight,
    coalesce(max_glu_serum, 'None') AS max_glu_serum, coalesce(A1Cresult, 'None') AS "A1Cresult" FROM enc""",
)
def q_sentinel(spark, d):
    out = src.sentinel_to_null(enc(spark, d), "?", {"max_glu_serum": "None", "A1Cresult": "None"})
    return out.select("encounter_id", "race", "weight", "max_glu_serum", "A1Cresult")


def code_file(spark, d):
    """A code file with three tables, written by Spark from the dictionaries of the given data."""
    def block(df, name, code, desc):
        line = F.concat(F.col(code).cast("string"), F.lit(',"'), desc, F.lit('"'))
        lines = df.groupBy().agg(F.sort_array(F.collect_list(F.struct(F.col(code).alias("k"), line.alias("l")))).alias("x"))
        body = F.array_join(F.transform("x", lambda s: s["l"]), "\n")
        return lines.select(F.concat(F.lit(f"{name},description\n"), body, F.lit("\n")).alias("b"), F.lit(name).alias("name"))

    segments = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.min("c_custkey").alias("first_key"))
    blocks = (
        block(table(spark, d, "region"), "region_id", "r_regionkey", F.concat(F.lit(" "), F.col("r_name")))
        .unionByName(block(table(spark, d, "nation"), "nation_id", "n_nationkey", F.concat(F.col("n_name"), F.lit(", land"))))
        .unionByName(block(segments, "segment_id", "first_key", F.when(F.col("c_mktsegment") == "BUILDING", "NULL").otherwise(F.col("c_mktsegment"))))
    )
    path = scratch_path(spark, "codes")
    whole = blocks.groupBy().agg(F.sort_array(F.collect_list(F.struct("name", "b"))).alias("x"))
    whole.select(F.array_join(F.transform("x", lambda s: s["b"]), ",\n").alias("value")).coalesce(1).write.text(path)
    return path


@query(
    "multi_table_scan",
    """SELECT 'region_id' AS table_name, CAST(r_regionkey AS VARCHAR) AS code, r_name AS description FROM region
    UNION ALL SELECT 'nation_id', CAST(n_nationkey AS VARCHAR), n_name || ', land' FROM nation
    UNION ALL SELECT 'segment_id', CAST(MIN(c_custkey) AS VARCHAR), nullif(c_mktsegment, 'BUILDING') FROM customer GROUP BY c_mktsegment""",
)
def q_multi(spark, d):
    return src.read_code_tables(spark, code_file(spark, d)).select("table_name", "code", "description")


@query(
    "scan_processed",
    "SELECT id, size, price, label FROM (" + plain(PARTS) + ") t",
)
def q_processed(spark, d):
    path = src.write_table(view(spark, d, PARTS), scratch_path(spark, "processed"))
    _, out = clean.feature_target_split(src.load_table(spark, path).select("id", "size", "price", "label"), "label", ["id"])
    return out


@query("sink_processed", "SELECT COUNT(*) AS n_rows, COUNT(DISTINCT encounter_id) AS n_ids FROM (" + plain(ENCOUNTERS) + ") t")
def q_sink(spark, d):
    path = src.write_table(enc(spark, d), scratch_path(spark, "sink"), "csv")
    back = src.load_table(spark, path, fmt="csv")
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("encounter_id").alias("n_ids"))


@query(
    "sink_report_table",
    ENC + """SELECT encounter_id, array_to_string(list_sort(list_distinct([metformin, glipizide, insulin])), ', ') AS doses FROM enc""",
)
def q_report(spark, d):
    out = enc(spark, d).select("encounter_id", F.array("metformin", "glipizide", "insulin").alias("doses"))
    path = src.write_table(src.flatten_items(out, ["doses"]), scratch_path(spark, "report"), "csv")
    return src.load_table(spark, path, schema="encounter_id bigint, doses string", fmt="csv")


@query("model_roundtrip", "SELECT 0 AS n_changed, COUNT(*) AS n_rows FROM part")
def q_roundtrip(spark, d):
    rows = view(spark, d, PARTS)
    cols = ["size", "price", "cheap_type"]
    model = learners.train_classifier(rows, cols, "logistic_regression", class_weight="balanced")
    again = src.load_model(src.save_model(model, scratch_path(spark, "model")))
    a = model.transform(rows).select("id", F.col("prediction").alias("a"))
    b = again.transform(rows).select("id", F.col("prediction").alias("b"))
    return a.join(b, "id").agg(
        F.coalesce(F.sum((F.col("a") != F.col("b")).cast("int")), F.lit(0)).cast("int").alias("n_changed"), F.count(F.lit(1)).alias("n_rows")
    )


_TERMINAL = "('11','13','14','19','20','21')"


@query("filter_terminal", ENC + f"SELECT encounter_id, discharge_disposition_id FROM enc WHERE trim(discharge_disposition_id) NOT IN {_TERMINAL}")
def q_terminal(spark, d):
    return clean.filter_terminal(enc(spark, d)).select("encounter_id", "discharge_disposition_id")


@query("binary_target", ENC + "SELECT encounter_id, CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS readmitted_binary FROM enc")
def q_target(spark, d):
    return clean.binary_target(enc(spark, d)).select("encounter_id", "readmitted_binary")


@query("drop_columns", "SELECT o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def q_drop(spark, d):
    return clean.drop_columns(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "not_there"])


@query("feature_target_split", "SELECT id, size, price, cheap_type, name_length, label FROM (" + plain(PARTS) + ") t")
def q_split_cols(spark, d):
    return clean.feature_target_split(view(spark, d, PARTS), "label", ["id"])[1]


@query("select_by_dtype", "SELECT p_partkey, p_size, p_retailprice FROM part")
def q_dtype(spark, d):
    return clean.select_by_dtype(table(spark, d, "part"))


@query("cast_to_category", "SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size, p_type FROM part")
def q_category(spark, d):
    return clean.cast_to_category(table(spark, d, "part"), ["p_size", "p_type"]).select("p_partkey", "p_size", "p_type")


@query(
    "fill_constant",
    ENC + """SELECT encounter_id, coalesce(nullif(race, '?'), 'NA') AS race, coalesce(nullif(diag_1, '?'), 'NA') AS diag_1,
    coalesce(A1Cresult, 'None') AS "A1Cresult" FROM enc""",
)
def q_fill(spark, d):
    out = src.sentinel_to_null(enc(spark, d))
    return clean.fill_constant(out, {"race": "NA", "diag_1": "NA", "A1Cresult": "None"}).select("encounter_id", "race", "diag_1", "A1Cresult")


GAPS = "SELECT p_partkey, nullif(p_size, 7) AS p_size, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice END AS p_retailprice, nullif(p_type, 'PROMO') AS p_type FROM {part}"


def _imputed(fn):
    return f"""WITH g AS ({plain(GAPS)}) SELECT p_partkey,
    ROUND(coalesce(CAST(p_size AS DOUBLE), (SELECT {fn('p_size')} FROM g)), 6) AS p_size,
    ROUND(coalesce(p_retailprice, (SELECT {fn('p_retailprice')} FROM g)), 6) AS p_retailprice, coalesce(p_type, 'Unknown') AS p_type FROM g"""


def _impute(spark, d, strategy):
    g = view(spark, d, GAPS)
    fills = {c: v for c, v in clean.fit_impute(g, strategy).items() if c != "p_partkey"}
    out = clean.apply_fill(g, fills)
    return out.withColumns({c: F.round(c, 6) for c in ("p_size", "p_retailprice")})


@query("impute_numeric", _imputed(lambda c: f"quantile_cont({c}, 0.5)"))
def q_impute_median(spark, d):
    return _impute(spark, d, "median")


@query("impute_numeric_mean", _imputed(lambda c: f"AVG({c})"))
def q_impute_mean(spark, d):
    return _impute(spark, d, "mean")


@query(
    "impute_mode",
    f"""WITH g AS ({plain(GAPS)}), t AS (SELECT p_type FROM g WHERE p_type IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1),
    s AS (SELECT p_size FROM g WHERE p_size IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, p_size LIMIT 1)
    SELECT p_partkey, coalesce(p_size, (SELECT p_size FROM s)) AS p_size, coalesce(p_type, (SELECT p_type FROM t)) AS p_type FROM g""",
)
def q_impute_mode(spark, d):
    return clean.impute_mode(view(spark, d, GAPS), ["p_size", "p_type"]).select("p_partkey", "p_size", "p_type")


_GROUP_MODE = (
    ENC
    + """, w AS (SELECT age, weight, COUNT(*) n FROM enc WHERE weight <> '?' GROUP BY 1, 2),
    m AS (SELECT age, weight AS m, row_number() OVER (PARTITION BY age ORDER BY n DESC, weight) rn FROM w)
    SELECT encounter_id, e.age, coalesce(nullif(weight, '?'), m) AS weight FROM enc e LEFT JOIN m ON e.age = m.age AND rn = 1"""
)


@query("impute_group_mode", _GROUP_MODE)
def q_group_mode(spark, d):
    return clean.impute_group_mode(src.sentinel_to_null(enc(spark, d)), "weight", "age").select("encounter_id", "age", "weight")


_FENCES2 = """WITH q AS (SELECT quantile_cont(l_extendedprice, .25) a, quantile_cont(l_extendedprice, .75) b,
    quantile_cont(l_quantity, .25) c, quantile_cont(l_quantity, .75) e FROM lineitem) """


@query(
    "iqr_filter",
    """WITH q AS (SELECT quantile_cont(value, .25) a, quantile_cont(value, .75) b, quantile_cont(user_id, .25) c, quantile_cont(user_id, .75) e FROM events)
    SELECT event_id, user_id, value FROM events, q WHERE value BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)
    AND user_id BETWEEN c - 1.5 * (e - c) AND e + 1.5 * (e - c)""",
)
def q_iqr(spark, d):
    return clean.iqr_filter(table(spark, d, "events").select("event_id", "user_id", "value"), ["value", "user_id"])


@query(
    "iqr_outlier_report",
    _FENCES2 + """, t AS (SELECT 'l_extendedprice' AS c, SUM(CASE WHEN l_extendedprice < a - 1.5*(b-a) OR l_extendedprice > b + 1.5*(b-a) THEN 1 ELSE 0 END) n, COUNT(*) m FROM lineitem, q
    UNION ALL SELECT 'l_quantity', SUM(CASE WHEN l_quantity < c - 1.5*(e-c) OR l_quantity > e + 1.5*(e-c) THEN 1 ELSE 0 END), COUNT(*) FROM lineitem, q)
    SELECT c AS "column", CAST(n AS BIGINT) AS n_outliers, ROUND(n * 100.0 / m, 6) AS pct_outliers FROM t""",
)
def q_outliers(spark, d):
    out = clean.iqr_outlier_report(table(spark, d, "lineitem").select("l_extendedprice", "l_quantity"), ["l_extendedprice", "l_quantity"])
    return out.withColumn("pct_outliers", F.round("pct_outliers", 6))


@query("sanitize_names", 'SELECT p_partkey AS "part_key_", p_size AS "size_20-30)", p_type AS "type_x" FROM part')
def q_names(spark, d):
    raw = table(spark, d, "part").select(F.col("p_partkey").alias("part{key}"), F.col("p_size").alias("size[20-30)"), F.col("p_type").alias('type<>:"x'))
    return clean.sanitize_names(raw)


@query(
    "leakage_check",
    ENC + """SELECT 'encounter_id, patient_nbr' AS forbidden_present, 'age_ordinal' AS required_absent,
    COUNT(*) FILTER (max_glu_serum IS NULL) + COUNT(*) FILTER (A1Cresult IS NULL) AS total_missing, COUNT(*) AS n_rows, 29 AS n_columns FROM enc""",
)
def q_leak(spark, d):
    return clean.leakage_check(enc(spark, d), ["encounter_id", "patient_nbr", "readmitted_x"], ["age", "age_ordinal"])


@query(
    "row_sample",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)) LIMIT 500",
)
def q_sample(spark, d):
    return clean.row_sample(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 500)


@query("drop_duplicates", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def q_dedup(spark, d):
    return clean.drop_duplicates(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "first_event_per_entity",
    ENC + """, r AS (SELECT *, row_number() OVER (PARTITION BY patient_nbr ORDER BY encounter_id) rn FROM enc)
    SELECT patient_nbr, encounter_id, age, total_charge FROM r WHERE rn = 1""",
)
def q_first(spark, d):
    return clean.first_event_per_entity(enc(spark, d).select("patient_nbr", "encounter_id", "age", "total_charge"))


_NORM = "coalesce(CAST(CAST(trunc(TRY_CAST(trim(CAST({c} AS VARCHAR)) AS DOUBLE)) AS BIGINT) AS VARCHAR), trim(CAST({c} AS VARCHAR)))"


@query(
    "decode_codes",
    ENC + f"""SELECT encounter_id, coalesce(n1.n_name, 'Unknown') AS admission_desc, coalesce(n2.n_name, 'Unknown') AS discharge_desc,
    coalesce(r_name, 'Unknown') AS source_desc FROM enc
    LEFT JOIN nation n1 ON CAST(n1.n_nationkey AS VARCHAR) = {_NORM.format(c='admission_type_id')}
    LEFT JOIN nation n2 ON CAST(n2.n_nationkey AS VARCHAR) = {_NORM.format(c='discharge_disposition_id')}
    LEFT JOIN region ON CAST(r_regionkey AS VARCHAR) = {_NORM.format(c='admission_source_id')}""",
)
def q_decode(spark, d):
    n = joins.build_lookup(table(spark, d, "nation"), "n_nationkey", "n_name")
    r = joins.build_lookup(table(spark, d, "region"), "r_regionkey", "r_name")
    out = joins.decode_codes(
        enc(spark, d),
        {"admission_type_id": (n, "admission_desc"), "discharge_disposition_id": (n, "discharge_desc"), "admission_source_id": (r, "source_desc")},
    )
    return out.select("encounter_id", "admission_desc", "discharge_desc", "source_desc")


@query(
    "decode_from_code_file",
    """SELECT c_custkey, n_name || ', land' AS nation_desc, coalesce(nullif(s.c_mktsegment, 'BUILDING'), 'Unknown') AS segment_desc
    FROM customer c JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT MIN(c_custkey) k, c_mktsegment FROM customer GROUP BY 2) s ON s.k = c.c_custkey""",
)
def q_decode_file(spark, d):
    codes = src.read_code_tables(spark, code_file(spark, d))
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation_id"), F.col("c_custkey").alias("segment_id"))
    out = joins.decode_from_code_file(rows, codes, {"nation_id": "nation_desc", "segment_id": "segment_desc"})
    return out.select("c_custkey", "nation_desc", "segment_desc")


@query(
    "group_mode_join",
    """WITH c AS (SELECT p_brand, p_type, COUNT(*) n FROM part GROUP BY 1, 2),
    m AS (SELECT p_brand, p_type AS usual_type, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) rn FROM c)
    SELECT p_partkey, p.p_brand, usual_type FROM part p JOIN m ON p.p_brand = m.p_brand AND rn = 1""",
)
def q_mode_join(spark, d):
    part = table(spark, d, "part")
    best = ordered.modes(part, ["p_type"], by=["p_brand"])
    return joins.group_stat_join(part, best, "p_brand", "top", "usual_type").select("p_partkey", "p_brand", "usual_type")


def _stats_sql(name, expr):
    return f"SELECT '{name}' AS c, AVG({expr}) mean, stddev_samp({expr}) std, MIN({expr}) lo, MAX({expr}) hi FROM lineitem"


@query(
    "before_after_join",
    f"""WITH b AS ({_stats_sql('l_quantity', 'l_quantity')} UNION ALL {_stats_sql('l_extendedprice', 'l_extendedprice')}),
    a AS ({_stats_sql('l_quantity', 'l_quantity')} UNION ALL {_stats_sql('l_extendedprice', 'ln(1 + l_extendedprice)')})
    SELECT b.c AS "column", ROUND(b.mean, 6) AS mean_before, ROUND(b.std, 6) AS std_before, b.lo AS min_before, b.hi AS max_before,
    ROUND(a.mean, 6) AS mean_after, ROUND(a.std, 6) AS std_after, ROUND(a.lo, 6) AS min_after, ROUND(a.hi, 6) AS max_after,
    CASE b.c WHEN 'l_extendedprice' THEN 'log1p' ELSE 'none' END AS transform FROM a JOIN b ON a.c = b.c""",
)
def q_before_after(spark, d):
    li = table(spark, d, "lineitem").select("l_quantity", "l_extendedprice")
    after = li.withColumn("l_extendedprice", F.log1p("l_extendedprice"))
    cols = ["l_quantity", "l_extendedprice"]
    out = joins.before_after_join(profile.describe_subset(li, cols), profile.describe_subset(after, cols), {"l_extendedprice": "log1p"})
    return out.select("column", "transform", *[F.round(c, 6).alias(c) for c in out.columns if c not in ("column", "transform")])


@query("run_preprocess", "SELECT DISTINCT o_orderstatus, o_orderpriority, o_totalprice FROM orders")
def q_run_preprocess(spark, d):
    out = run_preprocess(spark, "orders.parquet", scratch_path(spark, "processed"), [d], drop_ids=True, ids=["o_orderkey", "o_custkey"])
    return out.select("o_orderstatus", "o_orderpriority", "o_totalprice").distinct()


@query(
    "preprocess_chain",
    f"""WITH g AS (SELECT DISTINCT * FROM ({plain(GAPS)}) x),
    f AS (SELECT p_partkey, coalesce(CAST(p_size AS DOUBLE), (SELECT quantile_cont(p_size, .5) FROM g)) s,
          coalesce(p_retailprice, (SELECT quantile_cont(p_retailprice, .5) FROM g)) r, coalesce(p_type, 'Unknown') t FROM g),
    q AS (SELECT quantile_cont(r, .25) a, quantile_cont(r, .75) b FROM f)
    SELECT s AS p_size, ROUND(r, 6) AS p_retailprice, {", ".join(f"CASE WHEN t = '{v}' THEN 1 ELSE 0 END AS p_type_{v}" for v in ("LARGE", "MEDIUM", "SMALL", "STANDARD", "Unknown"))}
    FROM f, q WHERE r BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)""",
)
def q_chain(spark, d):
    out = preprocess(view(spark, d, GAPS), ["p_retailprice"], ["p_type"], drop_ids=True, ids=["p_partkey"])
    return out.withColumn("p_retailprice", F.round("p_retailprice", 6))


