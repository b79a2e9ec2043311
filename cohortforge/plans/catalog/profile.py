"""Profiling, summary statistics and contingency tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.exprs import round_all
from ...operators import profile
from ..bindings import ENCOUNTERS, TRANSACTIONS, plain, table, view
from ..registry import query
from .clean import ENC, GAPS, enc

TRX = f"WITH trx AS ({plain(TRANSACTIONS)}) "


def trx(spark, d):
    return view(spark, d, TRANSACTIONS)


_GAP_COLS = ("p_partkey", "p_size", "p_retailprice", "p_type")


@query(
    "missing_profile",
    f"WITH g AS ({plain(GAPS)}), t AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS c, COUNT(*) - COUNT({c}) AS n, COUNT(*) AS m FROM g" for c in _GAP_COLS)
    + ') SELECT c AS "column", n AS n_missing, ROUND(n * 100.0 / m, 6) AS pct_missing FROM t WHERE n > 0',
)
def q_missing(spark, d):
    return round_all(profile.missing_profile(view(spark, d, GAPS)))


@query(
    "duplicate_count",
    "SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS n_duplicates, COUNT(*) AS n_rows FROM lineitem",
)
def q_dups(spark, d):
    return profile.duplicate_count(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"))


@query("value_counts", ENC + "SELECT age AS value, COUNT(*) AS n FROM enc GROUP BY age")
def q_counts(spark, d):
    return profile.value_counts(enc(spark, d), "age")


@query("value_counts_with_nulls", ENC + "SELECT max_glu_serum AS value, COUNT(*) AS n FROM enc GROUP BY 1")
def q_counts_null(spark, d):
    return profile.value_counts(enc(spark, d), "max_glu_serum", dropna=False)


_CARD = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")


@query("cardinality", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", COUNT(DISTINCT {c}) AS n_unique FROM lineitem" for c in _CARD))
def q_card(spark, d):
    return profile.cardinality(table(spark, d, "lineitem"), _CARD)


def _num_row(c, t):
    return f"""SELECT '{c}' AS "column", COUNT({c}) AS count, CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq,
    ROUND(AVG({c}), 6) AS mean, ROUND(stddev_samp({c}), 6) AS std, CAST(MIN({c}) AS DOUBLE) AS min, ROUND(quantile_cont({c}, .25), 6) AS p25,
    ROUND(quantile_cont({c}, .5), 6) AS p50, ROUND(quantile_cont({c}, .75), 6) AS p75, CAST(MAX({c}) AS DOUBLE) AS max FROM {t}"""


def _text_row(c, t):
    return f"""SELECT '{c}', COUNT({c}), COUNT(DISTINCT {c}), (SELECT {c} FROM {t} GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1),
    (SELECT COUNT(*) FROM {t} GROUP BY {c} ORDER BY 1 DESC LIMIT 1), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM {t}"""


@query(
    "describe_all",
    " UNION ALL ".join([_num_row(c, "orders") for c in ("o_custkey", "o_totalprice")] + [_text_row(c, "orders") for c in ("o_orderstatus", "o_orderpriority")]),
)
def q_describe(spark, d):
    return round_all(profile.describe_all(table(spark, d, "orders"), ["o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]))


@query(
    "describe_subset",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", ROUND(AVG({c}), 6) AS mean, ROUND(stddev_samp({c}), 6) AS std, CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_linenumber")
    ),
)
def q_describe_subset(spark, d):
    return round_all(profile.describe_subset(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"]))


_CUST = (("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string"))


@query(
    "schema_profile",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS dtype, COUNT({c}) AS non_null FROM customer" for i, (c, t) in enumerate(_CUST)
    ),
)
def q_schema(spark, d):
    return profile.schema_profile(table(spark, d, "customer"))


_CORR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "correlation_matrix",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, ROUND(corr({a}, {b}), 6) AS corr FROM lineitem" for a in _CORR for b in _CORR),
)
def q_corr(spark, d):
    return round_all(profile.correlation_matrix(table(spark, d, "lineitem"), _CORR))


@query(
    "histogram",
    """WITH r AS (SELECT MIN(value) lo, (MAX(value) - MIN(value)) / 30 AS w, COUNT(*) n FROM events),
    b AS (SELECT CAST(least(floor((value - lo) / w), 29) AS INT) AS bin, COUNT(*) AS n FROM events, r GROUP BY 1)
    SELECT bin, ROUND(lo + bin * w, 6) AS left_edge, b.n AS n, ROUND(b.n / (r.n * w), 6) AS density FROM b, r""",
)
def q_hist(spark, d):
    return round_all(profile.histogram(table(spark, d, "events"), "value", 30))


def _box(group):
    g = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    on = f"e.{group} = q.{group}" if group else "TRUE"
    eg = f"e.{group}, " if group else ""
    return f"""WITH q AS (SELECT {g}quantile_cont(value, .25) q1, quantile_cont(value, .5) q2, quantile_cont(value, .75) q3 FROM events {by})
    SELECT {eg}'value' AS "column", COUNT(*) AS n, MIN(value) AS min, ROUND(MIN(q1), 6) AS q1, ROUND(MIN(q2), 6) AS median, ROUND(MIN(q3), 6) AS q3, MAX(value) AS max,
    MIN(value) FILTER (value BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS whisker_low,
    MAX(value) FILTER (value BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS whisker_high,
    COUNT(*) FILTER (value NOT BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS n_outliers FROM events e JOIN q ON {on} {by.replace(group or '~', 'e.' + (group or ''))}"""


@query("boxplot_stats", _box(None))
def q_box(spark, d):
    return round_all(profile.boxplot_stats(table(spark, d, "events"), ["value"]))


@query("boxplot_stats_by_group", _box("event_type"))
def q_box_by(spark, d):
    return round_all(profile.boxplot_stats(table(spark, d, "events"), ["value"], "event_type"))


@query(
    "skewness",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", ROUND(skewness({c}), 6) AS skew, CASE WHEN abs(skewness({c})) > 1 THEN 1 ELSE 0 END AS is_skewed FROM events"
        for c in ("value", "user_id")
    ),
)
def q_skew(spark, d):
    return round_all(profile.skewness(table(spark, d, "events"), ["value", "user_id"]))


@query(
    "crosstab_margins",
    TRX + """SELECT CASE WHEN GROUPING(flag) = 1 THEN 'All' ELSE flag END AS flag_level, CASE WHEN GROUPING(disc) = 1 THEN 'All' ELSE disc END AS disc_level,
    COUNT(*) AS n FROM trx GROUP BY CUBE(flag, disc)""",
)
def q_crosstab(spark, d):
    return profile.crosstab_margins(trx(spark, d), "flag", "disc")


_CHI = """, o AS (SELECT {a} a, {b} b, COUNT(*) o FROM trx GROUP BY 1, 2), r AS (SELECT {a} a, COUNT(*) r FROM trx GROUP BY 1),
    c AS (SELECT {b} b, COUNT(*) c FROM trx GROUP BY 1), n AS (SELECT COUNT(*) n FROM trx),
    e AS (SELECT coalesce(o, 0) o, r * c * 1e0 / n AS e FROM r CROSS JOIN c CROSS JOIN n LEFT JOIN o ON o.a = r.a AND o.b = c.b)
    """


@query(
    "chi2_independence",
    TRX + _CHI.format(a="qty", b="disc") + """, s AS (SELECT SUM((o - e) * (o - e) / e) x FROM e)
    SELECT ROUND(x, 6) AS chi2, CAST(8 AS BIGINT) AS dof, n,
    ROUND(exp(-x/2) * (1 + x/2 + (x/2)*(x/2)/2 + (x/2)*(x/2)*(x/2)/6), 6) AS p_value FROM s, n""",
)
def q_chi2(spark, d):
    return round_all(profile.chi2_independence(trx(spark, d), "qty", "disc"))


@query(
    "chi2_two_by_two",
    TRX + _CHI.format(a="status", b="target")
    + "SELECT ROUND(SUM((abs(o - e) - least(.5, abs(o - e))) ** 2 / e), 4) AS chi2, CAST(1 AS BIGINT) AS dof, (SELECT n FROM n) AS n FROM e",
)
def q_chi2_2x2(spark, d):
    out = profile.chi2_independence(trx(spark, d), "status", "target")
    return out.select(F.round("chi2", 4).alias("chi2"), "dof", "n")


@query(
    "expected_counts",
    TRX + """, r AS (SELECT flag, COUNT(*) r FROM trx GROUP BY 1), c AS (SELECT disc, COUNT(*) c FROM trx GROUP BY 1)
    SELECT t.flag AS a, t.disc AS b, COUNT(*) AS observed, ROUND(MIN(r) * MIN(c) * 1e0 / (SELECT COUNT(*) FROM trx), 6) AS expected
    FROM trx t JOIN r ON r.flag = t.flag JOIN c ON c.disc = t.disc GROUP BY 1, 2""",
)
def q_expected(spark, d):
    return round_all(profile.expected_counts(trx(spark, d), "flag", "disc"))


_PROF = ("l_quantity", "l_extendedprice", "l_discount")


@query("group_mean_profile", "SELECT l_linenumber, " + ", ".join(f"ROUND(AVG({c}), 6) AS {c}" for c in _PROF) + " FROM lineitem GROUP BY 1")
def q_means(spark, d):
    return round_all(profile.group_mean_profile(table(spark, d, "lineitem"), "l_linenumber", _PROF))


@query(
    "named_group_agg",
    """SELECT age, COUNT(*) AS n, ROUND(AVG(CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END), 3) AS target_rate,
    ROUND(AVG(num_medications), 3) AS num_medications_mean FROM (""" + plain(ENCOUNTERS) + ") t GROUP BY age",
)
def q_named(spark, d):
    rows = enc(spark, d).withColumn("y", (F.col("readmitted") == "<30").cast("int"))
    return profile.named_group_agg(rows, "age", "y", ["num_medications"])


@query(
    "group_zscore",
    "WITH p AS (SELECT l_linenumber g, " + ", ".join(f"AVG({c}) AS {c}" for c in _PROF) + " FROM lineitem GROUP BY 1) SELECT g AS l_linenumber, "
    + ", ".join(f"ROUND(({c} - (SELECT AVG({c}) FROM p)) / (SELECT stddev_samp({c}) FROM p), 6) AS {c}" for c in _PROF) + " FROM p",
)
def q_zscore(spark, d):
    means = profile.group_mean_profile(table(spark, d, "lineitem"), "l_linenumber", _PROF)
    return round_all(profile.group_zscore(means, "l_linenumber", _PROF))


@query(
    "target_rate_by_group",
    TRX + """SELECT CASE WHEN GROUPING(segment) = 1 THEN 'All' ELSE CAST(segment AS VARCHAR) END AS level, COUNT(*) AS n,
    ROUND(AVG(CASE WHEN target = 'yes' THEN 1 ELSE 0 END), 6) AS target_rate FROM trx GROUP BY ROLLUP(segment)""",
)
def q_rate(spark, d):
    rows = trx(spark, d).withColumn("y", (F.col("target") == "yes").cast("int"))
    return round_all(profile.target_rate_by_group(rows, "segment", "y"))


def anova_sql(cols, label, t):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", (SELECT ROUND((SUM(n * (m - (SELECT AVG({c}) FROM {t})) ** 2) / (COUNT(*) - 1)) / (SUM(n * v) / (SUM(n) - COUNT(*))), 4)
        FROM (SELECT COUNT(*) n, AVG({c}) m, var_pop({c}) v FROM {t} GROUP BY {label})) AS f_stat"""
        for c in cols
    )


@query("anova_f", anova_sql(_PROF + ("l_tax",), "l_returnflag", "lineitem"))
def q_anova(spark, d):
    return round_all(profile.anova_f(table(spark, d, "lineitem"), [*_PROF, "l_tax"], "l_returnflag"), 4)


@query("class_weights", "SELECT o_orderstatus, COUNT(*) AS n, ROUND((SELECT COUNT(*) FROM orders) / (3e0 * COUNT(*)), 6) AS weight FROM orders GROUP BY 1")
def q_weights(spark, d):
    return round_all(profile.class_weights(table(spark, d, "orders"), "o_orderstatus"))


@query(
    "scale_pos_weight",
    """SELECT COUNT(*) FILTER (toxic = 0) AS negatives, COUNT(*) FILTER (toxic = 1) AS positives,
    ROUND(COUNT(*) FILTER (toxic = 0) / greatest(COUNT(*) FILTER (toxic = 1), 1), 6) AS scale_pos_weight FROM labels""",
)
def q_spw(spark, d):
    return round_all(profile.scale_pos_weight(table(spark, d, "labels"), "toxic"))


_ARI = """, c AS (SELECT {a} a, {b} b, COUNT(*) * 1e0 n FROM trx GROUP BY 1, 2), s AS (SELECT
    (SELECT SUM(n * (n - 1) / 2) FROM c) AS ij, (SELECT SUM(n * (n - 1) / 2) FROM (SELECT SUM(n) n FROM c GROUP BY a)) AS i,
    (SELECT SUM(n * (n - 1) / 2) FROM (SELECT SUM(n) n FROM c GROUP BY b)) AS j, (SELECT SUM(n) FROM c) AS n)
    SELECT CAST(n AS BIGINT) AS n, ROUND((ij - i * j / (n * (n - 1) / 2)) / ((i + j) / 2 - i * j / (n * (n - 1) / 2)), 6) AS ari FROM s"""


@query("adjusted_rand_index", TRX + _ARI.format(a="qty", b="flag"))
def q_ari(spark, d):
    return round_all(profile.adjusted_rand_index(trx(spark, d), "qty", "flag"))


@query(
    "min_cluster_fraction",
    TRX + """, c AS (SELECT qty, COUNT(*) n FROM trx GROUP BY 1) SELECT ROUND(MIN(n) / SUM(n), 6) AS min_fraction, COUNT(*) AS n_clusters,
    CASE WHEN MIN(n) / SUM(n) < 0.01 OR COUNT(*) < 2 THEN 1 ELSE 0 END AS is_degenerate FROM c""",
)
def q_mincluster(spark, d):
    return round_all(profile.min_cluster_fraction(trx(spark, d), "qty"))
