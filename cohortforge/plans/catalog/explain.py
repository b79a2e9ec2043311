"""Explanation queries, with closed-form scorers where an oracle is wanted."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.exprs import round_all
from ...operators import cluster, explain, learners, trees
from ...session import cut_lineage
from ..registry import query
from .learn import LN, PART_COLS, PT, lines, parts


def fitted_tree(spark, d, name="decision_tree", **params):
    rows = cut_lineage(parts(spark, d))
    return learners.fit_scorer(name, rows, **params), rows


def on_columns(score) -> learners.Scorer:
    """Scorer over plain columns: assembles the vector, then applies the model."""
    asm = VectorAssembler(inputCols=list(PART_COLS), outputCol="features")
    return lambda df: score(asm.transform(df.drop("features")))


@query("feature_importance")
def q_importance(spark, d):
    score, _ = fitted_tree(spark, d, "random_forest")
    return round_all(explain.feature_importance(score.model, PART_COLS, spark), 5)


@query("top_importances")
def q_top(spark, d):
    score, _ = fitted_tree(spark, d, "random_forest")
    return round_all(explain.feature_importance(score.model, PART_COLS, spark, 2), 5)


def rule_scorer(df: DataFrame) -> DataFrame:
    """A fixed scorer over order lines."""
    return df.withColumns(
        {"y_pred": F.when((F.col("price") > 35000) & (F.col("qty") > 15), 1).otherwise(0), "y_prob": F.col("qty") / 100 + F.col("disc") * F.col("tax")}
    )


_RULE = "CASE WHEN {p} > 35000 AND {q} > 15 THEN 1 ELSE 0 END"


@query(
    "permutation_importance",
    LN + f""", o AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || id)) AS pl, COUNT(*) OVER () AS n FROM li),
    a AS (SELECT *, 1 + (pl - 1 + (n * (rep + 1)) // 11) % n AS at FROM o, range(10) AS r(rep)), b AS (SELECT qty AS oq, price AS op, pl FROM o),
    j AS (SELECT a.rep, label, {_RULE.format(p='price', q='oq')} AS pq, {_RULE.format(p='op', q='qty')} AS pp FROM a JOIN b ON a.at = b.pl),
    base AS (SELECT AVG(CASE WHEN {_RULE.format(p='price', q='qty')} = label THEN 1 ELSE 0 END) AS x FROM li),
    s AS (SELECT 'qty' AS feature, rep, AVG(CASE WHEN pq = label THEN 1 ELSE 0 END) AS acc FROM j GROUP BY rep UNION ALL SELECT 'price', rep, AVG(CASE WHEN pp = label THEN 1 ELSE 0 END) FROM j GROUP BY rep)
    SELECT feature, ROUND(AVG(x - acc), 6) AS importance_mean, ROUND(stddev_pop(x - acc), 6) AS importance_std FROM s, base GROUP BY feature""",
)
def q_permutation(spark, d):
    return round_all(explain.permutation_importance(lines(spark, d), rule_scorer, ["qty", "price"]))


@query("permutation_importance_model")
def q_permutation_model(spark, d):
    score, rows = fitted_tree(spark, d, maxDepth=5)
    return round_all(explain.permutation_importance(rows, on_columns(score), PART_COLS), 5)


@query(
    "partial_dependence",
    LN + """, g AS (SELECT DISTINCT qty AS v FROM li), m AS (SELECT AVG(disc * tax) AS c, AVG(qty) / 100 AS q, AVG(tax) AS t FROM li), dg AS (SELECT DISTINCT disc AS v FROM li)
    SELECT 'qty' AS feature, v AS value, ROUND(v / 100 + c, 9) AS mean_prediction FROM g, m UNION ALL SELECT 'disc', v, ROUND(q + v * t, 9) FROM dg, m""",
)
def q_pdp(spark, d):
    return round_all(explain.partial_dependence(lines(spark, d), rule_scorer, ["qty", "disc"]), 9, keep=["value"])


@query(
    "pdp_grid",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, .05) a, quantile_cont(l_extendedprice, .95) b FROM lineitem)
    SELECT CAST(i AS INT) AS point, ROUND(a + (b - a) * i / 99, 4) AS value FROM q, (SELECT unnest(range(100)) AS i)""",
)
def q_grid(spark, d):
    grid = explain.pdp_grid(lines(spark, d), ["price"])["price"]
    return round_all(spark.createDataFrame(list(enumerate(grid)), "point int, value double"), 4)


@query("partial_dependence_model")
def q_pdp_model(spark, d):
    score, rows = fitted_tree(spark, d, maxDepth=5)
    return round_all(explain.partial_dependence(rows, on_columns(score), ["size", "cheap_type"]), 5)


BACKGROUND = [[10.0, 0.02, 0.01], [40.0, 0.08, 0.06]]


@query(
    "shapley_sampling",
    LN + """, b AS (SELECT * FROM (VALUES (10e0, 0.02e0, 0.01e0), (40e0, 0.08e0, 0.06e0)) t(bq, bd, bt))
    SELECT id, ROUND(qty / 100 + disc * tax - AVG(bq / 100 + bd * bt), 6) AS total, ROUND(AVG((qty - bq) / 100), 6) AS qty_part FROM li, b GROUP BY id, qty, disc, tax""",
)
def q_shapley(spark, d):
    """Additivity: attributions of a row sum to its score minus the mean background score."""
    out = explain.shapley_sampling(lines(spark, d), rule_scorer, ["qty", "disc", "tax"], BACKGROUND)
    return out.groupBy("id").agg(
        F.round(F.sum("attribution"), 6).alias("total"), F.round(F.sum(F.when(F.col("feature") == "qty", F.col("attribution"))), 6).alias("qty_part")
    )


@query("shapley_summary_model")
def q_shapley_model(spark, d):
    score, rows = fitted_tree(spark, d, maxDepth=5)
    centers = cluster.fit_kmeans(rows, 5).clusterCenters()  # the background: five numbers per feature
    values = explain.shapley_sampling(rows, on_columns(score), PART_COLS, [list(c) for c in centers])
    return round_all(explain.shapley_summary(values), 5)


RARE = """WITH li AS (SELECT l_orderkey * 8 + l_linenumber AS id, CAST(l_quantity > 40 AS INT) AS a, CAST(l_discount > 0.05 AS INT) AS b, CAST(l_tax > 0.07 AS INT) AS c FROM lineitem),
    la AS (SELECT *, CASE WHEN a = 1 AND (b = 1 OR c = 1) THEN 1 ELSE 0 END AS label FROM li)"""


def rare_lines(spark, d):
    """Order lines with three flags; the label needs the first and one of the others, so its tree is known."""
    spark.read.parquet(f"{d}/lineitem.parquet").createOrReplaceTempView("lineitem")
    rows = spark.sql(RARE + " SELECT id, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b, CAST(c AS DOUBLE) AS c, CAST(label AS DOUBLE) AS label FROM la")
    rows = cut_lineage(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows))
    return rows, trees.read_boxes(learners.fit_scorer("decision_tree", rows).model, spark)


def _subset_sql() -> str:
    """The Shapley value of each flag as the sum over all subsets of the others."""
    def known(s: str) -> str:
        a, b, c = (x if x in s else f"p{x}" for x in "abc")
        return f"{a} * ({b} + (1 - {b}) * {c})"

    parts = []
    for j in "abc":
        i, k = (x for x in "abc" if x != j)
        gain = [f"{w} * ({known(s + j)} - {known(s)})" for s, w in (("", "1/3.0"), (i, "1/6.0"), (k, "1/6.0"), (i + k, "1/3.0"))]
        parts.append(f"SELECT id, '{j}' AS feature, ROUND({' + '.join(gain)}, 6) AS attribution FROM la, p")
    shares = "p AS (SELECT AVG(a) AS pa, AVG(CASE WHEN a = 1 THEN b END) AS pb, AVG(CASE WHEN a = 1 AND b = 0 THEN c END) AS pc FROM la)"
    return f"{RARE}, {shares} {' UNION ALL '.join(parts)}"


@query("tree_shapley", _subset_sql())
def q_tree_shapley(spark, d):
    rows, boxes = rare_lines(spark, d)
    return round_all(trees.tree_shapley(rows, boxes, ["a", "b", "c"]), 6)


@query(
    "tree_partial_dependence",
    RARE + """, v AS (SELECT unnest([0.0, 1.0]) AS v), l AS (SELECT AVG(CASE WHEN b = 1 OR c = 1 THEN 1e0 ELSE 0 END) AS bc, AVG(CASE WHEN a = 1 THEN 1e0 ELSE 0 END) AS a,
    AVG(CASE WHEN a = 1 AND c = 1 THEN 1e0 ELSE 0 END) AS ac, AVG(CASE WHEN a = 1 AND b = 1 THEN 1e0 ELSE 0 END) AS ab FROM la)
    SELECT 'a' AS feature, CAST(v AS DOUBLE) AS value, ROUND(v * bc, 9) AS mean_prediction FROM v, l UNION ALL SELECT 'b', v, ROUND(CASE WHEN v = 1 THEN a ELSE ac END, 9) FROM v, l
    UNION ALL SELECT 'c', v, ROUND(CASE WHEN v = 1 THEN a ELSE ab END, 9) FROM v, l""",
)
def q_tree_pdp(spark, d):
    rows, boxes = rare_lines(spark, d)
    return round_all(trees.tree_partial_dependence(rows, boxes, ["a", "b", "c"], {c: [0.0, 1.0] for c in "abc"}), 9, keep=["value"])


@query("tree_shapley_summary_model")
def q_tree_shapley_model(spark, d):
    """The registered tree at its full depth."""
    score, rows = fitted_tree(spark, d)
    return round_all(explain.shapley_summary(trees.tree_shapley(rows, trees.read_boxes(score.model, spark), PART_COLS)), 5)


@query("local_surrogate")
def q_surrogate(spark, d):
    score, rows = fitted_tree(spark, d, "logistic_regression")
    return round_all(explain.local_surrogate(rows, on_columns(score), PART_COLS), 4)


@query(
    "local_surrogate_linear",
    LN + "SELECT COUNT(*) AS n_rows, 1 AS rank_of_qty FROM li",
)
def q_surrogate_linear(spark, d):
    """On a linear scorer the dominant feature must come out first for every row."""
    linear = lambda df: df.withColumn("y_prob", 3 * F.col("qty") / 15 + F.col("tax"))
    out = explain.local_surrogate(lines(spark, d), linear, ["qty", "tax"], samples=20)
    return out.where("feature = 'qty'").agg(F.count(F.lit(1)).alias("n_rows"), F.max("rank").alias("rank_of_qty"))


@query("tree_rules")
def q_tree(spark, d):
    score, rows = fitted_tree(spark, d, maxDepth=3)
    return explain.tree_rules(score.model, rows, PART_COLS)


@query("forest_top_rules")
def q_forest(spark, d):
    score, rows = fitted_tree(spark, d, "random_forest")
    return explain.tree_rules(score.model, rows, PART_COLS, max_depth=3)


@query("tree_rules_cover", f"{PT}SELECT COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS n_positive FROM pa")
def q_cover(spark, d):
    """The leaves of a tree partition the rows."""
    score, rows = fitted_tree(spark, d, maxDepth=4)
    return explain.tree_rules(score.model, rows, PART_COLS).agg(F.sum("n").alias("n"), F.sum("n_positive").alias("n_positive"))


