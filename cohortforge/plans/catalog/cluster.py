"""Segmentation queries."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ...functions.exprs import round_all
from ...operators import cluster, profile, reduce
from ...session import cut_lineage
from ..bindings import view
from ..registry import query
from .learn import VEC_SQL, vectors


#: Components that all clusterings are fitted on, as in the source.
COMPONENTS = 50


def points(spark, d, k=COMPONENTS):
    """Embeddings projected to the leading components, the usual input of the clusterings."""
    rows = vectors(spark, d).select("id", "label", array_to_vector("vector").alias("raw"))
    out = reduce.fit_pca(rows, "raw", "features", k).transform(rows).select("id", "label", "features")
    return cut_lineage(out)


@query("kmeans")
def q_kmeans(spark, d):
    labeled = cluster.kmeans_labels(points(spark, d), 3)
    return labeled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).withColumn("silhouette", F.lit(round(cluster.silhouette(labeled), 6)))


@query("kmeans_separable", "SELECT COUNT(*) AS n, CAST(COUNT(DISTINCT label % 3) AS BIGINT) AS n_labels FROM embeddings GROUP BY label % 3")
def q_kmeans_separable(spark, d):
    """Three points far from each other: every cluster is one of them."""
    rows = vectors(spark, d).select("id", "label", array_to_vector(F.array((F.col("label") % 3 * 100).cast("double"), F.lit(1.0))).alias("features"))
    labeled = cluster.kmeans_labels(cut_lineage(rows), 3)
    return labeled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.col("label") % 3).alias("n_labels")).drop("cluster")


@query("elbow")
def q_elbow(spark, d):
    return round_all(cluster.elbow(points(spark, d)), 4)


@query("silhouette_by_k")
def q_silhouette(spark, d):
    return round_all(cluster.silhouette_by_k(points(spark, d)), 4)


@query(
    "silhouette_squared",
    VEC_SQL + """, p AS (SELECT a.id, a.label AS c, b.label AS o, SUM(list_distance(a.vector, b.vector) ** 2) AS s, COUNT(*) AS n FROM v a JOIN v b ON TRUE GROUP BY 1, 2, 3),
    m AS (SELECT id, MAX(CASE WHEN c = o THEN s / (n - 1) END) AS a, MIN(CASE WHEN c <> o THEN s / n END) AS b FROM p GROUP BY 1)
    SELECT ROUND(AVG((b - a) / greatest(a, b)), 6) AS silhouette FROM m""",
)
def q_silhouette_exact(spark, d):
    rows = vectors(spark, d).select(F.col("label").cast("double").alias("cluster"), array_to_vector("vector").alias("features"))
    return spark.createDataFrame([(round(float(cluster.silhouette(rows)), 6),)], "silhouette double")


@query("gmm")
def q_gmm(spark, d):
    rows = points(spark, d)
    return round_all(cluster.gmm_profile(cluster.fit_gmm(rows, 3), rows), 4)


@query("gmm_bic_aic")
def q_bic(spark, d):
    return round_all(cluster.gmm_bic_aic(points(spark, d)), 3)


@query("hierarchical_clusters")
def q_hierarchy(spark, d):
    return cluster.hierarchical_labels(points(spark, d), 4).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query(
    "cluster_agreement",
    """WITH c AS (SELECT label % 5 AS a, label % 3 AS b, COUNT(*) * 1e0 n FROM embeddings GROUP BY 1, 2), s AS (SELECT
    (SELECT SUM(n * (n - 1) / 2) FROM c) AS ij, (SELECT SUM(n * (n - 1) / 2) FROM (SELECT SUM(n) n FROM c GROUP BY a)) AS i,
    (SELECT SUM(n * (n - 1) / 2) FROM (SELECT SUM(n) n FROM c GROUP BY b)) AS j, (SELECT SUM(n) FROM c) AS n)
    SELECT CAST(n AS BIGINT) AS n, ROUND((ij - i * j / (n * (n - 1) / 2)) / ((i + j) / 2 - i * j / (n * (n - 1) / 2)), 6) AS ari FROM s""",
)
def q_agreement(spark, d):
    rows = view(spark, d, "SELECT label % 5 AS a, label % 3 AS b FROM {embeddings}")
    return round_all(profile.adjusted_rand_index(rows, "a", "b"))


@query("kmeans_gmm_agreement")
def q_km_gmm(spark, d):
    rows = points(spark, d)
    km = cluster.kmeans_labels(rows, 3).select("id", F.col("cluster").alias("a"))
    gm = cluster.fit_gmm(rows, 3).transform(rows).select("id", F.col("cluster").alias("b"))
    return round_all(profile.adjusted_rand_index(km.join(gm, "id"), "a", "b"), 4)


@query(
    "cluster_profile",
    """WITH p AS (SELECT l_suppkey % 4 AS cluster, COUNT(*) AS n, AVG(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r, AVG(l_quantity) AS q, AVG(l_extendedprice) AS e FROM lineitem GROUP BY 1)
    SELECT cluster, n, ROUND(r, 3) AS target_rate, ROUND(q, 3) AS l_quantity_mean, ROUND(e, 3) AS l_extendedprice_mean,
    ROUND((q - (SELECT AVG(q) FROM p)) / (SELECT stddev_samp(q) FROM p), 6) AS l_quantity_z FROM p""",
)
def q_profile(spark, d):
    rows = view(spark, d, "SELECT l_suppkey % 4 AS cluster, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_quantity, l_extendedprice FROM {lineitem}")
    cols = ["l_quantity", "l_extendedprice"]
    wide = profile.named_group_agg(rows, "cluster", "y", cols)
    z = profile.group_zscore(profile.group_mean_profile(rows, "cluster", cols), "cluster", cols)
    return wide.join(z.select("cluster", F.round("l_quantity", 6).alias("l_quantity_z")), "cluster")


@query("pca_projection_table")
def q_projection(spark, d):
    rows = vectors(spark, d).select("id", "label", array_to_vector("vector").alias("features"))
    out = reduce.projection_table(reduce.fit_pca(rows, "features", "pcs", 2), rows, "pcs", ["id", "label"])
    return out.select("id", "label", F.round(F.abs("pc1"), 5).alias("pc1_abs"), F.round(F.abs("pc2"), 5).alias("pc2_abs"))


