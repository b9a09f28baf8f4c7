"""Embeddings, clusterings and their scores."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from casefile.catalog.registry import query
from casefile.catalog.tables import incidents, plane, points, table
from casefile.operators import cluster_scores as scores
from casefile.operators import clustering, embedding
from casefile.operators.features import build_matrix
from casefile.plans import run_full_analysis


def _vectors(spark, sf):
    return points(spark, sf).select("vec_id", array_to_vector("vec").alias("features"))


def _rounded(df, digits=6):
    return df.withColumn("vec", F.transform("vec", lambda v: F.round(v, digits)))


@query("u01_truncated_svd")
def u01(spark, sf):
    return _rounded(embedding.truncated_svd(_vectors(spark, sf)).select("vec_id", "vec"))


@query("u02_svd2")
def u02(spark, sf):
    return _rounded(embedding.truncated_svd(_vectors(spark, sf), components=2).select("vec_id", "vec"))


@query("u03_pca2")
def u03(spark, sf):
    return _rounded(embedding.pca2(_vectors(spark, sf)).select("vec_id", "vec"))


# A whole basis keeps every length, so the basis is checked row by row without its vectors being known.
@query("u01_whole_basis", "SELECT vec_id, round(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)), 6) AS energy FROM embeddings")
def u01_whole(spark, sf):
    df = _vectors(spark, sf)
    vec = embedding._project(F.col("features"), embedding.svd_basis(df, components=64))
    return df.select("vec_id", F.round(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x * x), 6).alias("energy"))


@query(
    "u03_whole_basis",
    """
    WITH x AS (SELECT vec_id, unnest(embedding::DOUBLE[]) AS v, generate_subscripts(embedding, 1) AS j FROM embeddings),
    m AS (SELECT j, avg(v) AS mean FROM x GROUP BY j)
    SELECT vec_id, round(sum((v - mean) * (v - mean)), 6) AS energy FROM x JOIN m USING (j) GROUP BY vec_id
    """,
)
def u03_whole(spark, sf):
    done = embedding.pca2(_vectors(spark, sf), components=64)
    return done.select("vec_id", F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x), 6).alias("energy"))


@query(
    "j07_knn_graph",
    """
    WITH p AS (SELECT vec_id, CAST(embedding AS DOUBLE[64]) AS v FROM embeddings),
    d AS (SELECT a.vec_id AS src, b.vec_id AS dst, array_distance(a.v, b.v) AS dist FROM p a JOIN p b ON a.vec_id <> b.vec_id)
    SELECT src, dst, round(dist, 6) AS dist FROM d QUALIFY row_number() OVER (PARTITION BY src ORDER BY dist, dst) <= 15
    """,
)
def j07(spark, sf):
    return embedding.knn_graph(points(spark, sf), "vec_id").withColumn("dist", F.round("dist", 6))


@query("j07_knn_graph_curves")
def j07_curves(spark, sf):
    return embedding.knn_graph(points(spark, sf), "vec_id", method="curves")


RECALL = 0.95


@query("j07_recall", f"SELECT count(*) AS n_points, 15 * count(*) AS n_neighbours, {RECALL}::DOUBLE AS floor, true AS reached FROM embeddings")
def j07_recall(spark, sf):
    """How many of the exact neighbours the search along curves finds."""
    exact = embedding.knn_graph(points(spark, sf), "vec_id").select("src", "dst")
    found = embedding.knn_graph(points(spark, sf), "vec_id", method="curves").select("src", "dst", F.lit(1).alias("hit"))
    held = exact.join(found, ["src", "dst"], "left")
    n = F.count(F.lit(1))
    return held.agg(F.count_distinct("src").alias("n_points"), n.alias("n_neighbours"), F.lit(RECALL).alias("floor"), (F.count("hit") >= n * RECALL).alias("reached"))


@query("u04_graph_embedding")
def u04(spark, sf):
    return embedding.graph_embedding(points(spark, sf), "vec_id")


@query("u05_kmeans")
def u05(spark, sf):
    return clustering.kmeans(points(spark, sf), "vec_id", "vec", 5, starts=3)


def _dbscan_sql(eps: float, vector: str, distance: str, least: int = 10) -> str:
    return f"""
    WITH RECURSIVE p AS (SELECT vec_id AS id, {vector} FROM embeddings),
    near AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON {distance} <= {eps * eps!r}),
    core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {least}),
    e AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
    reach(id, root) AS (SELECT id, id FROM core UNION SELECT e.b, r.root FROM reach r JOIN e ON e.a = r.id WHERE r.root < e.b),
    comp AS (SELECT id, min(root) AS label FROM reach GROUP BY id),
    lab AS (SELECT id, label FROM comp
            UNION ALL SELECT n.a, min(c.label) FROM near n JOIN comp c ON c.id = n.b WHERE n.a NOT IN (SELECT id FROM core) GROUP BY n.a),
    num AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT label FROM lab))
    SELECT p.id AS vec_id, coalesce(num.cluster, -1) AS cluster FROM p LEFT JOIN lab ON lab.id = p.id LEFT JOIN num ON num.label = lab.label
    """


PLANE_VECTOR = "CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y"
PLANE_DISTANCE = "(a.x - b.x) ** 2 + (a.y - b.y) ** 2"


def _register_dbscan(eps: float, tag: str):
    @query(f"u06_dbscan_2d_{tag}", _dbscan_sql(eps, PLANE_VECTOR, PLANE_DISTANCE))
    def run(spark, sf):
        return clustering.dbscan(plane(spark, sf), "vec_id", "vec", eps)


for _eps, _tag in ((0.3, "wide"), (0.05, "middle"), (0.02, "narrow")):
    _register_dbscan(_eps, _tag)


@query("u06_dbscan_all_dims", _dbscan_sql(1.25, "CAST(embedding AS DOUBLE[64]) AS v", "array_distance(a.v, b.v) ** 2"))
def u06_all(spark, sf):
    return clustering.dbscan(points(spark, sf), "vec_id", "vec", 1.25)


def _long(label: str = "label") -> str:
    return f"""
    WITH p AS (SELECT vec_id, {label} AS c, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    x AS (SELECT vec_id, c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM p),
    n AS (SELECT c, count(*) AS n FROM p GROUP BY c),
    m AS (SELECT c, j, avg(x) AS m, avg(x * x) AS q FROM x GROUP BY c, j)
    """


def _silhouette_sql(label: str = "label") -> str:
    return f"""
    WITH p AS (SELECT vec_id, {label} AS c, CAST(embedding AS DOUBLE[64]) AS v FROM embeddings),
    d AS (SELECT a.vec_id, a.c, b.c AS other, sum(array_distance(a.v, b.v)) AS s, count(*) AS n FROM p a JOIN p b ON true GROUP BY ALL),
    ab AS (SELECT vec_id, max(s / (n - 1)) FILTER (WHERE c = other) AS a, min(s / n) FILTER (WHERE c <> other) AS b FROM d GROUP BY vec_id)
    SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM ab
    """


def _calinski_sql(label: str = "label") -> str:
    return f"""
    {_long(label)}, g AS (SELECT j, avg(x) AS g FROM x GROUP BY j),
    between_ AS (SELECT sum(n.n * (m.m - g.g) ** 2) AS b FROM m JOIN n ON m.c = n.c JOIN g ON m.j = g.j),
    within_ AS (SELECT sum((x.x - m.m) ** 2) AS w FROM x JOIN m ON x.c = m.c AND x.j = m.j),
    size AS (SELECT count(*) AS k, sum(n) AS t FROM n)
    SELECT round((b / (k - 1)) / (w / (t - k)), 6) AS calinski_harabasz FROM between_, within_, size
    """


def _davies_sql(label: str = "label") -> str:
    return f"""
    {_long(label)}, own AS (SELECT x.vec_id, x.c, sqrt(sum((x.x - m.m) ** 2)) AS d FROM x JOIN m ON x.c = m.c AND x.j = m.j GROUP BY x.vec_id, x.c),
    s AS (SELECT c, avg(d) AS s FROM own GROUP BY c),
    pairs AS (SELECT a.c AS c, b.c AS o, sqrt(sum((a.m - b.m) ** 2)) AS d FROM m a JOIN m b ON a.j = b.j AND a.c <> b.c GROUP BY ALL),
    worst AS (SELECT p.c, max((s1.s + s2.s) / p.d) AS r FROM pairs p JOIN s s1 ON p.c = s1.c JOIN s s2 ON p.o = s2.c GROUP BY p.c)
    SELECT round(avg(r), 6) AS davies_bouldin FROM worst
    """


@query(
    "u07_silhouette_sq",
    f"""
    {_long()}, dist AS (
      SELECT x.vec_id, x.c, m.c AS other, sum(x.x * x.x - 2 * x.x * m.m + m.q) AS d FROM x JOIN m ON x.j = m.j GROUP BY ALL),
    ab AS (SELECT d.vec_id, max(d.d * n.n / (n.n - 1)) FILTER (WHERE d.c = d.other) AS a, min(d.d) FILTER (WHERE d.c <> d.other) AS b
           FROM dist d JOIN n ON d.other = n.c GROUP BY d.vec_id)
    SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette_sq FROM ab
    """,
)
def u07_sq(spark, sf):
    value = scores.silhouette_squared(points(spark, sf), "vec", "label")
    return spark.createDataFrame([(round(value, 6),)], "silhouette_sq double")


@query("u07_silhouette", _silhouette_sql())
def u07(spark, sf):
    return spark.createDataFrame([(round(scores.silhouette(points(spark, sf), "vec", "label"), 6),)], "silhouette double")


@query("u08_calinski_harabasz", _calinski_sql())
def u08(spark, sf):
    value = scores.calinski_harabasz(scores.cluster_moments(points(spark, sf), "vec", "label"))
    return spark.createDataFrame([(round(value, 6),)], "calinski_harabasz double")


@query("u09_davies_bouldin", _davies_sql())
def u09(spark, sf):
    df = points(spark, sf)
    value = scores.davies_bouldin(df, scores.cluster_moments(df, "vec", "label"), "vec", "label")
    return spark.createDataFrame([(round(value, 6),)], "davies_bouldin double")


NOISY = "CASE WHEN vec_id % 13 = 0 THEN -1 ELSE label END"


@query(
    "a17_cluster_counts",
    f"SELECT count(DISTINCT {NOISY}) - 1 AS n_clusters, count(*) FILTER (WHERE {NOISY} = -1) AS n_noise FROM embeddings",
)
def a17(spark, sf):
    return scores.cluster_counts(points(spark, sf).selectExpr(f"{NOISY} AS cluster"))


@query(
    "u10_cluster_scores",
    f"""
    SELECT ({_silhouette_sql(NOISY)}) AS silhouette, ({_calinski_sql(NOISY)}) AS calinski_harabasz, ({_davies_sql(NOISY)}) AS davies_bouldin,
      count(DISTINCT {NOISY}) - 1 AS n_clusters, count(*) FILTER (WHERE {NOISY} = -1) AS n_noise
    FROM embeddings
    """,
)
def u10(spark, sf):
    found = scores.cluster_scores(points(spark, sf).selectExpr("vec", f"{NOISY} AS cluster"))
    row = tuple(round(v, 6) if isinstance(v, float) else v for v in found.values())
    return spark.createDataFrame([row], "silhouette double, calinski_harabasz double, davies_bouldin double, n_clusters bigint, n_noise bigint")


@query(
    "u12_top_combinations",
    """
    SELECT concat(source, ' + ', lang) AS combo, round(avg(n_chars % 97) / 97, 9) AS silhouette FROM documents GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 10
    """,
)
def u12(spark, sf):
    # stands in for a table of grid results
    results = table(spark, sf, "documents").groupBy(F.concat("source", F.lit(" + "), "lang").alias("combination"))
    return scores.top_combinations(results.agg(F.round(F.avg(F.col("n_chars") % 97) / 97, 9).alias("silhouette")))


@query("f07_cluster_matrix")
def matrix(spark, sf):
    df = incidents(spark, sf).select("inc_id", "time_occ", "lat", "lon", "crm_cd_desc", "status_desc", "vict_age", "loss", "const_col")
    return _rounded(build_matrix(df, key="inc_id").select("inc_id", vector_to_array("features").alias("vec")))


@query("u11_full_analysis")
def u11(spark, sf):
    # customers as a mixed table: balance, segment, nation
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation"))
    found = run_full_analysis(
        spark, df, "c_custkey", kmeans_starts=1, kmeans_sizes=(2, 5, 8), dbscan_radii=(0.3,), embeddings=("SVD2", "PCA2")
    )
    return found["results"]
