"""Scores of a clustering and the ranked grid of embeddings and algorithms."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.functions.values import col
from casefile.operators.cleaning import above_threshold
from casefile.operators.clustering import dbscan, kmeans
from casefile.operators.distance_sums import MOST_DIMS, silhouette_sum
from casefile.operators.pairs import SMALL_BLOCK_ROWS, block_pairs, distances, strips
from casefile.operators.ranking import top_rows
from casefile.session import durable

# Clusters up to which a box keeps sums for each of them.
MOST_SUMMED = 1000

GRID_SCHEMA = """
embedding string, algorithm string, config string, k int, eps double, min_samples int, embedding_dim int,
silhouette double, calinski_harabasz double, davies_bouldin double, n_clusters bigint, n_noise bigint, combination string, silhouette_measure string, error string
"""


def cluster_counts(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Number of clusters without noise, and of noise points, from the cluster sizes."""
    sizes = df.groupBy(col(cluster).alias("c")).count()
    return sizes.agg(
        F.count_if(F.col("c") != -1).alias("n_clusters"),
        F.coalesce(F.sum(F.when(F.col("c") == -1, F.col("count"))), F.lit(0)).alias("n_noise"),
    )


def silhouette_squared(df: DataFrame, vec: str = "vec", cluster: str = "cluster") -> float:
    """Mean silhouette over squared Euclidean distances, linear in the points."""
    rows = df.select(array_to_vector(col(vec).cast("array<double>")).alias("features"), col(cluster).cast("double").alias("prediction"))
    return ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(rows)


def silhouette(df: DataFrame, vec: str = "vec", cluster: str = "cluster") -> float:
    """Mean silhouette over Euclidean distances, every pair of points.

    In up to three dimensions distances from far points are added up box by box, and the work grows
    with the points. In more dimensions, or with very many clusters, blocks of points meet in pairs,
    so the work and the rows moved grow with the square of the points; `silhouette_squared` is the
    measure for large tables there.
    """
    rows = df.select(F.monotonically_increasing_id().alias("id"), col(cluster).cast("long").alias("c"), col(vec).cast("array<double>").alias("x"))
    rows = durable(rows)
    dims, sizes = _low_dimensions(rows)
    if dims:
        return silhouette_sum(rows.groupBy("x", "c").agg(F.count(F.lit(1)).alias("n")), sizes, dims) / sum(sizes.values())

    def sums(left, right):
        if left.empty or right.empty:
            return pd.DataFrame({"id": [], "own": [], "c": [], "d": []})
        names, codes = np.unique(right["c"].to_numpy(), return_inverse=True)
        x, y = np.stack(left["x"].to_numpy()), np.stack(right["x"].to_numpy())
        own, ids = left["id"].to_numpy(), right["id"].to_numpy()
        # points of one cluster stand together, so that their distances are added up as slices
        order = np.argsort(codes, kind="stable")
        starts = np.searchsorted(codes[order], np.arange(len(names)))
        y, ids, wide = y[order], ids[order], len(names)
        total = np.empty((len(x), wide))
        for part in strips(len(x), len(y)):
            d = distances(x[part], y)
            d[own[part][:, None] == ids[None, :]] = 0.0
            total[part] = np.add.reduceat(d, starts, axis=1)
        return pd.DataFrame({"id": np.repeat(own, wide), "own": np.repeat(left["c"].to_numpy(), wide), "c": np.tile(names, len(left)), "d": total.ravel()})

    total = block_pairs(rows, "id").applyInPandas(sums, "id long, own long, c long, d double").groupBy("id", "own", "c").agg(F.sum("d").alias("d"))
    met = total.join(rows.groupBy("c").agg(F.count(F.lit(1)).alias("n")), "c")
    own = F.col("c") == F.col("own")
    inner = F.max(F.when(own, F.col("d") / F.greatest(F.col("n") - 1, F.lit(1))))
    sides = met.groupBy("id").agg(inner.alias("a"), F.min(F.when(~own, F.col("d") / F.col("n"))).alias("b"), F.max(F.when(own, F.col("n"))).alias("n"))
    width = (F.col("b") - F.col("a")) / F.greatest("a", "b", F.lit(1e-300))
    return sides.agg(F.avg(F.when(F.col("n") > 1, width).otherwise(0.0))).first()[0]


def _low_dimensions(rows: DataFrame) -> tuple[int, dict[int, int]]:
    """Dimensions and cluster sizes where distances can be added up box by box, else 0; a single small block needs no boxes."""
    fine = ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) > 1e150))
    total, wide, narrow, known = rows.agg(
        F.count(F.lit(1)), F.max(F.size("x")), F.min(F.size("x")), F.coalesce(F.bool_and(F.coalesce(fine, F.lit(False)) & F.col("c").isNotNull()), F.lit(False))
    ).first()
    if total <= SMALL_BLOCK_ROWS or not known or wide != narrow or not 1 <= wide <= MOST_DIMS:
        return 0, {}
    found = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n")).limit(MOST_SUMMED + 1).collect()
    return (wide if 2 <= len(found) <= MOST_SUMMED else 0), {r["c"]: r["n"] for r in found}


def cluster_moments(df: DataFrame, vec: str = "vec", cluster: str = "cluster") -> DataFrame:
    """(cluster, n, mean, spread): size, centre, and summed squared distance from the
    centre, of each cluster."""
    rows = df.select(array_to_vector(col(vec).cast("array<double>")).alias("_f"), col(cluster).alias("cluster"))
    stats = rows.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.mean(F.col("_f"))).alias("mean"), vector_to_array(Summarizer.variance(F.col("_f"))).alias("var")
    )
    spread = F.aggregate("var", F.lit(0.0), lambda s, v: s + v) * (F.col("n") - 1)
    # a cluster of one point has no variance
    return stats.select("cluster", "n", "mean", F.when(F.col("n") > 1, spread).otherwise(0.0).alias("spread"))


def calinski_harabasz(moments: DataFrame) -> float | None:
    """Between over within variance, each per degree of freedom, from `cluster_moments`."""
    total = moments.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum("spread").alias("within")).first()
    if total["k"] < 2 or total["n"] <= total["k"]:
        return None
    parts = moments.select("n", F.posexplode("mean").alias("j", "m"))
    per_dim = parts.groupBy("j").agg(
        F.sum(F.col("n") * F.col("m")).alias("s"), F.sum("n").alias("n")
    ).select("j", (F.col("s") / F.col("n")).alias("g"))
    between = parts.join(F.broadcast(per_dim), "j").agg(F.sum(F.col("n") * (F.col("m") - F.col("g")) ** 2)).first()[0]
    if total["within"] == 0:
        return 1.0
    return between * (total["n"] - total["k"]) / (total["within"] * (total["k"] - 1))


def davies_bouldin(df: DataFrame, moments: DataFrame, vec: str = "vec", cluster: str = "cluster") -> float | None:
    """Mean over clusters of the worst ratio of spreads to centre distance.

    Blocks of centres meet in pairs, whatever the number of clusters.
    """
    centres = moments.select("cluster", "mean")
    rows = df.select(col(vec).cast("array<double>").alias("x"), col(cluster).alias("cluster")).join(centres, "cluster")
    far = F.sqrt(F.aggregate(F.zip_with("x", "mean", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))
    table = durable(rows.groupBy("cluster").agg(F.avg(far).alias("s"), F.first("mean").alias("x")))
    if table.count() < 2:
        return None

    def worst(left, right):
        if left.empty or right.empty:
            return pd.DataFrame({"place": [], "ratio": []})
        x, y = np.stack(left["x"].to_numpy()), np.stack(right["x"].to_numpy())
        ratios = []
        for name, s, m in zip(left["cluster"], left["s"], x, strict=True):
            d = np.sqrt(((y - m) ** 2).sum(axis=1))
            d[(right["cluster"] == name).to_numpy()] = np.inf
            ratios.append(np.divide(s + right["s"].to_numpy(), d, out=np.zeros_like(d), where=d > 0).max())
        return pd.DataFrame({"place": left["place"], "ratio": ratios})

    placed = table.select(F.xxhash64("cluster").alias("place"), "cluster", "s", "x")
    found = block_pairs(placed, "cluster").applyInPandas(worst, "place long, ratio double")
    return found.groupBy("place").agg(F.max("ratio").alias("ratio")).agg(F.avg("ratio")).first()[0]


SILHOUETTES = {"euclidean": silhouette, "squared": silhouette_squared}


def cluster_scores(df: DataFrame, vec: str = "vec", cluster: str = "cluster", noise_as_cluster: bool = True, measure: str = "euclidean") -> dict:
    """All scores of one clustering. With one label only, or nothing but noise, there
    are no scores and one cluster is reported. `measure` says over which distances the
    silhouette is taken: "euclidean" compares all pairs, "squared" is linear in the points."""
    if measure not in SILHOUETTES:
        raise ValueError(f"no silhouette is called {measure!r}: choose one of {sorted(SILHOUETTES)}")
    rows = df.select(col(vec).alias("vec"), col(cluster).alias("cluster"))
    counts = cluster_counts(rows).first()
    labels = counts["n_clusters"] + (1 if counts["n_noise"] else 0)
    empty = {"silhouette": None, "calinski_harabasz": None, "davies_bouldin": None}
    if labels <= 1:
        return {**empty, "n_clusters": 1, "n_noise": counts["n_noise"]}
    scored = rows if noise_as_cluster else rows.filter("cluster <> -1")
    out = {**empty, "n_clusters": counts["n_clusters"], "n_noise": counts["n_noise"]}
    if not noise_as_cluster and counts["n_clusters"] < 2:
        return out
    moments = durable(cluster_moments(scored))
    out["silhouette"] = SILHOUETTES[measure](scored)
    out["calinski_harabasz"] = calinski_harabasz(moments)
    out["davies_bouldin"] = davies_bouldin(scored, moments)
    return out


# ---- the grid ---------------------------------------------------------------


def combination_label(embedding: F.Column, algorithm: F.Column, config: F.Column) -> F.Column:
    return F.concat(embedding, F.lit(" + "), algorithm, F.lit(" ("), config, F.lit(")"))


def parse_combination(label: F.Column) -> dict[str, F.Column]:
    """The parts of a combination label, with k, eps and min as numbers."""
    config = F.regexp_extract(label, r"\((.*)\)$", 1)
    settings = F.str_to_map(config, F.lit("_"), F.lit("="))
    head = F.split(F.regexp_replace(label, r" \(.*\)$", ""), r" \+ ")
    return {
        "embedding": head[0],
        "algorithm": head[1],
        "config": config,
        "k": settings["k"].try_cast("int"),
        "eps": settings["eps"].try_cast("double"),
        "min_samples": settings["min"].try_cast("int"),
    }


def cluster_grid(embeddings: dict[str, DataFrame], id_col: str, config) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Every algorithm and setting on every embedding (tables of id and `vec`).

    Returns the table of scores and the cluster labels of each combination; one that failed
    has no scores but its error.
    """
    rows, labels = [], {}
    spark = next(iter(embeddings.values())).sparkSession
    for name, table in embeddings.items():
        dim = table.select(F.size("vec")).first()[0]
        runs = [("KMeans", f"k={k}", k, None, None) for k in config.kmeans_sizes]
        runs += [("DBSCAN", f"eps={e}_min={config.dbscan_min_samples}", None, e, config.dbscan_min_samples) for e in config.dbscan_radii]
        for algorithm, setting, k, eps, least in runs:
            label = f"{name} + {algorithm} ({setting})"
            setting_of = (name, algorithm, setting, k, eps, least, dim)
            try:
                if k:
                    found = kmeans(table, id_col, "vec", k, config.kmeans_starts, config.seed)
                else:
                    found = durable(dbscan(table, id_col, "vec", eps, least))
                s = cluster_scores(table.join(found, id_col), noise_as_cluster=config.noise_as_cluster, measure=config.silhouette)
            except Exception as error:  # noqa: BLE001 - a setting that cannot run is a row of the result
                rows.append((*setting_of, *[None] * 5, label, config.silhouette, str(error).splitlines()[0] if str(error) else type(error).__name__))
                continue
            labels[label] = found
            rows.append((*setting_of, s["silhouette"], s["calinski_harabasz"], s["davies_bouldin"], s["n_clusters"], s["n_noise"], label, config.silhouette, None))
    return spark.createDataFrame(rows, GRID_SCHEMA), labels


def high_performers(results: DataFrame, threshold: float = 0.6) -> DataFrame:
    return above_threshold(results, "silhouette", threshold)


def best_plane(results: DataFrame) -> DataFrame:
    """The best-scored combination on a two-dimensional embedding."""
    flat = results.filter((F.col("embedding_dim") == 2) & F.col("silhouette").isNotNull())
    return top_rows(flat, 1, "silhouette", "combination")


def top_combinations(results: DataFrame, n: int = 10) -> DataFrame:
    """(combo, silhouette) of the n best-scored combinations."""
    scored = results.na.drop(subset=["silhouette"])
    return top_rows(scored, n, "silhouette", "combination").select(F.col("combination").alias("combo"), "silhouette")
