"""From a mixed table to ranked clusterings."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.config import ClusterConfig
from casefile.operators import cluster_scores as scores
from casefile.operators import embedding as emb
from casefile.operators.features import build_matrix
from casefile.operators.sampling import simple_sample
from casefile.session import durable
from casefile.sources import demo_blobs, load_table, save_records_json, save_result_csv


def build_embeddings(matrix: DataFrame, key: str, config: ClusterConfig) -> dict[str, DataFrame]:
    """(key, vec) for every wanted embedding; all start from the same matrix."""
    wanted = config.embeddings
    rows = durable(matrix.select(key, "features"))
    out = {}
    wide = durable(emb.truncated_svd(rows, components=config.svd_components).select(key, "vec"))
    if "SVD50" in wanted:
        out["SVD50"] = wide
    if "SVD2" in wanted:
        # the two leading columns of the same factorisation
        out["SVD2"] = wide.select(key, F.slice("vec", 1, 2).alias("vec"))
    if "PCA2" in wanted:
        out["PCA2"] = durable(emb.pca2(rows).select(key, "vec"))
    if "GRAPH2" in wanted:
        out["GRAPH2"] = emb.graph_embedding(wide, key, "vec", config.neighbours, seed=config.seed, method=config.neighbour_search)
    return out


def run_full_analysis(
    spark: SparkSession, source: DataFrame | str, key: str, out_dir: str | None = None, exclude: Iterable[str] = (),
    config: ClusterConfig | None = None, **overrides,
) -> dict[str, DataFrame]:
    """Embed, cluster and score a table whose rows have the whole-number key `key`.

    Returns `results`, `high`, `best` and the cluster `labels` of the best
    combination in the plane.
    """
    config = replace(config or ClusterConfig(), **overrides)
    df = load_table(spark, source)
    if config.max_samples:
        df = simple_sample(df, config.max_samples, key, config.seed)
    df = durable(df)
    matrix = build_matrix(df, exclude, config.max_categories, key=key)
    results, labels = scores.cluster_grid(build_embeddings(matrix, key, config), key, config)
    out = {"results": results, "high": scores.high_performers(results, config.silhouette_threshold), "best": scores.best_plane(results)}
    best = out["best"].first()
    if best is not None:
        out["labels"] = labels[best["combination"]]
    if out_dir:
        root = out_dir.rstrip("/")
        save_result_csv(results, f"{root}/all_combinations_results")
        save_result_csv(out["high"], f"{root}/high_performance_combinations")
    return out


def run_simple_analysis(
    spark: SparkSession, source, key: str, out_dir: str | None = None, max_samples: int | None = None, exclude: Iterable[str] = (), seed: int = 42
) -> dict[str, DataFrame]:
    return run_full_analysis(spark, source, key, out_dir, exclude, ClusterConfig(seed=seed, max_samples=max_samples))


def run_unsupervised(
    spark: SparkSession, source, key: str, out_dir: str | None = None, max_samples: int | None = None, seed: int = 42,
    interpret: bool = False, top_n: int = 10, **overrides,
) -> dict[str, DataFrame]:
    """The full analysis and, on request, the index of its best combinations."""
    out = run_full_analysis(spark, source, key, out_dir, (), ClusterConfig(seed=seed, max_samples=max_samples), **overrides)
    if interpret:
        out["index"] = scores.top_combinations(out["results"], top_n)
        if out_dir:
            save_records_json(out["index"], f"{out_dir.rstrip('/')}/cluster_interpretations_index")
    return out


def run_quick_demo(spark: SparkSession, out_dir: str | None = None, n: int = 1000, **overrides) -> dict[str, DataFrame]:
    return run_full_analysis(spark, demo_blobs(spark, n), "id", out_dir, (), None, **overrides)
