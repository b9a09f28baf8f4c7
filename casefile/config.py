"""Settings of the four pipelines, validated on construction."""

from __future__ import annotations

from dataclasses import dataclass

# Default settings every pipeline starts from.
TOP_CATEGORY_COLUMNS = ("crm_cd_desc", "premis_desc", "weapon_desc", "status_desc", "area_name")
KMEANS_SIZES = (2, 3, 4, 5, 6, 7, 8)
DBSCAN_RADII = (0.3, 0.5, 0.7)
DBSCAN_MIN_SAMPLES = 10
FORECAST_MODELS = ("naive_last", "naive_mean7", "sarimax", "prophet", "lstm")
COMPARED_MODELS = ("logreg", "rf", "hgb", "xgb")


@dataclass(frozen=True)
class EdaConfig:
    use_us_holidays: bool = True
    add_hex: bool = False
    hex_size_m: float = 460.0
    iqr_clip: bool = True
    iqr_multiplier: float = 1.5
    zscore_winsor: bool = True
    zscore_max: float = 4.0
    drop_any_missing: bool = True
    one_class_filter: bool = False
    one_class_nu: float = 0.01
    one_class_gamma: str | float = "scale"
    clip_calendar_columns: bool = False

    def __post_init__(self):
        if not 0 < self.one_class_nu < 1:
            raise ValueError("one_class_nu must be between 0 and 1")


@dataclass(frozen=True)
class MLConfig:
    seed: int = 42
    n_splits: int = 5
    scoring: str = "roc_auc"
    search_type: str = "random"
    n_iter: int = 30
    sample_n: int | None = 5000
    sample_first: bool = True
    stratify_by: str | None = None
    equalize_strata: bool = False
    test_size: float | None = None
    class_weight: str | None = "balanced"
    handle_imbalance: bool = True
    parallelism: int = 4
    result_dir: str | None = None
    search_includes_holdout: bool = False

    def __post_init__(self):
        wrong = []
        if self.test_size is not None and (self.test_size <= 0 or self.test_size >= 1):
            wrong.append(f"a hold-out share of {self.test_size} leaves nothing to fit or to test")
        if self.n_splits < 2:
            wrong.append(f"{self.n_splits} folds cannot be cross-validated")
        if self.search_type not in {"grid", "random"}:
            wrong.append(f"no search is called {self.search_type!r}: choose grid or random")
        if wrong:
            raise ValueError("; ".join(wrong))


@dataclass(frozen=True)
class ForecastConfig:
    horizon: int = 30
    eval_days: int = 90
    rolling_splits: int = 3
    models: tuple[str, ...] = FORECAST_MODELS
    lookback: int = 60

    def __post_init__(self):
        if self.horizon < 1 or self.rolling_splits < 1:
            raise ValueError("horizon and rolling_splits must be positive")
        unknown = set(self.models) - set(FORECAST_MODELS)
        if unknown:
            raise ValueError(f"unknown forecast models: {sorted(unknown)}")


@dataclass(frozen=True)
class ClusterConfig:
    seed: int = 42
    max_categories: int = 30
    svd_components: int = 50
    max_samples: int | None = None
    silhouette_threshold: float = 0.6
    kmeans_sizes: tuple[int, ...] = KMEANS_SIZES
    kmeans_starts: int = 10
    dbscan_radii: tuple[float, ...] = DBSCAN_RADII
    dbscan_min_samples: int = DBSCAN_MIN_SAMPLES
    neighbours: int = 15
    embeddings: tuple[str, ...] = ("SVD50", "SVD2", "PCA2", "GRAPH2")
    noise_as_cluster: bool = True
    # "euclidean" and "exact" compare all pairs of points; "squared" and "curves" are for large tables.
    silhouette: str = "euclidean"
    neighbour_search: str = "exact"
