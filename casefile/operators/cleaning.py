"""Row filters, coordinate audit, outlier bounds."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.functions import dates
from casefile.functions.values import clip, col, present_number
from casefile.operators.quantiles import EXACT_ROWS, quantiles
from casefile.session import durable

# The coordinate box of the audit and the issue names it reports.
LAT_RANGE = (33.3, 34.9)
LON_RANGE = (-119.1, -117.5)
ISSUE_ZERO = "zero_zero_coords"
ISSUE_OUTSIDE = "outside_LA_bbox"

# Date windows tried in turn.
DATE_WINDOWS = ("2000-01-01", "1990-01-01")


def filter_date_range(df: DataFrame, ts: F.Column, first_day: str = DATE_WINDOWS[0], as_of=None) -> DataFrame:
    """Rows dated in [first_day, as_of], both included; rows without date go."""
    return df.filter(ts.between(F.lit(first_day).cast(dates.NTZ), dates.as_of_column(as_of)))


def filter_date_range_or_widen(df: DataFrame, ts: F.Column, as_of=None) -> DataFrame:
    """The first date window that holds any row, else every dated row, else an error."""
    low = [F.lit(d).cast(dates.NTZ) for d in DATE_WINDOWS]
    high = dates.as_of_column(as_of)
    inside = [ts.between(d, high) for d in low] + [ts.isNotNull()]
    hits = df.agg(*[F.count_if(c).alias(str(i)) for i, c in enumerate(inside)]).first()
    for i, condition in enumerate(inside):
        if hits[str(i)]:
            return df.filter(condition)
    raise ValueError("no usable dates")


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows in which all (listed) columns are present; null and NaN are missing."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def deduplicate(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def above_threshold(df: DataFrame, score: str, threshold: float = 0.6) -> DataFrame:
    """Rows whose score is present and at least the threshold."""
    return drop_missing(df, [score]).filter(col(score) >= threshold)


def coordinate_flags(df: DataFrame, lat_col: str, lon_col: str, lat_range=LAT_RANGE, lon_range=LON_RANGE):
    lat, lon = present_number(df, lat_col), present_number(df, lon_col)
    zero = (F.coalesce(lat, F.lit(0.0)) == 0) & (F.coalesce(lon, F.lit(0.0)) == 0)
    outside = ~F.coalesce(lat.between(*lat_range) & lon.between(*lon_range), F.lit(False))
    return {ISSUE_ZERO: zero, ISSUE_OUTSIDE: outside}


def coordinate_issues(
    df: DataFrame, lat_col: str | None, lon_col: str | None, lat_range=LAT_RANGE, lon_range=LON_RANGE
) -> DataFrame:
    """(issue, count) for zero/zero pairs, where null counts as zero, and for points
    outside the box, where null counts as outside. Only issues found are listed."""
    if not lat_col or not lon_col:
        return df.sparkSession.createDataFrame([], "issue string, count bigint")
    flags = coordinate_flags(df, lat_col, lon_col, lat_range, lon_range)
    counted = df.agg(*[F.count_if(c).alias(name) for name, c in flags.items()])
    return counted.unpivot([], list(flags), "issue", "count").filter("count > 0")


def drop_bad_coordinates(df: DataFrame, lat_col: str, lon_col: str, lat_range=LAT_RANGE, lon_range=LON_RANGE) -> DataFrame:
    """Only on request: the rows without any coordinate issue."""
    flags = coordinate_flags(df, lat_col, lon_col, lat_range, lon_range)
    return df.filter(~(flags[ISSUE_ZERO] | flags[ISSUE_OUTSIDE]))


def _replace(df: DataFrame, new: dict[str, F.Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else col(c) for c in df.columns])


def iqr_clip(df: DataFrame, columns: Sequence[str], whisker: float = 1.5, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """Bound each column to [q1 - w iqr, q3 + w iqr]; results are doubles."""
    bounds = quantiles(df, list(columns), [0.25, 0.75], exact_rows)
    new = {}
    for c, (q1, q3) in bounds.items():
        x = present_number(df, c)
        new[c] = x if q1 is None else clip(x, q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1))
    return _replace(df, new)


def zscore_winsorize(df: DataFrame, columns: Sequence[str], zmax: float = 4.0) -> DataFrame:
    """Bound each column to mean +- zmax population standard deviations (0 counts as 1)."""
    if not columns:
        return df
    stats = []
    for i, c in enumerate(columns):
        x = present_number(df, c)
        stats += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = df.agg(*stats).first()
    new = {}
    for i, c in enumerate(columns):
        mean, sd = row[f"m{i}"], row[f"s{i}"] or 1.0
        x = present_number(df, c)
        new[c] = x if mean is None else clip(x, mean - zmax * sd, mean + zmax * sd)
    return _replace(df, new)


def one_class_scores(
    df: DataFrame, columns: Sequence[str], gamma: str | float = "scale", features: int = 128, seed: int = 42
) -> DataFrame:
    """Append `_density`, how much a row resembles the table under an RBF kernel.

    Columns are standardised; random Fourier features turn the mean kernel value
    against all rows into one dot product with the mean feature vector, so the cost
    is linear in the rows.
    """
    stats = []
    for i, c in enumerate(columns):
        x = present_number(df, c)
        stats += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = df.agg(*stats).first()
    scaled = [
        F.coalesce((present_number(df, c) - (row[f"m{i}"] or 0.0)) / ((row[f"s{i}"] or 0.0) + 1e-9), F.lit(0.0))
        for i, c in enumerate(columns)
    ]
    # after scaling the mean variance is 1 for every column that varies
    spread = sum(1.0 for i in range(len(columns)) if row[f"s{i}"]) / len(columns) or 1.0
    width = 1.0 / (len(columns) * spread) if gamma == "scale" else float(gamma)
    kernel = fourier_map(len(columns), width, features, seed)

    def partial_sums(batches):
        total, count = np.zeros(features), 0
        for batch in batches:
            total += kernel(batch.to_numpy()).sum(axis=0)
            count += len(batch)
        yield pd.DataFrame({"total": [total], "count": [count]})

    # one short row per task
    points = df.select(*[x.alias(str(i)) for i, x in enumerate(scaled)])
    sums = points.mapInPandas(partial_sums, "total array<double>, count long")
    rows = sums.select("count", F.posexplode("total").alias("j", "v")).groupBy("j").agg(F.sum("v").alias("v"), F.sum("count").alias("n"))
    mean = np.array([r["v"] / max(r["n"], 1) for r in rows.orderBy("j").collect()])

    @F.pandas_udf("double")
    def similarity(*values: pd.Series) -> pd.Series:
        return pd.Series(kernel(np.column_stack(values)) @ mean)

    return df.withColumn("_density", similarity(*scaled))


def fourier_map(dims: int, gamma: float, features: int, seed: int):
    """Random Fourier features of an RBF kernel (Rahimi and Recht, 2007): a function
    from points (n x dims) to features (n x features)."""
    omega, phase = fourier_waves(dims, gamma, features, seed)
    scale = np.sqrt(2.0 / features)
    return lambda points: np.cos(points @ omega + phase) * scale


def fourier_waves(dims: int, gamma: float, features: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and phases of the random features."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, np.sqrt(2 * gamma), (dims, features)), rng.uniform(0.0, 2 * np.pi, features)


def one_class_filter(
    df: DataFrame, columns: Sequence[str], nu: float = 0.01, gamma: str | float = "scale",
    features: int = 128, seed: int = 42, exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Leave out the share `nu` of rows least like the rest; unchanged without columns."""
    if not columns:
        return df
    # only the scores are written for the threshold; rounding keeps them equal when they are computed again
    scored = one_class_scores(df, columns, gamma, features, seed).withColumn("_density", F.round("_density", 12))
    edge = quantiles(durable(scored.select("_density")), ["_density"], [nu], exact_rows)["_density"][0]
    return scored.filter(F.col("_density") >= F.lit(edge)).drop("_density")
