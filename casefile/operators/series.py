"""Daily series per key: counting, gap filling, positions, windows of past values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casefile.functions.values import col
from casefile.operators.cleaning import filter_date_range_or_widen
from casefile.operators.schema import choose_date_column
from casefile.functions import dates


def fill_days(counts: DataFrame, keys: Sequence[str], day: str = "ds", value: str = "y") -> DataFrame:
    """Every day from the first to the last of each key; absent days get 0.

    Each counted day brings along the empty days up to the next one, so the table
    behind the counts is read once. A key has at most as many rows as the calendar
    has days.
    """
    groups = [col(k) for k in keys]
    following = F.lead(col(day)).over(Window.partitionBy(*(groups or [F.lit(0)])).orderBy(day))
    until = F.coalesce(F.date_sub(following, 1), col(day))
    dated = counts.filter(col(day).isNotNull())
    days = dated.withColumn("_until", until).withColumn("_day", F.explode(F.sequence(col(day), F.col("_until"))))
    zero = F.lit(0).cast(counts.schema[value].dataType)
    counted = F.when(F.col("_day") == col(day), col(value)).otherwise(zero)
    return days.select(*groups, F.col("_day").alias(day), counted.alias(value))


def count_per_day(df: DataFrame, ts: F.Column, keys: Sequence[str] = (), day: str = "ds", value: str = "y") -> DataFrame:
    """Rows per key and day, gaps filled with 0. Counting happens before the shuffle."""
    dated = df.filter(ts.isNotNull())
    counts = dated.groupBy(*[col(k) for k in keys], ts.cast("date").alias(day)).agg(F.count(F.lit(1)).alias(value))
    return fill_days(counts, keys, day, value)


def daily_counts(df: DataFrame, keys: Sequence[str] = (), date_col: str | None = None, as_of=None) -> DataFrame:
    """Daily series (keys..., ds date, y double) from the given or the best date
    column, inside the first date window that holds rows."""
    ts = dates.parse_date(df, date_col) if date_col else choose_date_column(df, as_of)[1]
    narrow = df.select(*[col(k) for k in keys], ts.alias("_ts"))
    kept = filter_date_range_or_widen(narrow, F.col("_ts"), as_of)
    return count_per_day(kept, F.col("_ts"), keys).withColumn("y", F.col("y").cast("double"))


def series_summary(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """First and last day, length, mean, sample deviation and zero days per key."""
    return series.groupBy(*[col(k) for k in keys]).agg(
        F.min("ds").alias("first_day"),
        F.max("ds").alias("last_day"),
        F.count(F.lit(1)).alias("n"),
        F.avg("y").alias("mean"),
        F.stddev_samp("y").alias("sd"),
        F.count_if(F.col("y") == 0).alias("zero_days"),
    )


def with_position(series: DataFrame, keys: Sequence[str], name: str = "pos") -> DataFrame:
    """0-based day number inside each series; gap-free series need no sort for it."""
    groups = [col(k) for k in keys]
    starts = series.groupBy(*groups).agg(F.min("ds").alias("_first"))
    if keys:
        joined = series.join(starts, list(keys))
    else:
        first = starts.first()["_first"]
        joined = series.withColumn("_first", F.lit(first))
    return joined.withColumn(name, F.date_diff("ds", "_first")).drop("_first")


def cut_by_position(series: DataFrame, keys: Sequence[str], start: int, stop: int) -> DataFrame:
    """Days [start, stop) of each series."""
    return with_position(series, keys, "_pos").filter(F.col("_pos").between(start, stop - 1)).drop("_pos")


def last_value(train: DataFrame, by: Sequence[str]) -> DataFrame:
    return train.groupBy(*[col(b) for b in by]).agg(F.max_by("y", "ds").alias("yhat"))


def tail_mean(train: DataFrame, by: Sequence[str], days: int = 7) -> DataFrame:
    """Mean of the last days; `pos` and `start` say how far a day is from the end."""
    recent = train.filter(F.col("pos") >= F.col("start") - days)
    return recent.groupBy(*[col(b) for b in by]).agg(F.avg("y").alias("yhat"))


def lookback_windows(series: DataFrame, keys: Sequence[str], lookback: int = 60, value: str = "y") -> DataFrame:
    """Each day with the array `lags` of the `lookback` values before it, oldest first;
    days without a full window are left out."""
    past = Window.partitionBy(*[col(k) for k in keys]).orderBy("ds").rowsBetween(-lookback, -1)
    out = series.withColumn("lags", F.collect_list(col(value)).over(past))
    return out.filter(F.size("lags") == lookback)


def scale_series(series: DataFrame, by: Sequence[str]) -> DataFrame:
    """z-scores `z` of each series with its `mu` and population `sd` (tiny ones count as 1)."""
    stats = series.groupBy(*[col(b) for b in by]).agg(F.avg("y").alias("mu"), F.stddev_pop("y").alias("_sd"))
    stats = stats.withColumn("sd", F.when(F.col("_sd") > 1e-8, F.col("_sd")).otherwise(1.0)).drop("_sd")
    if by:
        joined = series.join(stats, list(by))
    else:
        mu, sd = stats.first()
        joined = series.withColumn("mu", F.lit(mu)).withColumn("sd", F.lit(sd))
    return joined.withColumn("z", (F.col("y") - F.col("mu")) / F.col("sd"))
