"""From a raw table to a cleaned one, with its profile."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.config import TOP_CATEGORY_COLUMNS, EdaConfig
from casefile.functions import dates
from casefile.functions.hexgrid import add_hex_cell
from casefile.functions.values import col, nan_to_null, present_number
from casefile.operators import cleaning, profiling, schema
from casefile.operators.series import count_per_day
from casefile.session import stored, stored_with
from casefile.sources import load_table, save_table
from casefile.sources.tables import PARQUET_SUFFIX

CALENDAR_COLUMNS = ("year", "month", "weekday", "hour", "is_weekend", "is_holiday")


def _flag_checks(df: DataFrame, config: EdaConfig) -> tuple[list[str], list[F.Column]]:
    """Numeric columns that may be bounded, and whether each holds nothing but 0 and 1."""
    numeric = schema.split_by_kind(df)[0]
    if config.clip_calendar_columns:
        return numeric, []
    numeric = [c for c in numeric if c not in CALENDAR_COLUMNS]
    return numeric, [F.bool_and(F.coalesce(present_number(df, c).isin(0.0, 1.0), F.lit(True))).alias(f"flag{i}") for i, c in enumerate(numeric)]


def outlier_columns(df: DataFrame, config: EdaConfig) -> list[str]:
    """Numeric columns to bound. Calendar columns and 0/1 flags stay out, since the
    clip would wipe a rare flag; `clip_calendar_columns` takes all of them in."""
    numeric, checks = _flag_checks(df, config)
    flags = df.agg(*checks).first().asDict() if checks else {}
    return [c for i, c in enumerate(numeric) if not flags.get(f"flag{i}")]


def clean(raw: DataFrame, config: EdaConfig = EdaConfig(), as_of=None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The cleaned table, and the tables looked at on the way (time pivots, issues).

    The source is read twice: to choose the date column, and to write the dated rows. All else
    reads these; what types and flags need is collected while the distinct rows are written.
    """
    _, ts = schema.choose_date_column(raw, as_of)
    dated = cleaning.filter_date_range(raw.withColumn("_ts", ts), F.col("_ts"), as_of=as_of)
    df = dated.withColumn("date_dt", F.col("_ts")).withColumn("date", dates.midnight(F.col("_ts")))
    for name, expr in dates.calendar_columns(F.col("_ts")).items():
        df = df.withColumn(name, expr)
    df = schema.normalize_columns(df.drop("_ts"))
    df, dt_col = schema.infer_datetime_columns(df)
    df = stored(nan_to_null(dates.add_time_features(df, dt_col, config.use_us_holidays)))
    lat, lon = schema.coordinate_columns(df)
    seen = {
        "hour_day": profiling.hour_day_pivot(df),
        "calendar": count_per_day(df, col("date")),
        "coordinate_issues": cleaning.coordinate_issues(df, lat, lon),
    }
    if config.add_hex:
        df = add_hex_cell(df, lat, lon, config.hex_size_m)
    narrow, stats = schema.downcast_stats(df)
    numeric, checks = _flag_checks(df, config)
    df, found = stored_with(cleaning.deduplicate(df), [*stats, *checks])
    df = schema.downcast_by(df, narrow, found)
    columns = [c for i, c in enumerate(numeric) if not found.get(f"flag{i}")]
    if config.iqr_clip:
        df = cleaning.iqr_clip(df, columns, config.iqr_multiplier)
    if config.zscore_winsor:
        df = cleaning.zscore_winsorize(df, columns, config.zscore_max)
    if config.drop_any_missing:
        df = cleaning.drop_missing(df)
    if config.one_class_filter:
        df = cleaning.one_class_filter(df, columns, config.one_class_nu, config.one_class_gamma)
    return df, seen


def profile(df: DataFrame) -> dict[str, DataFrame]:
    """Profile tables of all rows."""
    return {
        "missingness": profiling.missingness(df),
        "histograms": profiling.numeric_histograms(df),
        "top_categories": profiling.top_categories_of(df, TOP_CATEGORY_COLUMNS),
        "association": profiling.mixed_association(df),
    }


def run_eda(
    spark: SparkSession, source: DataFrame | str, out_path: str | None = None, config: EdaConfig | None = None, as_of=None,
    key=None, **overrides,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Clean a table, profile it and, with `out_path`, write it. Returns the cleaned
    table and the profile tables."""
    config = replace(config or EdaConfig(), **overrides)
    cleaned, seen = clean(load_table(spark, source), config, as_of)
    if out_path and out_path.lower().rstrip("/").endswith(PARQUET_SUFFIX):
        cleaned = load_table(spark, save_table(cleaned, out_path))
    else:
        cleaned = stored(cleaned)
        if out_path:
            save_table(cleaned, out_path)
    return cleaned, {**seen, **profile(cleaned)}
