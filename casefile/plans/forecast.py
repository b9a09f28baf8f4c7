"""From a table of records to backtested daily forecasts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from casefile.config import ForecastConfig
from casefile.operators.forecasting import backtest, overlay
from casefile.operators.series import daily_counts, series_summary
from casefile.session import durable
from casefile.sources import load_table, save_result_csv


def run_timeseries(
    spark: SparkSession, source: DataFrame | str, out_dir: str | None = None, keys: Sequence[str] = (),
    date_col: str | None = None, as_of=None, config: ForecastConfig | None = None, **overrides,
) -> dict[str, DataFrame]:
    """Count per day, backtest every model, and, with `out_dir`, write the metrics.

    `keys` makes one series per key; without them there is one series.
    """
    config = replace(config or ForecastConfig(), **overrides)
    series = durable(daily_counts(load_table(spark, source), keys, date_col, as_of))
    result = backtest(series, keys, config.horizon, config.eval_days, config.rolling_splits, config.models, config.lookback)
    result["summary"] = series_summary(series, keys)
    result["overlay"] = overlay(result, keys)
    if out_dir:
        root = out_dir.rstrip("/")
        save_result_csv(result["metrics"], f"{root}/rolling_metrics")
        save_result_csv(result["metrics_avg"], f"{root}/rolling_metrics_avg")
    return result
