from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from casefile.operators import forecasting, series
from casefile.operators.sampling import rolling_splits
from casefile.plans import run_timeseries
from casefile.session import scratch_folder


@pytest.fixture(scope="module")
def weekly(spark):
    """Two series with trend, weekly pattern and a little noise; 900 days each."""
    rng = np.random.default_rng(1)
    frames = []
    for key, level in (("a", 50.0), ("b", 200.0)):
        t = np.arange(900)
        y = level + 0.05 * t + 8 * np.sin(2 * np.pi * t / 7) + rng.normal(0, 0.5, 900)
        frames.append(pd.DataFrame({"key": key, "ds": pd.date_range("2020-01-01", periods=900), "y": y}))
    return spark.createDataFrame(pd.concat(frames)).withColumn("ds", F.col("ds").cast("date")).repartition(5)


def train_of(df, keys):
    s = series.with_position(df, keys)
    points = rolling_splits(s, keys)
    placed = s.join(points, keys)
    return placed.filter("pos < start").select(*keys, "split", "start", "pos", "ds", "y"), placed


@pytest.mark.parametrize("name", ["sarimax", "prophet", "lstm"])
def test_models_beat_the_naive_ones(weekly, name):
    result = forecasting.backtest(weekly, ["key"], models=["naive_last", name], lookback=28)
    rmse = {(r["key"], r["model"]): r["RMSE"] for r in result["metrics_avg"].collect()}
    for key in "ab":
        assert rmse[key, name] < 0.5 * rmse[key, "naive_last"]
        assert rmse[key, name] < 3.0


def test_direct_regressor(weekly):
    train, _ = train_of(weekly.filter("key = 'a'"), ["key"])
    one = train.filter("split = 1")
    got = forecasting.lag_regression(one, ["key", "split"], 5, 14, GBTRegressor(maxIter=3, maxDepth=3))
    assert sorted(r["step"] for r in got.collect()) == [1, 2, 3, 4, 5]


def test_single_series_without_key(spark, weekly):
    one = weekly.filter("key = 'a'").drop("key")
    result = forecasting.backtest(one, [], models=["naive_last", "naive_mean7", "prophet"])
    assert {r["model"]: 1 for r in result["metrics_avg"].collect()} == {"naive_last": 1, "naive_mean7": 1, "prophet": 1}
    assert result["y_test"].count() == 30 and result["forecasts"].count() == 90
    assert forecasting.overlay(result, []).count() == 90


def test_short_series_is_an_error(spark):
    df = spark.createDataFrame([(pd.Timestamp("2020-01-01").date(), 1.0)], "ds date, y double")
    with pytest.raises(ValueError):
        forecasting.backtest(df, [])


def test_windows_and_scaling(weekly):
    windows = series.lookback_windows(weekly, ["key"], 60)
    assert windows.count() == 2 * 840
    first = windows.filter("key = 'a'").orderBy("ds").first()
    days = weekly.filter("key = 'a'").orderBy("ds").toPandas()["y"].tolist()
    assert first["lags"] == days[:60] and first["y"] == days[60]
    scaled = series.scale_series(weekly, ["key"]).groupBy("key").agg(F.avg("z").alias("m"), F.stddev_pop("z").alias("s")).collect()
    assert all(abs(r["m"]) < 1e-9 and abs(r["s"] - 1) < 1e-9 for r in scaled)
    flat = weekly.withColumn("y", F.lit(3.0))
    assert series.scale_series(flat, ["key"]).filter("z <> 0").count() == 0


def test_run_timeseries_with_and_without_date_column(spark):
    days = pd.date_range("2010-01-01", periods=200)
    rows = pd.DataFrame({"DATE OCC": np.repeat(days.strftime("%m/%d/%Y"), 3), "n": 1})
    df = spark.createDataFrame(rows)
    out = scratch_folder(spark)
    for date_col in (None, "DATE OCC"):
        result = run_timeseries(spark, df, out, date_col=date_col, models=("naive_last", "naive_mean7"))
        assert {r["RMSE"] for r in result["metrics_avg"].collect()} == {0.0}
        assert result["summary"].first()["n"] == 200
    back = spark.read.option("header", True).csv(f"{out}/rolling_metrics")
    assert set(back.columns) == {"split", "model", "MAE", "RMSE", "MAPE%"} and back.count() == 6


def test_failed_and_skipped_models_are_rows(spark, monkeypatch):
    from casefile.operators import forecasting

    known = forecasting.forecasters

    def broken(train, by, horizon):
        raise RuntimeError("out of order\nmore")

    monkeypatch.setattr(forecasting, "forecasters", lambda lookback: {**known(lookback), "broken": broken})
    days = [(k, i, float(i % 7)) for k, n in (("a", 130), ("b", 300)) for i in range(n)]
    df = spark.createDataFrame(days, "key string, i int, y double").selectExpr("key", "date_add(DATE'2021-01-01', i) AS ds", "y")
    found = forecasting.backtest(df, ["key"], models=["naive_last", "broken", "lstm"], lookback=60)
    rows = {(r["key"], r["split"], r["model"]): r["reason"] for r in found["skipped"].collect()}
    assert {k for k in rows if k[2] == "lstm"} == {("a", 1, "lstm")} and rows["a", 1, "lstm"].endswith("there are 40")
    assert len([k for k in rows if k[2] == "broken"]) == 6 and rows["b", 3, "broken"] == "out of order"
    assert found["metrics"].filter("model = 'lstm'").count() == 5


def test_stepwise_forecast_equals_plain_loop(spark):
    from casefile.operators import forecasting

    rng = np.random.default_rng(2)
    y, w, e, beta = (rng.normal(size=n) for n in (8, 8, 8, 7))
    df = spark.createDataFrame([(y.tolist(), w.tolist(), e.tolist(), beta.tolist()), ([1.0, 4.0], [0.0, 0.0], [0.0, 0.0], beta.tolist())], "y array<double>, w array<double>, e array<double>, beta array<double>")
    got = [r[0] for r in df.select(forecasting._stepped(F.col("y"), F.col("w"), F.col("e"), F.col("beta"), 12)).collect()]
    ys, ws, es = list(y), list(w), list(e)
    bound = 1e3 * (1 + max(map(abs, ys)))
    for _ in range(12):
        step = beta @ [1, ws[-1], ws[-7], ws[-8], es[-1], es[-7], es[-8]]
        ws.append(float(np.clip(step, -bound, bound)))
        es.append(0.0)
        ys.append(ys[-1] + ys[-7] - ys[-8] + ws[-1])
    assert np.allclose(got[0], ys[8:]) and got[1] == [4.0] * 12
