"""Forecasters that work on many series and splits at once.

Input of each is a training table (keys..., split, start, pos, ds, y); output is
(keys..., split, step, yhat) with step = 1..horizon.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casefile.functions.values import col
from casefile.operators.evaluation import average_errors, forecast_errors
from casefile.operators.sampling import rolling_splits
from casefile.operators.series import last_value, lookback_windows, scale_series, tail_mean, with_position
from casefile.session import durable

# Seasonal periods (days) and Fourier orders of the additive model.
SEASONS = ((7.0, 3), (365.25, 10))
RIDGE = 1e-3
SEASON_DAYS = 7
AR_LAGS = 14


def _repeat(level: DataFrame, horizon: int) -> DataFrame:
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    return level.select(*[c for c in level.columns if c != "yhat"], steps, "yhat")


def naive_last(train: DataFrame, by: Sequence[str], horizon: int) -> DataFrame:
    return _repeat(last_value(train, by), horizon)


def naive_mean7(train: DataFrame, by: Sequence[str], horizon: int) -> DataFrame:
    return _repeat(tail_mean(train, by, 7), horizon)


def _dot(features: F.Column, weights: F.Column) -> F.Column:
    return F.aggregate(F.zip_with(features, weights, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def least_squares(rows: DataFrame, by: Sequence[str], ridge: float = RIDGE) -> DataFrame:
    """Coefficients `beta` of y on the array `x` per group.

    A group is one series up to one split: never longer than the calendar. The
    first feature is the intercept and is not shrunk.
    """

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        x, y = np.stack(group["x"].to_numpy()), group["target"].to_numpy()
        penalty = ridge * len(y) * np.eye(x.shape[1])
        penalty[0, 0] = 0.0
        beta, *_ = np.linalg.lstsq(x.T @ x + penalty, x.T @ y, rcond=None)
        return group[list(by)].head(1).assign(beta=[beta])

    keys = rows.select(*[col(b) for b in by])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields) + ", beta array<double>"
    return rows.select(*[col(b) for b in by], "x", "target").groupBy(*[col(b) for b in by]).applyInPandas(solve, schema)


def additive_design(t: F.Column, day: F.Column, length: F.Column) -> F.Column:
    """Intercept, trend over the length of the history, and the waves of all seasons at a day."""
    number = F.date_diff(day, F.lit("1970-01-01").cast("date")).cast("double")
    waves = [
        wave(number * (2 * math.pi * order / period))
        for period, top in SEASONS
        for order in range(1, top + 1)
        for wave in (F.sin, F.cos)
    ]
    return F.array(F.lit(1.0), t / length, *waves)


def additive_rows(train: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., x, target): one row of the additive model's design for each day."""
    x = additive_design(F.col("pos").cast("double"), F.col("ds"), F.col("start").cast("double"))
    return train.select(*[col(b) for b in by], x.alias("x"), F.col("y").alias("target"))


def additive(train: DataFrame, by: Sequence[str], horizon: int) -> DataFrame:
    """Linear trend plus weekly and yearly Fourier terms, fitted by ridge regression."""
    beta = least_squares(additive_rows(train, by), by)
    ends = train.groupBy(*[col(b) for b in by]).agg(F.max("ds").alias("_last"), F.max("start").alias("start"))
    future = ends.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    x = additive_design(
        (F.col("start") + F.col("step") - 1).cast("double"), F.date_add("_last", F.col("step")), F.col("start").cast("double")
    )
    return future.join(beta, list(by)).select(*[col(b) for b in by], "step", _dot(x, F.col("beta")).alias("yhat"))


def seasonal_arima(train: DataFrame, by: Sequence[str], horizon: int) -> DataFrame:
    """(1,1,1)(1,1,1,7) by two regressions (Hannan and Rissanen, 1982).

    The series is differenced at lags 1 and 7; a long autoregression estimates the
    shocks; the differenced series is then regressed on its own lags 1, 7, 8 and on
    the shocks at those lags. Lags are window expressions; only the small solves
    and the step-by-step forecast run per group.
    """
    groups = [col(b) for b in by]
    order = Window.partitionBy(*groups).orderBy("pos")
    s = SEASON_DAYS

    def lag(name: str, k: int) -> F.Column:
        return F.lag(name, k).over(order)

    w = F.col("y") - lag("y", 1) - lag("y", s) + lag("y", s + 1)
    rows = train.select(*groups, "pos", "y", w.alias("w"))
    past = [lag("w", k).alias(f"w{k}") for k in range(1, AR_LAGS + 1)]
    rows = rows.select(*groups, "pos", "y", "w", *past)
    full = F.col(f"w{AR_LAGS}").isNotNull()
    own = F.array(F.lit(1.0), *[F.col(f"w{k}") for k in range(1, AR_LAGS + 1)])
    rows = durable(rows.withColumn("x", F.when(full, own)).select(*groups, "pos", "y", "w", "w1", f"w{s}", f"w{s + 1}", "x"))
    long_ar = least_squares(rows.filter(F.col("x").isNotNull()).withColumn("target", F.col("w")), by, 1e-6)
    shocks = rows.join(long_ar, list(by)).withColumn("e", F.when(F.col("x").isNotNull(), F.col("w") - _dot(F.col("x"), F.col("beta"))))
    lags = [lag("e", k).alias(f"e{k}") for k in (1, s, s + 1)]
    shocks = shocks.select(*groups, "pos", "y", "w", "e", "w1", f"w{s}", f"w{s + 1}", *lags)
    regressors = [F.lit(1.0), F.col("w1"), F.col(f"w{s}"), F.col(f"w{s + 1}"), F.col("e1"), F.col(f"e{s}"), F.col(f"e{s + 1}")]
    ready = shocks.filter(F.col(f"e{s + 1}").isNotNull()).select(*groups, F.array(*regressors).alias("x"), F.col("w").alias("target"))
    beta = least_squares(ready, by, 1e-6)
    # what the forecast needs of the past: the last days of each series
    recent = shocks.join(train.groupBy(*groups).agg(F.max("pos").alias("_end")), list(by)).filter(F.col("pos") > F.col("_end") - s - 1)
    tail = recent.groupBy(*groups).agg(
        F.array_sort(F.collect_list(F.struct("pos", "y", F.coalesce("w", F.lit(0.0)).alias("w"), F.coalesce("e", F.lit(0.0)).alias("e")))).alias("tail")
    )
    state = tail.select(*groups, *[F.col(f"tail.{f}").alias(f) for f in ("y", "w", "e")]).join(beta, list(by))

    path = state.select(*groups, F.posexplode(_stepped(state["y"], state["w"], state["e"], state["beta"], horizon)).alias("_at", "yhat"))
    return path.select(*groups, (F.col("_at") + 1).alias("step"), "yhat")


def _stepped(y: F.Column, w: F.Column, e: F.Column, beta: F.Column, horizon: int) -> F.Column:
    """The forecast path from the last days of a series: future shocks are zero, differences are undone.

    A column expression over the `SEASON_DAYS` + 1 last values of each; shorter series go on as they ended.
    """
    kept = SEASON_DAYS + 1

    def pushed(window: F.Column, value: F.Column) -> F.Column:
        return F.concat(F.slice(window, 2, kept - 1), F.array(value))

    def ago(window: F.Column, k: int) -> F.Column:
        return F.get(window, kept - k)

    bound = 1e3 * (1.0 + F.array_max(F.transform(y, F.abs)))
    start = F.struct(y.alias("y"), w.alias("w"), e.alias("e"), F.array().cast("array<double>").alias("path"))

    def step(state: F.Column, _: F.Column) -> F.Column:
        lags = [ago(state[n], k) for n in ("w", "e") for k in (1, SEASON_DAYS, kept)]
        move = _dot(F.array(F.lit(1.0), *lags), beta)
        move = F.greatest(F.least(move, bound), -bound)
        value = ago(state["y"], 1) + ago(state["y"], SEASON_DAYS) - ago(state["y"], kept) + move
        return F.struct(
            pushed(state["y"], value).alias("y"), pushed(state["w"], move).alias("w"), pushed(state["e"], F.lit(0.0)).alias("e"),
            F.concat(state["path"], F.array(value)).alias("path"),
        )

    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step)["path"]
    return F.when(F.size(y) == kept, path).otherwise(F.array_repeat(F.element_at(y, -1), horizon))


def lag_regression(train: DataFrame, by: Sequence[str], horizon: int, lookback: int = 60, estimator=None) -> DataFrame:
    """One regressor over all series of a split, from z-scaled windows of past values.

    Training rows are (window, next value). The forecast feeds each prediction back
    into the window; with the default linear model a step is one dot product, so
    the whole recursion stays a column expression. Any other regressor is trained
    on (window, step) and predicts every step directly.
    """
    scaled = scale_series(train, by)
    windows = durable(lookback_windows(scaled, by, lookback, "z"))  # read once for each split
    recent = scaled.filter(F.col("pos") >= F.col("start") - lookback)
    newest = recent.groupBy(*[col(b) for b in by]).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "z"))), lambda r: r["z"]).alias("lags"),
        F.first("mu").alias("mu"),
        F.first("sd").alias("sd"),
    ).filter(F.size("lags") == lookback)
    parts = []
    for (split,) in sorted(windows.select("split").distinct().collect()):
        mine, now = windows.filter(F.col("split") == split), newest.filter(F.col("split") == split)
        if estimator is None:
            rows = mine.select(array_to_vector("lags").alias("features"), F.col("z").alias("label"))
            model = LinearRegression(regParam=0.05, elasticNetParam=0.0, standardization=False).fit(rows)
            weights = F.array(*[F.lit(float(v)) for v in model.coefficients])
            future = _feed_back(now, by, weights, float(model.intercept), horizon)
        else:
            future = _direct(mine, now, by, estimator, horizon)
        parts.append(future)
    if not parts:
        return train.select(*[col(b) for b in by], F.lit(1).alias("step"), F.col("y").alias("yhat")).limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _feed_back(now: DataFrame, by, weights: F.Column, intercept: float, horizon: int) -> DataFrame:
    start = F.struct(F.col("lags").alias("window"), F.array().cast("array<double>").alias("path"))

    def step(state, _):
        value = _dot(state["window"], weights) + intercept
        window = F.concat(F.slice(state["window"], 2, F.size(state["window"]) - 1), F.array(value))
        return F.struct(window.alias("window"), F.concat(state["path"], F.array(value)).alias("path"))

    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step)["path"]
    rows = now.select(*[col(b) for b in by], "mu", "sd", F.posexplode(path).alias("_at", "_z"))
    return rows.select(*[col(b) for b in by], (F.col("_at") + 1).alias("step"), (F.col("_z") * F.col("sd") + F.col("mu")).alias("yhat"))


def _direct(mine: DataFrame, now: DataFrame, by, estimator, horizon: int) -> DataFrame:
    groups = [col(b) for b in by]
    following = Window.partitionBy(*groups).orderBy("ds").rowsBetween(0, horizon - 1)
    rows = mine.withColumn("_next", F.collect_list("z").over(following)).select(
        array_to_vector("lags").alias("_window"), F.posexplode("_next").alias("_at", "label")
    )
    rows = rows.withColumn("_step", (F.col("_at") + 1).cast("double"))
    assemble = VectorAssembler(inputCols=["_window", "_step"], outputCol="features")
    model = estimator.fit(assemble.transform(rows).select("features", "label"))
    future = now.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    future = future.withColumn("_window", array_to_vector("lags")).withColumn("_step", F.col("step").cast("double"))
    scored = model.transform(assemble.transform(future))
    return scored.select(*groups, "step", (F.col("prediction") * F.col("sd") + F.col("mu")).alias("yhat"))


def forecasters(lookback: int = 60) -> dict:
    return {
        "naive_last": naive_last,
        "naive_mean7": naive_mean7,
        "sarimax": seasonal_arima,
        "prophet": additive,
        "lstm": lambda train, by, horizon: lag_regression(train, by, horizon, lookback),
    }


def backtest(
    series: DataFrame, keys: Sequence[str], horizon: int = 30, eval_days: int = 90, splits: int = 3,
    models: Sequence[str] = ("naive_last", "naive_mean7"), lookback: int = 60,
) -> dict[str, DataFrame]:
    """Rolling-origin evaluation of every model on every series and split.

    Returns `metrics` (per key, split and model), `metrics_avg` (per key and model),
    of each series' last split `forecasts` and the actuals `y_test`, and `skipped`: a row with the
    reason for every series and split that a model gave no forecast for. A model that fails is
    left out with its error for all of them.
    """
    series = durable(with_position(series, keys))
    points = durable(rolling_splits(series, keys, horizon, eval_days, splits))
    if points.isEmpty():
        raise ValueError("every series is too short for the evaluation window")
    # a handful of rows per series meet each of its days; those of a single series are written into the plan
    if keys:
        placed = series.join(points, list(keys))
    else:
        fixed = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in row.asDict().items()]) for row in points.collect()])
        placed = series.withColumn("_at", F.explode(fixed)).select(*series.columns, "_at.*")
    by = [*keys, "split"]
    train = placed.filter(F.col("pos") < F.col("start")).select(*[col(b) for b in by], "start", "pos", "ds", "y")
    test = placed.filter((F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("start") + horizon)).select(
        *[col(b) for b in by], "n_splits", "ds", (F.col("pos") - F.col("start") + 1).alias("step"), "y"
    )
    known = forecasters(lookback)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in train.select(*[col(b) for b in by]).schema.fields)
    predicted = series.sparkSession.createDataFrame([], f"{fields}, step int, yhat double, model string")
    errors = {}
    for name in models:
        try:
            predicted = predicted.unionByName(durable(known[name](train, by, horizon).withColumn("model", F.lit(name))))
        except Exception as error:  # noqa: BLE001 - a failed model is a reason in the result
            errors[name] = str(error).splitlines()[0]
    scored = durable(test.join(predicted, [*by, "step"]))
    metrics = forecast_errors(scored, [*by, "model"])
    newest = scored.filter(F.col("split") == F.col("n_splits"))
    return {
        "metrics": metrics,
        "metrics_avg": average_errors(metrics, [*keys, "model"]),
        "forecasts": newest.select(*[col(k) for k in keys], "model", "ds", "yhat"),
        "y_test": test.filter(F.col("split") == F.col("n_splits")).select(*[col(k) for k in keys], "ds", "y"),
        "skipped": _skipped(points, predicted, by, models, errors, lookback),
    }


def _skipped(points: DataFrame, predicted: DataFrame, by: Sequence[str], models: Sequence[str], errors: dict[str, str], lookback: int) -> DataFrame:
    wanted = points.select(*[col(b) for b in by], "start", F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    missing_ones = wanted.join(predicted.select(*[col(b) for b in by], "model").distinct(), [*by, "model"], "left_anti")
    reason = F.when(
        (F.col("model") == "lstm") & (F.col("start") < lookback), F.concat(F.lit(f"{lookback} days of history are needed, there are "), F.col("start").cast("string"))
    ).otherwise("no forecast")
    for name, error in errors.items():
        reason = F.when(F.col("model") == name, F.lit(error)).otherwise(reason)
    return missing_ones.select(*[col(b) for b in by], "model", reason.alias("reason"))


def overlay(result: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Actuals of the last split next to the forecast of every model."""
    return result["y_test"].join(result["forecasts"], [*keys, "ds"]).select(*[col(k) for k in keys], "ds", "model", "y", "yhat")
