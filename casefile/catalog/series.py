"""Daily series and forecasts."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from casefile.catalog.profile import _daily_sql
from casefile.catalog.registry import query
from casefile.catalog.tables import table
from casefile.operators import forecasting, series as ops
from casefile.operators.evaluation import average_errors, forecast_errors
from casefile.plans import run_timeseries
from casefile.session import durable

NAIVE = ("naive_last", "naive_mean7")
ORDER_SERIES = f"WITH {_daily_sql('orders', 'o_orderdate', 'o_orderstatus', kind='DOUBLE')}"
EVENT_SERIES = f"WITH {_daily_sql('events', 'ts', 'event_type', kind='DOUBLE')}"


def order_series(spark, sf):
    return ops.daily_counts(table(spark, sf, "orders"), ["o_orderstatus"], "o_orderdate", as_of="2030-01-01")


def event_series(spark, sf):
    return ops.daily_counts(table(spark, sf, "events"), ["event_type"], "ts", as_of="2030-01-01")


# The window of plausible dates starts in 2000 and both tables are counted from there.
RECENT = ORDER_SERIES.replace("WHERE true", "WHERE o_orderdate >= TIMESTAMP '2000-01-01'")


@query("w01_last_value", f"{RECENT} SELECT o_orderstatus, arg_max(y, ds) AS yhat FROM series GROUP BY o_orderstatus")
def w01(spark, sf):
    return ops.last_value(order_series(spark, sf), ["o_orderstatus"])


@query(
    "w02_tail_mean",
    f"""
    {RECENT}, r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY ds DESC) AS rn FROM series)
    SELECT o_orderstatus, round(avg(y), 9) AS yhat FROM r WHERE rn <= 7 GROUP BY o_orderstatus
    """,
)
def w02(spark, sf):
    s = ops.with_position(order_series(spark, sf), ["o_orderstatus"])
    ends = s.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("start"))
    return ops.tail_mean(s.join(ends, "o_orderstatus"), ["o_orderstatus"]).withColumn("yhat", F.round("yhat", 9))


@query(
    "w03_lookback_windows",
    f"""
    {RECENT}, r AS (
      SELECT o_orderstatus, ds, y, count(*) OVER w AS n, sum(y) OVER w AS lag_sum, first_value(y) OVER w AS oldest, last_value(y) OVER w AS newest FROM series
      WINDOW w AS (PARTITION BY o_orderstatus ORDER BY ds ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING))
    SELECT o_orderstatus, ds, y, lag_sum, oldest, newest FROM r WHERE n = 60
    """,
)
def w03(spark, sf):
    windows = ops.lookback_windows(order_series(spark, sf), ["o_orderstatus"])
    total = F.aggregate("lags", F.lit(0.0), lambda s, v: s + v)
    return windows.select("o_orderstatus", "ds", "y", total.alias("lag_sum"), F.get("lags", 0).alias("oldest"), F.get("lags", 59).alias("newest"))


@query(
    "w04_cut_by_position",
    f"""
    {RECENT}, r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY ds) - 1 AS pos FROM series)
    SELECT o_orderstatus, ds, y FROM r WHERE pos >= 100 AND pos < 130
    """,
)
def w04(spark, sf):
    return ops.cut_by_position(order_series(spark, sf), ["o_orderstatus"], 100, 130).select("o_orderstatus", "ds", "y")


@query(
    "f08_scale_series",
    f"""
    {RECENT}, s AS (SELECT o_orderstatus, avg(y) AS mu, CASE WHEN stddev_pop(y) > 1e-8 THEN stddev_pop(y) ELSE 1 END AS sd FROM series GROUP BY o_orderstatus)
    SELECT o_orderstatus, ds, round((y - mu) / sd, 9) AS z FROM series JOIN s USING (o_orderstatus)
    """,
)
def f08(spark, sf):
    return ops.scale_series(order_series(spark, sf), ["o_orderstatus"]).select("o_orderstatus", "ds", F.round("z", 9).alias("z"))


def _backtest_sql(source: str, key: str, horizon: int, window: int, points: str) -> str:
    """Naive forecasts of every split, spelled out."""
    return f"""
    {source},
    placed AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ds) - 1 AS pos, count(*) OVER (PARTITION BY {key}) AS n FROM series),
    raw AS (SELECT DISTINCT {key}, n, CAST(floor(unnest({points})) AS INTEGER) AS start FROM placed),
    splits AS (SELECT {key}, start, row_number() OVER (PARTITION BY {key} ORDER BY start) AS split, count(*) OVER (PARTITION BY {key}) AS n_splits FROM raw
               QUALIFY start > 0),
    test AS (SELECT p.{key}, p.ds, p.y, s.split, s.start, s.n_splits FROM placed p JOIN splits s ON p.{key} = s.{key} AND p.pos >= s.start AND p.pos < s.start + {horizon}),
    fit AS (SELECT s.{key}, s.split, 'naive_last' AS model, max(p.y) FILTER (WHERE p.pos = s.start - 1) AS yhat FROM placed p JOIN splits s ON p.{key} = s.{key} GROUP BY ALL
            UNION ALL
            SELECT s.{key}, s.split, 'naive_mean7', avg(p.y) FROM placed p JOIN splits s ON p.{key} = s.{key} AND p.pos >= s.start - 7 AND p.pos < s.start GROUP BY ALL),
    scored AS (SELECT t.*, f.model, f.yhat FROM test t JOIN fit f ON t.{key} = f.{key} AND t.split = f.split),
    metrics AS (
      SELECT {key}, CAST(split AS INTEGER) AS split, model, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) ** 2)) AS rmse,
        100 * avg(abs((y - yhat) / CASE WHEN y = 0 THEN 1 ELSE y END)) AS mape FROM scored GROUP BY ALL)
    """


ORDER_BACKTEST = _backtest_sql(RECENT, "o_orderstatus", 30, 90, "[n - 90, n - 60, n - 30]")
EVENT_BACKTEST = _backtest_sql(EVENT_SERIES, "event_type", 5, 12, "[n - 12, n - 8.5, n - 5]")


def _naive(spark, sf, which: str):
    if which == "orders":
        return forecasting.backtest(order_series(spark, sf), ["o_orderstatus"], models=NAIVE)
    return forecasting.backtest(event_series(spark, sf), ["event_type"], 5, 12, 3, NAIVE)


def _metrics(df):
    return df.select(*[F.round(c, 6).alias(c) if c in ("MAE", "RMSE", "MAPE%") else c for c in df.columns])


def _one_model(name: str):
    return f"""
    {ORDER_BACKTEST}, raw_steps AS (SELECT o_orderstatus, CAST(split AS INTEGER) AS split, ds, yhat FROM scored WHERE model = '{name}')
    SELECT o_orderstatus, split, CAST(row_number() OVER (PARTITION BY o_orderstatus, split ORDER BY ds) AS INTEGER) AS step, round(yhat, 9) AS yhat FROM raw_steps
    """


def _train(spark, sf):
    s = durable(ops.with_position(order_series(spark, sf), ["o_orderstatus"]))
    points = forecasting.rolling_splits(s, ["o_orderstatus"])
    return s.join(points, "o_orderstatus").filter("pos < start").select("o_orderstatus", "split", "start", "pos", "ds", "y")


@query("t01_naive_last", _one_model("naive_last"))
def t01(spark, sf):
    return forecasting.naive_last(_train(spark, sf), ["o_orderstatus", "split"], 30)


@query("t02_naive_mean7", _one_model("naive_mean7"))
def t02(spark, sf):
    return forecasting.naive_mean7(_train(spark, sf), ["o_orderstatus", "split"], 30).withColumn("yhat", F.round("yhat", 9))


@query("t03_seasonal_arima")
def t03(spark, sf):
    return forecasting.seasonal_arima(_train(spark, sf), ["o_orderstatus", "split"], 30)


@query("t04_additive")
def t04(spark, sf):
    return forecasting.additive(_train(spark, sf), ["o_orderstatus", "split"], 30)


_WAVES = ", ".join(
    f"{wave}(date_diff('day', DATE '1970-01-01', ds::DATE) * {2 * math.pi * order / period!r})"
    for period, top in forecasting.SEASONS for order in range(1, top + 1) for wave in ("sin", "cos")
)


@query(
    "t04_normal_equations",
    f"""
    {ORDER_BACKTEST},
    design AS (SELECT p.o_orderstatus, s.split, p.y, [1.0::DOUBLE, p.pos::DOUBLE / s.start, {_WAVES}] AS x
               FROM placed p JOIN splits s ON p.o_orderstatus = s.o_orderstatus AND p.pos < s.start),
    terms AS (SELECT o_orderstatus, split, y, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS j FROM design)
    SELECT o_orderstatus, CAST(split AS INTEGER) AS split, CAST(j AS INTEGER) AS j, round(sum(v * y), 3) + 0.0 AS side FROM terms GROUP BY ALL
    """,
)
def t04_equations(spark, sf):
    """What the fitted coefficients give for each term of the design, shrinkage included, must be what the series itself gives."""
    by = ["o_orderstatus", "split"]
    rows = durable(forecasting.additive_rows(_train(spark, sf), by))
    fitted = rows.join(forecasting.least_squares(rows, by), by)
    fitted = fitted.withColumn("fit", F.aggregate(F.zip_with("x", "beta", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))
    terms = fitted.select(*by, "fit", "beta", F.posexplode("x").alias("j", "v"))
    sides = terms.groupBy(*by, "j").agg(F.sum(F.col("v") * F.col("fit")).alias("side"), F.count(F.lit(1)).alias("n"), F.first(F.get("beta", F.col("j"))).alias("b"))
    shrunk = F.when(F.col("j") > 0, F.col("side") + forecasting.RIDGE * F.col("n") * F.col("b")).otherwise(F.col("side"))
    return sides.select(*by, "j", (F.round(shrunk, 3) + 0.0).alias("side"))


@query("t05_lag_regression")
def t05(spark, sf):
    return forecasting.lag_regression(_train(spark, sf), ["o_orderstatus", "split"], 30)


@query("t06_backtest_metrics", f'{ORDER_BACKTEST} SELECT o_orderstatus, split, model, round(mae, 6) AS "MAE", round(rmse, 6) AS "RMSE", round(mape, 6) AS "MAPE%" FROM metrics')
def t06(spark, sf):
    return _metrics(_naive(spark, sf, "orders")["metrics"])


@query("t06_backtest_metrics_events", f'{EVENT_BACKTEST} SELECT event_type, split, model, round(mae, 6) AS "MAE", round(rmse, 6) AS "RMSE", round(mape, 6) AS "MAPE%" FROM metrics')
def t06_events(spark, sf):
    return _metrics(_naive(spark, sf, "events")["metrics"])


@query(
    "t06_skipped",
    f"""{EVENT_BACKTEST} SELECT event_type, CAST(split AS INTEGER) AS split, 'lstm' AS model,
      '20 days of history are needed, there are ' || CAST(start AS VARCHAR) AS reason FROM splits WHERE start < 20""",
)
def t06_skipped(spark, sf):
    """Series and splits whose history is shorter than the windows of one of two models."""
    return forecasting.backtest(event_series(spark, sf), ["event_type"], 5, 12, 3, ("naive_last", "lstm"), lookback=20)["skipped"]


@query("t06_all_models")
def t06_all(spark, sf):
    return run_timeseries(spark, table(spark, sf, "orders"), keys=["o_orderstatus"], date_col="o_orderdate", as_of="2030-01-01")["metrics_avg"]


@query(
    "a14_forecast_errors",
    f'{ORDER_BACKTEST} SELECT split, model, round(avg(abs(y - yhat)), 6) AS "MAE", round(sqrt(avg((y - yhat) ** 2)), 6) AS "RMSE", '
    'round(100 * avg(abs((y - yhat) / CASE WHEN y = 0 THEN 1 ELSE y END)), 6) AS "MAPE%" FROM scored GROUP BY split, model',
)
def a14(spark, sf):
    train = _train(spark, sf)
    s = ops.with_position(order_series(spark, sf), ["o_orderstatus"])
    points = forecasting.rolling_splits(s, ["o_orderstatus"])
    test = s.join(points, "o_orderstatus").filter("pos >= start and pos < start + 30").withColumn("step", F.expr("pos - start + 1"))
    by = ["o_orderstatus", "split"]
    known = forecasting.forecasters()
    both = None
    for name in NAIVE:
        part = known[name](train, by, 30).withColumn("model", F.lit(name))
        both = part if both is None else both.unionByName(part)
    out = _metrics(forecast_errors(test.join(both, [*by, "step"]), ["split", "model"]))
    return out.withColumn("split", F.col("split").cast("bigint"))


@query(
    "a15_average_errors",
    f'{ORDER_BACKTEST} SELECT model, round(avg(mae), 6) AS "MAE", round(avg(rmse), 6) AS "RMSE", round(avg(mape), 6) AS "MAPE%" FROM metrics GROUP BY model',
)
def a15(spark, sf):
    return _metrics(average_errors(_naive(spark, sf, "orders")["metrics"]))


@query("t07_overlay", f"{ORDER_BACKTEST} SELECT o_orderstatus, ds, model, y, round(yhat, 9) AS yhat FROM scored WHERE split = n_splits")
def t07(spark, sf):
    return forecasting.overlay(_naive(spark, sf, "orders"), ["o_orderstatus"]).withColumn("yhat", F.round("yhat", 9))
