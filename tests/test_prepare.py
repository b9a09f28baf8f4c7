from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pandas.tseries.holiday import USFederalHolidayCalendar
from pyspark.sql import functions as F

from casefile.config import EdaConfig, MLConfig
from casefile.functions import dates, hexgrid
from casefile.functions.values import linspace, nan_to_null, safe_file_name
from casefile.operators import cleaning, schema
from casefile.operators.quantiles import quantiles
from casefile.session import scratch_folder
from casefile.sources import demo_blobs, load_table, save_records_json, save_table


def column(df, name):
    return [r[name] for r in df.collect()]


# ---- sources ----------------------------------------------------------------


@pytest.mark.parametrize("suffix", [".parquet", ".csv", ".csv.gz", ".csv.bz2"])
def test_save_and_load(spark, suffix):
    df = spark.createDataFrame([(1, "a", 1.5), (2, "b", None)], "k int, t string, x double")
    back = load_table(spark, save_table(df, scratch_folder(spark) + suffix))
    assert sorted(back.collect(), key=lambda r: r["k"]) == df.collect()


def test_unknown_suffix_and_missing_file(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        save_table(df, "x.feather")
    with pytest.raises(ValueError):
        load_table(spark, "x.txt")
    with pytest.raises(Exception):
        load_table(spark, "/not/there.parquet")
    assert load_table(spark, df) is df


def test_private_columns_are_not_written(spark):
    path = save_records_json(spark.createDataFrame([(1, 2)], "a int, _b int"), scratch_folder(spark))
    assert spark.read.json(path).columns == ["a"]


def test_blobs_do_not_depend_on_partitions(spark):
    one = demo_blobs(spark, 200)
    assert one.columns[:2] == ["id", "feature_0"] and len(one.columns) == 14
    assert sorted(one.collect()) == sorted(demo_blobs(spark, 200).repartition(7).collect())
    assert {r["status"] for r in one.collect()} == {"Active", "Inactive", "Pending"}


# ---- schema -----------------------------------------------------------------


def test_normalized_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a--b!", " DATE OCC ", "Crm Cd 1"])
    assert schema.normalize_columns(df).columns == ["a_b_", "date_occ", "crm_cd_1"]
    with pytest.raises(ValueError):
        schema.normalize_columns(spark.createDataFrame([(1, 2)], ["a b", "A_B"]))


def test_kinds_and_constants(spark):
    df = spark.createDataFrame([(1, True, "x", 1.0, None), (2, False, "x", float("nan"), None)], "n int, b boolean, s string, f double, z string")
    assert schema.split_by_kind(df) == (["n", "f"], ["b", "s", "z"])
    assert schema.split_by_kind(df, bool_as_numeric=True)[0] == ["n", "b", "f"]
    assert schema.constant_columns(df) == ["s", "f", "z"]


def test_downcast(spark):
    df = spark.createDataFrame([(1, 100_000, 0.5, 0.1), (2, 2, None, 0.2)], "a long, b long, c double, d double")
    small = schema.downcast_numeric(df)
    assert [f.dataType.simpleString() for f in small.schema] == ["tinyint", "int", "float", "double"]
    assert [tuple(r) for r in small.collect()] == [tuple(r) for r in df.collect()]


def test_epoch_units_from_data(spark):
    day = 86_400
    df = spark.createDataFrame([(1_700_000_000 + i * day, (1_700_000_000 + i * day) * 1000.0, i) for i in range(20)], "s long, ms double, small long")
    # tiny numbers look like 1970 in both units; seconds stay unless milliseconds are better
    assert dates.epoch_units(df, ["s", "ms", "small"]) == {"s": "s", "ms": "ms", "small": "s"}


def test_hhmm(spark):
    df = spark.createDataFrame([("12.0",), ("945",), (None,), ("13:05",), ("99999",)], "t string")
    assert [r[0] for r in df.select(dates.hhmm_text(df, "t")).collect()] == ["0012", "0945", "0000", "1305", "9999"]
    df = df.withColumn("d", F.lit("2024-01-06"))
    got = [r[0] for r in df.select(dates.combine_date_time(df, "d", "t")).collect()]
    assert got == [dt.datetime(2024, 1, 6, h, m) for h, m in ((0, 12), (9, 45), (0, 0), (13, 5), (23, 59))]


def test_bad_text_is_null(spark):
    df = spark.createDataFrame([("garbage",), ("2024-02-30",), ("01/31/2024 11:30:00 PM",), ("01/31/2024",), ("2024-01-31T05:06:07",)], "t string")
    got = [r[0] for r in df.select(dates.parse_date(df, "t")).collect()]
    assert got == [None, None, dt.datetime(2024, 1, 31, 23, 30), dt.datetime(2024, 1, 31), dt.datetime(2024, 1, 31, 5, 6, 7)]


def test_calendar_of_a_saturday(spark):
    df = spark.createDataFrame([("2024-01-06 13:05:00",)], "t string")
    row = dates.add_time_features(df, "t").first()
    assert (row["weekday"], row["hour"], row["is_weekend"], row["is_holiday"]) == (5, 13, 1, 0)


def test_holidays_match_pandas(spark):
    ours = {r["day"] for r in dates.holiday_calendar(spark, 2021, 2030).collect()}
    known = {d.date() for d in USFederalHolidayCalendar().holidays("2021-01-01", "2030-12-31")}
    assert ours == known


def test_holidays_without_shift(spark):
    days = {r["day"] for r in dates.holiday_calendar(spark, 2021, 2021, "actual").collect()}
    assert dt.date(2021, 12, 25) in days and dt.date(2021, 12, 24) not in days


def test_best_date_column_penalty_and_error(spark):
    rows = [("2024-01-01", f"20{10 + i % 10}-05-0{1 + i % 9}") for i in range(30)]
    df = spark.createDataFrame(rows, "date_occ string, date_rptd string")
    assert schema.choose_date_column(df, "2025-01-01")[0] == "date_rptd"
    with pytest.raises(ValueError):
        schema.choose_date_column(spark.createDataFrame([("x",)], "word string"))


def test_infer_datetime_column(spark):
    assert schema.infer_datetime_column(spark.createDataFrame([("x", "2020-01-01")], "a string, date_dt string")) == "date_dt"
    with pytest.raises(ValueError):
        schema.infer_datetime_column(spark.createDataFrame([("x", "y")], "a string, b string"))


def test_hex_cells_cover_the_plane(spark):
    """Every point lies within one edge length of the centre of its cell."""
    rng = np.random.default_rng(0)
    pts = [(float(a), float(b)) for a, b in zip(rng.uniform(33, 35, 300), rng.uniform(-119, -117, 300))]
    df = hexgrid.add_hex_cell(spark.createDataFrame([*pts, (None, 1.0)], "lat double, lon double"), "lat", "lon", 1000.0)
    for r in df.collect():
        if r["lat"] is None:
            assert r["hex"] is None
            continue
        q, s = map(int, r["hex"].split(":"))
        cx, cy = 1000 * (np.sqrt(3) * q + np.sqrt(3) / 2 * s), 1000 * 1.5 * s
        x = r["lon"] * np.cos(np.radians(34.0)) * hexgrid.METRES_PER_DEGREE
        y = r["lat"] * hexgrid.METRES_PER_DEGREE
        assert np.hypot(x - cx, y - cy) <= 1000 + 1e-6
    assert hexgrid.add_hex_cell(df.drop("hex"), None, "lon").columns == ["lat", "lon"]


# ---- cleaning ---------------------------------------------------------------


def test_missing_coordinates_count_as_outside(spark):
    df = spark.createDataFrame([(None, -118.0), (34.0, -118.0), (50.0, -118.0)], "lat double, lon double")
    assert {r["issue"]: r["count"] for r in cleaning.coordinate_issues(df, "lat", "lon").collect()} == {cleaning.ISSUE_OUTSIDE: 2}
    assert cleaning.coordinate_issues(df, None, "lon").count() == 0


def test_date_windows(spark):
    df = spark.createDataFrame([("1992-01-01",), ("1980-01-01",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert cleaning.filter_date_range_or_widen(df, F.col("t"), "2024-01-01").count() == 1
    assert cleaning.filter_date_range_or_widen(df, F.col("t"), "1985-01-01").count() == 2
    with pytest.raises(ValueError):
        cleaning.filter_date_range_or_widen(df.filter("false"), F.col("t"))


def test_iqr_clip_matches_pandas_and_keeps_nulls(spark):
    values = [1.0, 2.0, 3.0, 10.0, 100.0, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    clean = pd.Series([v for v in values if v is not None]).dropna()
    q1, q3 = clean.quantile(0.25), clean.quantile(0.75)
    want = clean.clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)).tolist()
    got = column(cleaning.iqr_clip(df, ["x"]), "x")
    assert got == [*want, None, None]
    # beyond the bound of the built-in percentile the result is the same
    assert column(cleaning.iqr_clip(df, ["x"], exact_rows=2), "x") == got


def test_clip_is_idempotent_enough(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(1e6,)], "x double")
    once = cleaning.iqr_clip(df, ["x"])
    assert max(column(once, "x")) < 1000
    assert column(cleaning.iqr_clip(once, ["x"]), "x") == column(once, "x")


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_quantiles_by_narrowing(spark, seed):
    """The path for large tables, forced on a small one, with heavy ties."""
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(size=700), np.zeros(1500), rng.exponential(1e6, 300)])
    y = rng.integers(0, 4, len(x)).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y})).repartition(3)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = quantiles(df, ["x", "y"], probs, exact_rows=20)
    assert got["x"] == pytest.approx(np.quantile(x, probs).tolist(), rel=1e-12)
    assert got["y"] == pytest.approx(np.quantile(y, probs).tolist(), rel=1e-12)
    assert quantiles(df.filter("false"), ["x"], [0.5]) == {"x": [None]}


def test_winsorize_constant_and_outlier(spark):
    df = spark.createDataFrame([(5.0, float(i)) for i in range(50)] + [(5.0, 1e4)], "c double, x double")
    done = cleaning.zscore_winsorize(df, ["c", "x"], 2.0)
    x = np.array([*range(50), 1e4], dtype=float)
    want = np.clip(x, x.mean() - 2 * x.std(), x.mean() + 2 * x.std())
    assert column(done, "x") == pytest.approx(want.tolist())
    assert set(column(done, "c")) == {5.0}


def test_one_class_filter_drops_the_far_points(spark):
    rng = np.random.default_rng(0)
    frame = pd.DataFrame(rng.normal(size=(990, 2)), columns=["a", "b"])
    far = pd.DataFrame({"a": np.linspace(20, 40, 10), "b": np.linspace(-30, -20, 10)})
    df = spark.createDataFrame(pd.concat([frame, far]))
    kept = cleaning.one_class_filter(df, ["a", "b"], nu=0.01)
    assert kept.count() == 990 and kept.filter("a > 19").count() == 0
    assert cleaning.one_class_filter(df, []) is df


def test_nan_and_null_are_one(spark):
    df = spark.createDataFrame([(float("nan"), 1), (None, 2), (1.0, 3)], "x double, k int")
    assert column(nan_to_null(df), "x") == [None, None, 1.0]
    assert cleaning.drop_missing(df).count() == 1


def test_small_functions(spark):
    df = spark.createDataFrame([("a b/ü-1.png",)], "t string")
    assert df.select(safe_file_name(F.col("t"))).first()[0] == "a_b_ü-1.png"
    assert df.select(linspace(F.lit(10), F.lit(70), 3)).first()[0] == [10.0, 40.0, 70.0]


@pytest.mark.parametrize("bad", [{"test_size": 0.0}, {"test_size": 1.0}, {"n_splits": 1}, {"search_type": "best"}])
def test_settings_are_checked(bad):
    with pytest.raises(ValueError):
        MLConfig(**bad)
    with pytest.raises(ValueError):
        EdaConfig(one_class_nu=0)
