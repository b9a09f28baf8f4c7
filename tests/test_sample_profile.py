from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from casefile.operators import evaluation as ev
from casefile.operators import profiling, ranking, sampling
from casefile.operators.series import count_per_day


def keys(df, name="k"):
    return sorted(r[name] for r in df.collect())


@pytest.fixture(scope="module")
def classes(spark):
    rows = [(i, "abc"[0 if i % 10 < 7 else 1 if i % 10 < 9 else 2] if i % 13 else None, i % 4) for i in range(2000)]
    return spark.createDataFrame(rows, "k long, c string, s int")


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_samples_do_not_depend_on_partitions(classes, parts):
    moved = classes.repartition(parts)
    assert keys(sampling.simple_sample(moved, 50, "k")) == keys(sampling.simple_sample(classes, 50, "k"))
    assert keys(sampling.sample_by_target(moved, "c", 100, "k")) == keys(sampling.sample_by_target(classes, "c", 100, "k"))
    a, b = (sampling.assign_folds(d, "c", 5, "k").orderBy("k").collect() for d in (moved, classes))
    assert a == b


def test_sizes(classes):
    assert sampling.simple_sample(classes, 10**6, "k").count() == 2000
    assert sampling.simple_sample(classes, 0, "k").count() == 0
    assert sampling.sample_by_target(classes, "c", 10**6, "k").count() == classes.filter("c is not null").count()
    with pytest.raises(KeyError):
        sampling.sample_by_target(classes, "nope", 10)
    assert sampling.sample_for_task(classes, "nope", 10, "k").count() == 10


def test_task_quotas(spark):
    rows = [(i, c) for i, c in enumerate(["a"] * 7 + ["b"] * 3 + [None] * 2)]
    got = sampling.sample_for_task(spark.createDataFrame(rows, "k int, c string"), "c", 6, "k")
    assert {r["c"]: r["count"] for r in got.groupBy("c").count().collect()} == {"a": 3, "b": 1}


def test_rows_without_key_are_sampled_whole(spark):
    df = spark.createDataFrame([(i % 5, "x") for i in range(100)], "a int, b string")
    assert sampling.simple_sample(df, 30).count() == 30


def test_split_and_folds_partition_the_rows(classes):
    train, test = sampling.split_train_test(classes, "c", 0.2, "k")
    assert sorted(keys(train) + keys(test)) == keys(classes.filter("c is not null"))
    folds = sampling.assign_folds(classes, "c", 5, "k")
    per = folds.groupBy("fold", "c").count().toPandas().pivot(index="fold", columns="c", values="count")
    assert ((per.max() - per.min()) <= 1).all()
    sizes = per.sum(axis=1)
    assert sizes.max() - sizes.min() <= 1


def test_rolling_split_points(spark):
    frame = pd.DataFrame(
        [(n, pd.Timestamp("2020-01-01") + pd.Timedelta(days=i), 1.0) for n in (100, 365, 20) for i in range(n)], columns=["key", "ds", "y"]
    )
    df = spark.createDataFrame(frame).withColumn("ds", F.col("ds").cast("date"))
    three = {(r["key"], r["split"]): r["start"] for r in sampling.rolling_splits(df, ["key"], 30, 90, 3).collect()}
    assert [three[100, i] for i in (1, 2, 3)] == [10, 40, 70]
    assert not any(k == 20 for k, _ in three)
    four = [r["start"] for r in sampling.rolling_splits(df.filter("key = 365"), ["key"], 30, 90, 4).collect()]
    assert sorted(four) == [275, 295, 315, 335]


def test_running_totals_across_buckets(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"x": rng.permutation(500) / 7.0, "n": rng.integers(0, 9, 500)})
    df = spark.createDataFrame(frame).repartition(5)
    for descending in (False, True):
        got = ranking.running_totals(df, "x", ["n"], descending, ["n"], rows_per_bucket=30).toPandas()
        got = got.sort_values("x", ascending=not descending).reset_index(drop=True)
        assert (got["cum_n"] == got["n"].cumsum()).all()
        assert got["next_n"].iloc[:-1].tolist() == got["n"].iloc[1:].tolist() and np.isnan(got["next_n"].iloc[-1])


def test_known_metrics(spark):
    marks = [(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 1), (0.5, 0), (0.4, 1), (0.3, 0), (0.3, 1)]
    df = spark.createDataFrame(marks, "score double, label int")
    for bucket in (3, 1_000_000):
        assert ev.roc_auc(df, rows_per_bucket=bucket).first()[0] == pytest.approx(0.566667, abs=1e-6)
        assert ev.average_precision(df, rows_per_bucket=bucket).first()[0] == pytest.approx(0.741667, abs=1e-6)
        points = ev.roc_points(df, rows_per_bucket=bucket).collect()
        assert points[0]["threshold"] == float("inf") and (points[0]["fpr"], points[0]["tpr"]) == (0.0, 0.0)
        assert max(p["fpr"] for p in points) == 1.0
    squared = df.withColumn("score", F.col("score") ** 2 * 5)
    assert ev.roc_auc(squared).first()[0] == ev.roc_auc(df).first()[0]


def test_macro_f1_counts_predicted_only_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "b")], "label string, prediction string")
    assert ev.macro_f1(df).first()[0] == pytest.approx((2 / 3 + 1.0 + 0.0) / 3)
    assert ev.confusion_matrix(df).count() == 9


def test_mape_with_zero_actuals(spark):
    df = spark.createDataFrame([("m", 0.0, 2.0), ("m", 4.0, 2.0)], "model string, y double, yhat double")
    row = ev.forecast_errors(df, ["model"]).first()
    assert (row["MAE"], row["MAPE%"]) == (2.0, 125.0)


def test_pairwise_pearson(spark):
    rows = [(1.0, 2.0, 7.0), (2.0, 4.1, 7.0), (None, 9.0, 7.0), (3.0, 5.0, 7.0)]
    got = {(r["a"], r["b"]): r["value"] for r in profiling.pearson(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(0.974355, abs=1e-6) and got["b", "a"] == got["a", "b"]
    assert got["a", "a"] == pytest.approx(1.0) and got["a", "c"] is None


def test_mutual_information_extremes(spark):
    df = spark.createDataFrame([("a", "x", "k"), ("b", "y", "k"), ("a", "x", "k"), (None, "z", "k")], "p string, q string, r string")
    got = {(r["a"], r["b"]): r["value"] for r in profiling.mutual_information(df, ["p", "q", "r"]).collect()}
    assert got["p", "q"] == pytest.approx(1.0) and got["p", "r"] == 0.0 and got["r", "r"] == 1.0


@pytest.mark.parametrize("values", [[3.0, 3.0], [0.0, 0.1, 0.2, 0.3, 1.0, 1.0], list(range(61)), [1.0, None, 2.0]])
def test_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    counts, edges = np.histogram([v for v in values if v is not None], bins=30)
    got = profiling.numeric_histograms(df).orderBy("bin").collect()
    assert [r["count"] for r in got] == counts.tolist()
    assert [r["low"] for r in got] + [got[-1]["high"]] == pytest.approx(edges.tolist())


def test_top_categories_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "v string")
    assert [tuple(r) for r in profiling.top_categories(df, "v", 2).collect()] == [("a", 2), ("b", 2)]


def test_top_categories_by_candidates(spark, monkeypatch):
    """Heavy values are found from the sketch alone; a column without any is counted in full."""
    rows = [(f"h{i % 5}" if i % 2 else f"r{i}", f"u{i}", "k" if i % 3 else None) for i in range(20_000)]
    df = spark.createDataFrame(rows, "a string, b string, c string").repartition(6)
    full = []
    counted = profiling._counted_in_full
    monkeypatch.setattr(profiling, "_counted_in_full", lambda df, names, n: full.append(list(names)) or counted(df, names, n))
    monkeypatch.setattr(profiling, "TRACKED_VALUES", 200)
    got = profiling.top_categories_of(df, ["a", "b", "c", "gone"], 5).collect()
    assert full == [["b", "c"]] or full == [["b"]]
    by = lambda c: sorted(((-r["count"], r["value"]) for r in got if r["column"] == c))
    assert by("a") == [(-2000, f"h{i}") for i in range(5)]
    assert [v for _, v in by("b")] == sorted(f"u{i}" for i in range(20_000))[:5]
    assert by("c") == [(-13333, "k"), (-6667, "None")]


def test_pearson_of_many_columns_in_one_scan(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(600, 100)) @ np.triu(rng.normal(size=(100, 100))) * 10.0 ** rng.integers(-3, 4, 100) + 10.0 ** rng.integers(0, 7, 100)
    frame = pd.DataFrame(base, columns=[f"c{i}" for i in range(100)])
    frame = frame.mask(rng.random(frame.shape) < 0.2)
    frame["c7"] = 3.25
    got = profiling.pearson(spark.createDataFrame(frame).repartition(4), list(frame)).toPandas()
    want = frame.corr().stack(future_stack=True)
    found = got.set_index(["a", "b"])["value"]
    for pair, r in want.items():
        assert (np.isnan(r) and np.isnan(found[pair])) or found[pair] == pytest.approx(r, abs=1e-7)
    empty = profiling.pearson(spark.createDataFrame(frame).limit(0), ["c0", "c1"]).collect()
    assert len(empty) == 4 and {r["value"] for r in empty} == {None}


def test_gaps_become_zero(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-04",), (None,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert [r["y"] for r in count_per_day(df, F.col("t")).orderBy("ds").collect()] == [1, 0, 0, 1]


def test_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")
    assert {r["label"]: r["weight"] for r in profiling.class_weights(df, "label").collect()} == {0: 4 / 6, 1: 2.0}
    assert profiling.positive_weight(df, "label") == 3.0
    assert profiling.positive_weight(df.filter("label = 0"), "label") is None
