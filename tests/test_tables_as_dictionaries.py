"""Row numbers, dictionaries of any length, and quantiles by sketches and counts."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from casefile.operators import features, quantiles, ranking, schema
from casefile.operators.dictionaries import dictionary_of
from casefile.plans import run_eda
from casefile.sources import load_table
from casefile.sources.text_types import read_typed_csv


def test_row_index_is_gapless(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 7919 % 1000).repartition(7)
    read = ranking.with_row_index(df.filter("id % 3 <> 0"))
    assert sorted(r["row_index"] for r in read.collect()) == list(range(666))
    ordered = ranking.with_row_index(df, order=["x"])
    assert ordered.columns == ["id", "x", "row_index"] and ordered.filter("x <> row_index").count() == 0
    assert ranking.with_row_index(df.limit(0)).count() == 0


def test_side_by_side(spark):
    left = spark.createDataFrame([(i, f"l{i}") for i in range(9)], "id int, name string").repartition(4)
    right = spark.createDataFrame([(f"r{i}", i, None) for i in range(12)], "name string, ID int, name_right string").repartition(3)
    got = ranking.side_by_side(left, right, ["id"], ["ID"])
    assert got.columns == ["row_index", "id", "name", "name_right", "ID_right", "name_right_right"]
    rows = sorted(map(tuple, got.collect()))
    assert rows == [(i, i if i < 9 else None, f"l{i}" if i < 9 else None, f"r{i}", i, None) for i in range(12)]
    read = ranking.side_by_side(left.coalesce(1), left.coalesce(1))
    assert read.filter("id <> id_right OR id IS NULL").count() == 0


def test_factorize_many_values_and_missing(spark):
    rng = np.random.default_rng(4)
    values = [None if v % 10 == 0 else f"v{v}" for v in rng.integers(0, 200_000, 250_000).tolist()]
    frame = pd.DataFrame({"at": range(len(values)), "v": values})
    got = ranking.factorize(spark.createDataFrame(frame).repartition(6), "v", order=["at"]).toPandas().sort_values("at")
    codes, uniques = pd.factorize(frame["v"])
    assert len(uniques) > 100_000 and (got["code"].to_numpy() == codes).all()
    floats = spark.createDataFrame([(1, 2.5), (2, float("nan")), (3, None), (4, 1.0), (5, 2.5)], "at int, v double")
    assert [r["code"] for r in ranking.factorize(floats, "v", order=["at"]).orderBy("at").collect()] == [0, -1, -1, 1, 0]


def test_dictionary_numbers_every_column(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 1), ("b", 10)], "t string, n int")
    rows = {(r["column"], r["value"]): (r["n"], r["slot"]) for r in dictionary_of(df, ["t", "n"]).collect()}
    assert rows == {("t", "a"): (1, 0), ("t", "b"): (2, 1), ("n", "1"): (2, 0), ("n", "10"): (1, 1), ("n", "2"): (1, 2)}


def test_long_dictionaries_code_like_short_ones(spark):
    df = spark.createDataFrame([(i, f"c{i * 7 % 90:02d}" if i % 11 else None, "x" if i % 2 else "y", i / 3 if i % 5 else None) for i in range(300)], "id int, c string, d string, v double")
    short = features.build_preprocessor(df, ["id"])
    wide = features.build_preprocessor(df, ["id"])
    wide.inModel = 10
    a = {r["id"]: r["features"] for r in short.fit(df).transform(df).collect()}
    fitted = wide.fit(df)
    rows = fitted.transform(df)
    b = {r["id"]: r["features"] for r in rows.collect()}
    # columns with long dictionaries come last
    order = [0, *range(a[0].size - 2, a[0].size), *range(1, a[0].size - 2)]
    for i in a:
        assert np.allclose(a[i].toArray()[order], b[i].toArray())
    assert features.feature_names(rows)[:2] == ["features_0", "features_1"]
    unseen = spark.createDataFrame([(1, "new", None, 1.0)], df.schema)
    assert fitted.transform(unseen).first()["features"].numNonzeros() == 2
    one, two = features.one_hot(df, ["c", "d"]), features.one_hot(df, ["c", "d"], in_model=1)
    dense = lambda t: {r["id"]: (r["c"], r["d"]) for r in t.select("id", vector_to_array("c_vec").alias("c"), vector_to_array("d_vec").alias("d")).collect()}
    assert dense(one) == dense(two)


def test_three_hundred_thousand_categories_and_five_thousand_classes(spark):
    df = spark.range(320_000).select("id", F.concat(F.lit("k"), F.col("id") % 300_000).alias("c"), (F.col("id") % 5_000).alias("y"), (F.col("id") / 7).alias("v"))
    rows = features.build_preprocessor(df, ["id", "y"]).fit(df).transform(df)
    assert rows.select("features").first()[0].size == 300_001
    slots = rows.select(F.element_at(F.unwrap_udt("features")["indices"], -1).alias("at")).distinct().count()
    assert slots == 300_000
    coded, classes = features.encode_target(df, "y")
    assert len(classes) == 5_000 and coded.filter(F.col("label") != F.col("y")).count() == 0


@pytest.mark.parametrize("exact_rows", [5, 300, 10_000])
def test_quantiles_and_summaries(spark, exact_rows):
    rng = np.random.default_rng(9)
    frame = pd.DataFrame({"a": rng.normal(size=9_000), "b": rng.integers(0, 4, 9_000).astype(float), "c": np.where(rng.random(9_000) < 0.3, np.nan, rng.exponential(size=9_000)), "d": np.nan, "e": 5.0})
    df = spark.createDataFrame(frame).repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.999, 1.0]
    got = quantiles.quantiles(df, list(frame), probs, exact_rows)
    for c in "abce":
        assert np.allclose(got[c], frame[c].dropna().quantile(probs))
    assert got["d"] == [None] * 6
    found = quantiles.number_summaries(df, list(frame), exact_rows)
    for c in "abce":
        filled = frame[c].fillna(frame[c].median())
        assert found[c] == pytest.approx((frame[c].median(), filled.mean(), filled.std(ddof=0)), abs=1e-9)
    assert found["d"] == (None, None, None)


def test_quantile_plans_gather_no_values(spark, capsys):
    """Sketches have a bound in bytes for all columns together."""
    assert quantiles._sketch_size(1) == quantiles.MOST_SKETCH and quantiles._sketch_size(10_000) * 24 * 10_000 <= 2 * quantiles.SKETCH_BYTES


@pytest.mark.parametrize("suffix", [".csv", ".csv.gz"])
def test_csv_types_in_one_reading(spark, tmp_path, suffix):
    """Types hold for all values, also where a text comes last; rows of a wrong length are kept."""
    import gzip

    lines = ["a,b,c,d,e,f,g,h,i", *[f"{i},{i * 3_000_000_000},{i}.5,2020-01-{i % 28 + 1:02d},2020-01-01 10:00:{i % 60:02d},{'true' if i % 2 else 'False'},{i},,007" for i in range(5_000)]]
    lines += ["1,2,1e3,2020-02-30x,2020-01-01,true,late,,12", "5,6", "7,8,9.0,x,2020-01-01,true,y,,1,10"]
    data = ("\n".join(lines) + "\n").encode()
    path = f"{tmp_path}/t{suffix}"
    with open(path, "wb") as out:
        out.write(gzip.compress(data) if suffix.endswith("gz") else data)
    read = load_table(spark, path)
    assert [f.dataType.simpleString() for f in read.schema.fields] == ["int", "bigint", "double", "string", "timestamp", "boolean", "string", "string", "int"]
    assert read.count() == 5_003 and read.filter("a = 5 AND c IS NULL AND b = 6").count() == 1
    assert all(name.endswith(".parquet") for name in read.inputFiles())
    kept = read_typed_csv(spark, path, malformed="raw")
    assert sorted(r["raw"] for r in kept.filter("raw IS NOT NULL").select("raw").collect()) == ["5,6", "7,8,9.0,x,2020-01-01,true,y,,1,10"]


def test_run_eda_reads_its_source_twice(spark):
    """Once to choose the date column, once to write the dated rows; all tables come from these."""
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        reads.add(1)
        return x

    rows = [(f"2020-01-{i % 28 + 1:02d}", 1_577_836_800 + i, 34.0, -118.0, "x" if i % 2 else "y") for i in range(200)]
    raw = spark.createDataFrame(rows, "date_rptd string, stamp long, lat double, lon double, crm_cd_desc string").withColumn("date_rptd", seen.asNondeterministic()("date_rptd"))
    cleaned, tables = run_eda(spark, raw, as_of="2024-01-01", use_us_holidays=False)
    assert cleaned.count() == 200 and all(t.count() >= 0 for t in tables.values())
    assert 400 <= reads.value <= 800  # a reading may evaluate the column twice


def test_seconds_and_milliseconds_are_told_apart_in_one_pass(spark):
    rows = [(1_577_836_800 + i * 86_400, (1_577_836_800 + i * 86_400) * 1000, i) for i in range(50)]
    df = spark.createDataFrame(rows, "s long, ms long, small int")
    per_day, parsed = schema._scored_readings(df, "2024-01-01")
    assert per_day.select("candidate").distinct().count() == 3
    day = lambda name: df.select(parsed[name].cast("date").cast("string")).first()[0]
    assert day("s") == day("ms") == "2020-01-01" and day("small") == "1970-01-01"
    assert schema.choose_date_column(df, "2024-01-01")[0] == "s"
    pair = spark.createDataFrame([(1_577_836_800_000, 930)], "date_occ long, time_occ int")
    name, ts = schema.choose_date_column(pair, "2024-01-01")
    assert name == "date_occ" and pair.select(schema.date_candidates(pair)["date_occ+time_occ"].cast("string")).first()[0].startswith("2020-01-01 09:30")
