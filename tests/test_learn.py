from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from casefile.config import EdaConfig, MLConfig
from casefile.operators import explain, features
from casefile.operators.models import draw_points, get_model_and_param_space
from casefile.operators.training import compare_models, fit_pipeline, prepare_training, run_single_model, with_class_weight
from casefile.plans import quick_demo, run_eda
from casefile.session import durable, scratch_folder
from casefile.sources import save_table


@pytest.fixture(scope="module")
def table(spark):
    """y depends on a and on the colour; b is noise; some values are missing."""
    rng = np.random.default_rng(0)
    n = 600
    a, b = rng.normal(size=n), rng.normal(size=n)
    colour = rng.choice(["red", "green", "blue"], n)
    y = np.where(a + (colour == "red") + rng.normal(0, 0.3, n) > 0.5, "yes", "no")
    frame = pd.DataFrame({"id": np.arange(n), "a": a, "b": b, "colour": colour, "const": 1, "y": y})
    frame.loc[::17, "a"] = np.nan
    frame.loc[::19, "colour"] = None
    frame.loc[::50, "y"] = None
    return durable(spark.createDataFrame(frame))


def test_preprocessor(spark, table):
    model = features.build_preprocessor(table, ["id", "y"]).fit(table)
    rows = model.transform(table)
    assert features.feature_names(rows) == ["a", "b", "colour_blue", "colour_green", "colour_red"]
    x = np.stack([r[0].toArray() for r in rows.select("features").collect()])
    assert np.allclose(x[:, :2].mean(axis=0), 0) and np.allclose(x[:, :2].std(axis=0), 1)
    assert (x[:, 2:].sum(axis=1) == 1).all()
    unseen = spark.createDataFrame([(1, None, 0.0, "violet", 1, "yes")], table.schema)
    assert model.transform(unseen).first()["features"].toArray()[2:].tolist() == [0, 0, 0]


def test_odd_names_and_quotes(spark):
    df = spark.createDataFrame([(1.0, "it's", "x"), (2.0, "b\\c", None), (4.0, "it's", "x"), (3.0, None, "z")], ["a.b", "c `d", "e"])
    rows = features.build_preprocessor(df).fit(df).transform(df)
    assert rows.first()["features"].size == 5


def test_one_hot_unknown_is_zero(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    got = [r[0] for r in features.one_hot(df, ["c"]).select(vector_to_array("c_vec")).collect()]
    assert got == [[0.0, 1.0], [1.0, 0.0], [0.0, 0.0]]


def test_target_classes_in_number_order(spark):
    df = spark.createDataFrame([(10,), (2,), (None,)], "y int")
    coded, classes = features.encode_target(df, "y")
    assert classes == [2, 10] and [r["label"] for r in coded.collect()] == [1.0, 0.0]


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "c string")
    assert features.most_frequent(df, ["c"]) == {"c": "a"}


def test_registry():
    assert len(get_model_and_param_space("LR").points()) == 10
    distinct = {"rf": 3 * 3 * 3 * 3, "hgb": 3 * 3 * 3, "svm": 5 * 3, "mlp": 4}
    assert {name: len(get_model_and_param_space(name).points()) for name in distinct} == distinct
    assert get_model_and_param_space("random_forest").unmapped == ("min_samples_split",)
    assert len(draw_points(get_model_and_param_space("xgb").points(), "random", 30, 1)) == 30
    assert len(draw_points(get_model_and_param_space("logreg").points(), "random", 30, 1)) == 10
    with pytest.raises(ValueError):
        get_model_and_param_space("magic")


SMALL = {
    "logreg": {"C": (0.1, 1.0)},
    "rf": {"n_estimators": (10,), "max_depth": (4,)},
    "hgb": {"n_estimators": (5,), "max_depth": (3,), "min_samples_leaf": (20,)},
    "svm": {"kernel": ("rbf",), "C": (1.0,)},
    "mlp": {"hidden_layer_sizes": ((8,),), "learning_rate_init": (0.01,)},
    "xgb": {"n_estimators": (5,), "max_depth": (3,)},
}


def test_all_models_learn(table):
    config = MLConfig(n_splits=2, test_size=0.25)
    history = []
    got = compare_models(table, "y", [*SMALL, "magic"], config, "id", SMALL, history).collect()
    assert len(history) == 1 and len(got) == 7
    assert got[-1]["model"] == "magic" and got[-1]["cv_score"] is None and "magic" in got[-1]["error"]
    scores = [r["cv_score"] for r in got[:-1]]
    assert scores == sorted(scores, reverse=True) and min(scores) > 0.8
    assert all(r["roc_auc"] > 0.8 and r["avg_precision"] > 0.5 for r in got[:-1])


def test_every_held_out_row_is_judged(spark, table):
    data = prepare_training(table, "y", MLConfig(n_splits=2, test_size=0.25, sample_n=40), "id")
    # the 12 rows without target belong to neither side
    assert data.test.count() == 0.25 * (table.count() - 12) and data.train.count() <= 40
    assert data.test.join(data.train, "id").isEmpty()


def test_strength_follows_the_fitted_rows(spark):
    rows = spark.range(30).select(F.lit(2.0).alias("weight"))
    spec = get_model_and_param_space("logreg", n_rows=5).on(rows)
    assert spec.build({"C": 0.5}).getRegParam() == 1 / 30


def test_three_classes_fall_back_to_accuracy(spark, table):
    three = table.filter("colour is not null").drop("y")
    config = MLConfig(n_splits=2, test_size=0.25)
    r = run_single_model(three, "colour", "hgb", config, "id", SMALL["hgb"])
    assert r.scoring == "accuracy" and set(r.metrics) == {"accuracy", "macro_f1"}


def test_result_file(spark, table):
    out = scratch_folder(spark)
    run_single_model(table, "y", "logreg", MLConfig(n_splits=2, result_dir=out, search_type="grid"), "id", SMALL["logreg"])
    row = spark.read.json(f"{out}/logreg_results").first()
    assert row["target_column"] == "y" and row["best_params"]["C"] in ("0.1", "1.0") and row["is_binary"] is True


def test_missing_target(table):
    with pytest.raises(KeyError):
        run_single_model(table, "nope")


@pytest.fixture(scope="module")
def fitted(table):
    coded, _ = features.encode_target(table.fillna(0.0, ["a"]), "y")
    coded = durable(coded)
    spec = get_model_and_param_space("logreg", 2, coded.count())
    rows = with_class_weight(coded, spec)
    return fit_pipeline(rows, features.build_preprocessor(rows, ["id", "y", "label", "weight"]), spec, {"C": 1.0}), coded


def test_importances(fitted):
    model, rows = fitted
    top = explain.top_features(explain.model_importance(model, rows), 2).orderBy("place").collect()
    assert top[0]["feature"] == "a" and len(top) == 2
    got = {r["feature"]: r["importance"] for r in explain.permutation_importance(model, rows, ["a", "b", "colour"], key="id", block_rows=100).collect()}
    assert got["a"] > 0.2 and got["colour"] > 0.02 and abs(got["b"]) < 0.03


def test_partners_are_a_permutation(spark):
    df = spark.range(1000)
    got = explain._with_partner(df, "id", 3, 1, 1000, 100).select("_copy", F.col("_row.id").alias("me"), F.col("_other.id").alias("other")).toPandas()
    for _, part in got.groupby("_copy"):
        assert sorted(part["other"]) == list(range(1000)) == sorted(part["me"])
        assert (part["me"] != part["other"]).mean() > 0.95


def test_attributions_add_up(fitted):
    model, rows = fitted
    linear = explain.linear_attributions(model, rows, "id").groupBy("id").agg(F.sum("attribution").alias("s")).toPandas()
    margins = model.transform(rows).select("id", vector_to_array("rawPrediction")[1].alias("m")).toPandas()
    both = linear.merge(margins, on="id")
    assert np.allclose(both["s"], both["m"] - both["m"].mean())
    sampled = explain.sampled_attributions(model, rows, ["a", "b", "colour"], "id", orders=3, block_rows=100)
    total = sampled.agg(F.sum("attribution")).first()[0]
    assert abs(total) < 1e-6  # partners are a permutation, so gains and losses cancel over the table
    size = sampled.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("v")).toPandas().set_index("feature")["v"]
    assert size["a"] > size["colour"] > size["b"]


def test_learning_curve(table):
    coded, _ = features.encode_target(table, "y")
    spec = get_model_and_param_space("logreg", 2, 400)
    rows = durable(with_class_weight(coded, spec))
    curve = explain.learning_curve(rows, features.build_preprocessor(rows, ["id", "y", "label", "weight"]), spec, {"C": 1.0}, sizes=(0.2, 1.0), folds=2, key="id").collect()
    assert [r["size"] for r in curve] == [0.2, 1.0] and all(0.6 < r["valid_mean"] <= 1 for r in curve)


def test_demo(spark, table):
    path = save_table(table.drop("id"), scratch_folder(spark) + ".parquet")
    got = quick_demo(spark, path, "y", models=["logreg"], grids=SMALL, n_splits=2).first()
    assert got["roc_auc"] > 0.8


def test_run_eda_end_to_end(spark):
    rng = np.random.default_rng(0)
    n = 400
    days = pd.Timestamp("2012-01-01") + pd.to_timedelta(rng.integers(0, 900, n), unit="D")
    raw = pd.DataFrame(
        {
            "DATE OCC": days.strftime("%m/%d/%Y 12:00:00 AM"), "TIME OCC": rng.integers(0, 2359, n), "LAT": 34 + rng.normal(0, 0.1, n),
            "LON": -118.3 + rng.normal(0, 0.1, n), "Vict Age": rng.integers(18, 80, n).astype(float), "Crm Cd Desc": rng.choice(["x", "y"], n),
        }
    )
    raw.loc[0, "Vict Age"] = 5000.0
    raw.loc[1, ["LAT", "LON"]] = 0.0
    raw.loc[2, "Vict Age"] = np.nan
    source = save_table(spark.createDataFrame(pd.concat([raw, raw.head(20)])), scratch_folder(spark) + ".csv")
    out = scratch_folder(spark) + ".parquet"
    cleaned, tables = run_eda(spark, source, out, EdaConfig(add_hex=True), as_of="2020-01-01")
    assert cleaned.count() == n - 1 == spark.read.parquet(out).count()
    assert {"date_dt", "date", "hour", "is_holiday", "hex", "vict_age", "crm_cd_desc"} <= set(cleaned.columns)
    assert cleaned.agg(F.max("vict_age")).first()[0] < 200
    assert {r["issue"]: r["count"] for r in tables["coordinate_issues"].collect()} == {"zero_zero_coords": 2, "outside_LA_bbox": 2}
    assert tables["hour_day"].count() == 7
    assert tables["missingness"].agg(F.max("fraction")).first()[0] == 0.0
    assert {r["value"] for r in tables["top_categories"].collect()} == {"x", "y"}


def test_large_numbers_as_classes(spark):
    df = spark.createDataFrame([(1e10,), (2.5,), (None,), (1e10,)], "t double")
    coded, classes = features.encode_target(df, "t")
    assert classes == [2.5, 1e10] and sorted(r["label"] for r in coded.collect()) == [0.0, 1.0, 1.0]


def test_estimators_have_their_defaults():
    from casefile.operators.models import KernelSVM, SizedPerceptron

    assert KernelSVM().getOrDefault("seed") == 42 and SizedPerceptron().getOrDefault("maxIter") == 500


def test_kernel_machine_keeps_no_wide_rows(spark):
    """Margins come straight from the narrow rows; the hinge loss is as low as MLlib's on the features themselves."""
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.linalg import Vectors

    from casefile.operators.models import FourierMargin, KernelSVM

    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 2))
    label = ((x**2).sum(axis=1) < 1.2).astype(float)
    rows = [(Vectors.dense(v), float(c), 1.0 + float(c)) for v, c in zip(x, label, strict=True)]
    df = spark.createDataFrame(rows, ["features", "label", "weight"])
    machine = KernelSVM(C=1.0, nRows=float(400 + label.sum()), nFeatures=64).fit(df)
    margin = machine.stages[0]
    assert isinstance(margin, FourierMargin) and "_kernel" not in machine.transform(df).columns
    z = np.concatenate([np.array(z, dtype=float) for _, z in margin.kernel.strips(x)])

    def loss(w, b):
        short = np.maximum(0, 1 - (2 * label - 1) * (z @ w + b))
        return ((1 + label) * short).sum() / (1 + label).sum() + w @ w / 2 / (400 + label.sum())

    wide = spark.createDataFrame([(Vectors.dense(v), float(c), 1.0 + float(c)) for v, c in zip(z, label, strict=True)], ["features", "label", "weight"])
    whole = LinearSVC(weightCol="weight", maxIter=100, tol=1e-4, regParam=float(1 / (400 + label.sum())), standardization=False).fit(wide)
    assert loss(margin.weights[:-1, 0], margin.weights[-1, 0]) <= 1.05 * loss(whole.coefficients.toArray(), whole.intercept)
    three = spark.createDataFrame([(Vectors.dense(v), float(np.digitize((v**2).sum(), [0.7, 2.5])), 1.0) for v in x], ["features", "label", "weight"])
    hit = KernelSVM(C=10.0, nClasses=3, nRows=400.0).fit(three).transform(three).filter("prediction = label").count()
    assert hit > 360


def test_tasks_of_a_fit_hold_a_bounded_number_of_rows(spark):
    from casefile.session import spread, stored

    table = spread(stored(spark.range(250_000).coalesce(1)), 20_000)
    held = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
    assert len(held) >= 13 and max(held) <= 20_100
    few = stored(spark.range(500).coalesce(1))
    assert spread(few, 100) is few


def test_regressions_of_all_folds_share_their_scans(spark, table, monkeypatch):
    """Scores are those of fits made one by one, with numbers and categories missing, ties, and classes out of balance."""
    from casefile.operators import logistic, training
    from casefile.operators.models import ModelSpec

    coded, _ = features.encode_target(table.withColumn("a", F.round("a", 1)), "y")
    spec = get_model_and_param_space("logreg", 2)
    rows = durable(with_class_weight(coded.withColumn("fold", F.col("id") % 2), spec))
    preprocessor = features.build_preprocessor(rows, ["id", "y", "label", "weight", "fold"])
    points = [{"C": 0.001}, {"C": 1.0}]

    def scores(scoring):
        return training.cross_validate(rows, preprocessor, spec, points, scoring, 2, 4)

    def curve():
        return explain.learning_curve(rows.drop("fold"), preprocessor, spec, {"C": 1.0}, sizes=(0.5,), folds=2, key="id").collect()

    with monkeypatch.context() as alone:
        alone.setattr(training, "shared_rows", lambda *_: None)
        alone.setattr(explain, "shared_rows", lambda *_: None)
        wanted = {s: scores(s) for s in ("roc_auc", "f1_macro")}
        wanted_curve = curve()
    monkeypatch.setattr(logistic, "RANGE_ROWS", 20)
    monkeypatch.setattr(ModelSpec, "build", lambda *_: pytest.fail("fitted one by one"))
    for scoring, value in wanted.items():
        assert np.allclose(scores(scoring), value, atol=1e-4 if scoring == "roc_auc" else 1e-9), scoring
    assert np.allclose(np.array(curve(), dtype=float), np.array(wanted_curve, dtype=float), atol=1e-9)


def test_shared_regressions_reach_the_minimum(spark):
    from casefile.operators.logistic import Fit, shared_rows

    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 2)) * [1.0, 1000.0] + [0.0, 1e6]
    y = (x[:, 0] + (x[:, 1] - 1e6) / 1000 + rng.normal(0, 1, 300) > 0).astype(float)
    df = spark.createDataFrame([(*map(float, v), float(c), 1.0 + float(c), i % 2) for i, (v, c) in enumerate(zip(x, y, strict=True))], "a double, b double, label double, weight double, fold int")
    preprocessor = features.build_preprocessor(df, ["label", "weight", "fold"])
    spec = get_model_and_param_space("logreg", 2)
    with shared_rows(df, preprocessor, spec, F.col("fold"), 2, "accuracy") as rows:
        fits = [Fit(np.array([True, True]), 0.1), Fit(np.array([False, True]), 0.1), Fit(np.array([False, False]), 1.0)]
        rows.fit(fits[:2])
        coding = rows._coding(fits[0].cells, [])
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    w = 1 + y
    raw = (x - rows.layout.centre) / rows.layout.scale
    margin = np.column_stack([np.ones(300), raw]) @ fits[0].weights
    theta = np.linalg.lstsq(np.column_stack([z, np.ones(300)]), margin, rcond=None)[0]
    slope = np.column_stack([z, np.ones(300)]).T @ (w * (1 / (1 + np.exp(-margin)) - y)) + np.append(theta[:2] / 0.1, 0)
    assert np.abs(slope).max() < 1e-6 and coding.shape == (3, 3)
    assert not np.allclose(fits[0].weights, fits[1].weights)


def test_wide_tables_are_fitted_one_by_one(spark):
    from casefile.operators.logistic import shared_rows

    df = spark.range(300).select(F.col("id").cast("string").alias("name"), (F.col("id") % 2).cast("double").alias("label"), F.lit(1.0).alias("weight"), (F.col("id") % 3).cast("int").alias("fold"))
    preprocessor = features.build_preprocessor(df, ["label", "weight", "fold"])
    assert shared_rows(df, preprocessor, get_model_and_param_space("logreg", 2), F.col("fold"), 3, "roc_auc") is None
    assert shared_rows(df, preprocessor, get_model_and_param_space("rf", 2), F.col("fold"), 3, "roc_auc") is None


def test_partners_travel_without_key_and_are_a_permutation(spark):
    df = spark.range(300).selectExpr("concat('k', id) AS k", "id AS a", "cast(id % 2 AS double) AS label")
    rows = explain._with_partner(df, "k", 2, 42, 300, 50, ["a", "label"])
    assert rows.schema["_row"].dataType.names == ["a", "label"]
    assert set(rows.columns) == {"_row", "_copy", "_other"}
    found = rows.groupBy("_copy").agg(F.countDistinct("_row.a").alias("n"), F.countDistinct("_other.a").alias("m")).collect()
    assert [(r.n, r.m) for r in found] == [(300, 300)] * 2


@pytest.mark.parametrize("depth", [2, 6, 7])
def test_forests_attribute_without_scoring_mixed_rows(spark, monkeypatch, depth):
    """Decisions of two rows, mixed by bits, give what the model says of mixed rows; deeper trees are asked row by row."""
    rng = np.random.default_rng(depth)
    frame = pd.DataFrame({"id": [f"r{i % 190}" for i in range(200)], "a.b": rng.normal(size=200), "b": rng.normal(size=200), "kind": rng.choice(list("xyz"), 200)})
    frame.loc[::17, "b"] = None
    frame["label"] = ((frame["a.b"] + (frame["kind"] == "x") + rng.normal(size=200) * 0.4) > 0.3).astype(float)
    df = durable(spark.createDataFrame(frame).withColumn("weight", F.lit(1.0)))
    spec = get_model_and_param_space("rf", 2)
    preprocessor = features.build_preprocessor(df, ["id", "label", "weight"])
    model = fit_pipeline(df, preprocessor, spec, {"n_estimators": 5, "max_depth": depth})
    names = ["a.b", "b", "kind"]
    coded = explain.CodedForest.of(model, df, names, 1)
    assert (coded is None) == (max(t.depth for t in model.stages[-1].trees) > 6)
    got = explain.sampled_attributions(model, df, names, "id", orders=3, block_rows=60).toPandas()
    monkeypatch.setattr(explain.CodedForest, "of", lambda *a: None)
    want = explain.sampled_attributions(model, df, names, "id", orders=3, block_rows=60).toPandas()
    assert len(got) == 190 * 3 and list(got.columns) == list(want.columns) == ["id", "feature", "attribution"]
    both = got.merge(want, on=["id", "feature"])
    assert len(both) == len(got) and np.allclose(both["attribution_x"], both["attribution_y"], atol=1e-12)


def test_training_rows_are_made_once_and_dealt_out_for_the_model_only(spark, monkeypatch):
    from casefile.catalog import learn

    folder = scratch_folder(spark)
    line = "id AS l_orderkey, 1 AS l_linenumber, id % 7 AS l_partkey, 3 AS l_suppkey, cast(id % 50 AS double) AS l_quantity, cast(id % 91 AS double) AS l_extendedprice"
    more = "cast(id % 11 AS double) / 100 AS l_discount, cast(id % 9 AS double) / 100 AS l_tax, substr('ANR', cast(id % 3 AS int) + 1, 1) AS l_returnflag"
    spark.sql(f"SELECT {line}, {more} FROM range(500)").write.parquet(f"{folder}/lineitem.parquet")
    made, seen, stored = [], {}, learn.stored

    def noted(df):
        made.append("md5" in df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df)

    def fitted(df, preprocessor, spec, params, dealt=None):
        seen.update(df=df, dealt=dealt, model=fit_pipeline(df, preprocessor, spec, params, dealt))
        return seen["model"]

    monkeypatch.setattr(learn, "stored", noted)
    monkeypatch.setattr(learn, "spread", lambda df, rows=None: df.repartition(7) if rows else df)
    monkeypatch.setattr(learn, "fit_pipeline", fitted)
    model, test = learn._fit(spark, folder, "logreg", {"C": 1.0})
    assert made[0] and seen["dealt"].rdd.getNumPartitions() == 7 != seen["df"].rdd.getNumPartitions()
    assert seen["df"].exceptAll(seen["dealt"]).count() == seen["dealt"].exceptAll(seen["df"]).count() == 0
    assert seen["df"].count() + test.count() == 500 and test.count() == model.transform(test).count()
    # what the preprocessor reads has no exchange and does not make the rows again
    plan = seen["df"]._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan and "md5" not in plan
