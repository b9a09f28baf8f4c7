"""Feature preparation, classifiers, search and explanation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from casefile.catalog.registry import query
from casefile.catalog.profile import INCIDENT_NUMBERS, histogram_sql
from casefile.catalog.tables import WITH_INCIDENTS, incidents, table
from casefile.config import EdaConfig, MLConfig
from casefile.operators import explain, features
from casefile.operators.models import get_model_and_param_space
from casefile.operators.training import count_classes, evaluate_holdout, fit_pipeline, prepare_training, run_single_model, with_class_weight
from casefile.operators.sampling import split_train_test
from casefile.plans import quick_compare, run_eda
from casefile.session import TASK_ROWS, durable, spread, stored


@query(
    "f01_median_impute",
    f"""
    {WITH_INCIDENTS}, m AS (SELECT quantile_cont(vict_age::DOUBLE, 0.5) AS a, quantile_cont(lat, 0.5) AS b FROM incidents)
    SELECT inc_id, coalesce(vict_age::DOUBLE, a) AS vict_age, round(coalesce(lat, b), 9) AS lat FROM incidents, m
    """,
)
def f01(spark, sf):
    filled = features.median_impute(incidents(spark, sf).select("inc_id", "vict_age", "lat"), ["vict_age", "lat"])
    return filled.withColumn("lat", F.round("lat", 9))


@query(
    "f02_mode_impute",
    f"""
    {WITH_INCIDENTS}, m AS (SELECT crm_cd_desc AS v FROM incidents WHERE crm_cd_desc IS NOT NULL GROUP BY crm_cd_desc ORDER BY count(*) DESC, crm_cd_desc LIMIT 1)
    SELECT inc_id, coalesce(crm_cd_desc, v) AS crm_cd_desc FROM incidents, m
    """,
)
def f02(spark, sf):
    return features.mode_impute(incidents(spark, sf).select("inc_id", "crm_cd_desc"), ["crm_cd_desc"])


@query(
    "f03_standardize",
    """
    WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS d, avg(l_quantity) AS m2, stddev_pop(l_quantity) AS d2 FROM lineitem)
    SELECT l_orderkey, l_linenumber, round((l_extendedprice - m) / d, 6) AS l_extendedprice, round((l_quantity - m2) / d2, 6) AS l_quantity FROM lineitem, s
    """,
)
def f03(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    done = features.standardize(df, ["l_extendedprice", "l_quantity"])
    return done.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in ("l_extendedprice", "l_quantity")])


@query("f04_scale", "SELECT l_orderkey, l_linenumber, round(l_tax / (SELECT stddev_pop(l_tax) FROM lineitem), 6) AS l_tax FROM lineitem")
def f04(spark, sf):
    done = features.standardize(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_tax"), ["l_tax"], with_mean=False)
    return done.withColumn("l_tax", F.round("l_tax", 6))


@query(
    "f05_one_hot",
    f"""
    {WITH_INCIDENTS}, c AS (SELECT crm_cd_desc AS v, CAST(row_number() OVER (ORDER BY crm_cd_desc) - 1 AS INTEGER) AS slot
                            FROM (SELECT DISTINCT crm_cd_desc FROM incidents WHERE crm_cd_desc IS NOT NULL))
    SELECT inc_id, slot, CASE WHEN crm_cd_desc = v THEN 1.0 ELSE 0.0 END::DOUBLE AS value FROM incidents, c
    """,
)
def f05(spark, sf):
    coded = features.one_hot(incidents(spark, sf).select("inc_id", "crm_cd_desc"), ["crm_cd_desc"])
    return coded.select("inc_id", F.posexplode(vector_to_array("crm_cd_desc_vec")).alias("slot", "value"))


@query(
    "f06_encode_target",
    """
    SELECT p_partkey, p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS DOUBLE) AS label FROM part
    """,
)
def f06(spark, sf):
    return features.encode_target(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand")[0]


@query(
    "f05_wide",
    """
    WITH c AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS slot, count(*) OVER () AS size FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS v FROM orders))
    SELECT o_orderkey, size::INTEGER AS size, slot::INTEGER AS slot, 1.0::DOUBLE AS value FROM orders JOIN c ON CAST(o_custkey AS VARCHAR) = v
    """,
)
def f05_wide(spark, sf):
    """A dictionary that is joined as a table, not held in a model."""
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    parts = F.unwrap_udt("customer_vec")
    return features.one_hot(rows, ["customer"], in_model=100).select(
        "o_orderkey", parts["size"].alias("size"), F.get(parts["indices"], 0).alias("slot"), F.get(parts["values"], 0).alias("value")
    )


@query(
    "f06_wide",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(dense_rank() OVER (ORDER BY l_partkey) - 1 AS DOUBLE) AS label FROM lineitem",
)
def f06_wide(spark, sf):
    return features.encode_target(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey")[0]


MATRIX_SQL = f"""
{WITH_INCIDENTS}, filled AS (
  SELECT inc_id, coalesce(vict_age::DOUBLE, (SELECT quantile_cont(vict_age::DOUBLE, 0.5) FROM incidents)) AS vict_age, loss,
    coalesce(status_desc, 'x') AS status_desc FROM incidents),
s AS (SELECT avg(vict_age) AS am, stddev_pop(vict_age) AS asd, avg(loss) AS lm, stddev_pop(loss) AS lsd FROM filled)
SELECT inc_id, round((vict_age - am) / asd, 6) AS vict_age, round((loss - lm) / lsd, 6) AS loss,
  (status_desc = 'F')::INT::DOUBLE AS status_f, (status_desc = 'O')::INT::DOUBLE AS status_o, (status_desc = 'P')::INT::DOUBLE AS status_p
FROM filled, s
"""


@query("f07_preprocess", MATRIX_SQL)
def f07(spark, sf):
    df = incidents(spark, sf).select("inc_id", "vict_age", "loss", "status_desc", "const_col")
    rows = features.build_preprocessor(df, ["inc_id"]).fit(df).transform(df)
    slots = vector_to_array("features")
    names = ["vict_age", "loss", "status_f", "status_o", "status_p"]
    return rows.select("inc_id", *[F.round(F.get(slots, i), 6).alias(n) for i, n in enumerate(names)])


# ---- classifiers ------------------------------------------------------------

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linenumber"]


TARGET = "size_class"
# Every metric of a classifier on held-out rows must reach this; guessing gives about a half.
FLOOR = 0.75


def _rows(spark, sf):
    """Line items with a two-class target: a rule over three columns, turned round for a hashed sixteenth of the rows."""
    lines = table(spark, sf, "lineitem")
    key = F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    points = F.col("l_quantity") + 100 * F.col("l_discount") + F.when(F.col("l_returnflag") == "R", 10).otherwise(0)
    large = (points > 34) != (F.substr(F.md5(key.cast("binary")), F.lit(1), F.lit(1)) == "0")
    return lines.select(key.alias("row_key"), *FEATURES, F.when(large, "large").otherwise("small").alias(TARGET))


LABELLED_SQL = """
k AS (SELECT *, concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key FROM lineitem),
t AS (SELECT (l_quantity + 100 * l_discount + CASE WHEN l_returnflag = 'R' THEN 10 ELSE 0 END > 34) <> (substr(md5(row_key), 1, 1) = '0') AS large FROM k)
"""


def _metrics_sql(name: str, *more: str) -> str:
    metrics = ["accuracy", "avg_precision", "macro_f1", "roc_auc", *more]
    return f"""
    WITH {LABELLED_SQL}
    SELECT '{name}' AS model, metric, {FLOOR}::DOUBLE AS floor, true AS reached, count(*) FILTER (WHERE large) AS n_large, count(*) FILTER (WHERE NOT large) AS n_small
    FROM t, (SELECT unnest({metrics}) AS metric) GROUP BY metric
    """


def _fit(spark, sf, name: str, params: dict):
    """One fit on the training part of all rows, judged on the held-out fifth."""
    # the rows are made once; classes, their counts and the split take a few columns of them
    encoded, classes = features.encode_target(spread(stored(_rows(spark, sf))), TARGET)
    train, test = split_train_test(encoded, "label", 0.2, "row_key")
    train = stored(train.drop("row_key", TARGET))
    spec = get_model_and_param_space(name, len(classes))
    counts = count_classes(train, "label")
    weighted, dealt = (with_class_weight(rows, spec, counts=counts) for rows in (train, spread(train, TASK_ROWS)))
    preprocessor = features.build_preprocessor(weighted, ["row_key", TARGET, "label", "weight"])
    return fit_pipeline(weighted, preprocessor, spec, params, dealt), test


def _metrics(spark, sf, name: str, params: dict):
    """For each metric on the held-out rows, whether it reaches the floor; with the size of both classes."""
    model, test = _fit(spark, sf, name, params)
    return _against_floor(spark, sf, name, evaluate_holdout(model, test, True)[0])


def _against_floor(spark, sf, name: str, metrics: dict):
    held = {r[TARGET]: r["count"] for r in _rows(spark, sf).groupBy(TARGET).count().collect()}
    rows = [(name, k, FLOOR, bool(v >= FLOOR), held.get("large", 0), held.get("small", 0)) for k, v in sorted(metrics.items())]
    return spark.createDataFrame(rows, "model string, metric string, floor double, reached boolean, n_large long, n_small long")


@query("k01_logistic_regression", _metrics_sql("logreg"))
def k01(spark, sf):
    return _metrics(spark, sf, "logreg", {"C": 1.0})


@query("k02_random_forest", _metrics_sql("rf"))
def k02(spark, sf):
    return _metrics(spark, sf, "rf", {"n_estimators": 20, "max_depth": 8})


@query("k03_boosted_trees", _metrics_sql("hgb"))
def k03(spark, sf):
    return _metrics(spark, sf, "hgb", {"n_estimators": 10, "max_depth": 4})


@query("k04_svm_linear", _metrics_sql("svm"))
def k04(spark, sf):
    return _metrics(spark, sf, "svm", {"kernel": "linear", "C": 1.0})


@query("k04_svm_rbf", _metrics_sql("svm"))
def k04_rbf(spark, sf):
    return _metrics(spark, sf, "svm", {"kernel": "rbf", "C": 1.0})


@query("k05_perceptron", _metrics_sql("mlp"))
def k05(spark, sf):
    return _metrics(spark, sf, "mlp", {"hidden_layer_sizes": (16,), "learning_rate_init": 0.01})


@query("k06_extreme_boosting", _metrics_sql("xgb"))
def k06(spark, sf):
    return _metrics(spark, sf, "xgb", {"n_estimators": 10, "max_depth": 3, "subsample": 0.8})


# Small grids for the comparison of four models.
SMALL_GRIDS = {
    "logreg": {"C": (0.01, 1.0)},
    "rf": {"n_estimators": (10,), "max_depth": (5,)},
    "hgb": {"n_estimators": (3,), "max_depth": (2,), "min_samples_leaf": (20,)},
    "xgb": {"n_estimators": (3,), "max_depth": (2,)},
}


@query("k11_train_one", _metrics_sql("logreg", "cv_score"))
def k11(spark, sf):
    """The whole grid over five folds, fitted on all rows that are not held out."""
    config = MLConfig(sample_first=False, test_size=0.2, search_type="grid")
    r = run_single_model(_rows(spark, sf), TARGET, "logreg", config, "row_key")
    return _against_floor(spark, sf, "logreg", {"cv_score": r.cv_score, **r.metrics})


HOLDOUT_SQL = f"""
WITH {LABELLED_SQL}
SELECT CASE WHEN large THEN 'large' ELSE 'small' END AS {TARGET}, round(count(*) * 0.2)::BIGINT AS n_test FROM t GROUP BY large
"""


@query("e08_holdout", HOLDOUT_SQL)
def e08(spark, sf):
    """Rows of each class that a comparison judges its models on, while it fits them on a sample."""
    data = prepare_training(_rows(spark, sf), TARGET, MLConfig(test_size=0.2), "row_key")
    return data.test.groupBy(TARGET).agg(F.count(F.lit(1)).alias("n_test"))


@query("k12_compare_models")
def k12(spark, sf):
    config = MLConfig(n_splits=2, test_size=0.2, n_iter=2)
    df = incidents(spark, sf).select("time_occ", "lat", "lon", "crm_cd_desc", "vict_age", "loss", "status_desc", "const_col")
    return quick_compare(df, "status_desc", config=config, grids=SMALL_GRIDS).drop("duration_seconds")


# ---- explanation ------------------------------------------------------------


@query("i01_model_importance")
def i01(spark, sf):
    model, test = _fit(spark, sf, "logreg", {"C": 1.0})
    return explain.model_importance(model, test)


@query("i02_permutation_importance")
def i02(spark, sf):
    model, test = _fit(spark, sf, "logreg", {"C": 1.0})
    return explain.permutation_importance(model, test, FEATURES, repeats=5, key="row_key")


@query("i04_learning_curve")
def i04(spark, sf):
    encoded, classes = features.encode_target(_rows(spark, sf), TARGET)
    spec = get_model_and_param_space("logreg", len(classes))
    rows = durable(with_class_weight(encoded, spec))
    preprocessor = features.build_preprocessor(rows, ["row_key", TARGET, "label", "weight"])
    return explain.learning_curve(rows, preprocessor, spec, {"C": 1.0}, key="row_key")


@query("i05_linear_attributions")
def i05(spark, sf):
    model, test = _fit(spark, sf, "logreg", {"C": 1.0})
    return explain.linear_attributions(model, test, "row_key")


@query("i05_sampled_attributions")
def i05_sampled(spark, sf):
    model, test = _fit(spark, sf, "rf", {"n_estimators": 10, "max_depth": 5})
    return explain.sampled_attributions(model, test, FEATURES, "row_key", orders=4)


@query("l01_run_eda")
def l01(spark, sf):
    config = EdaConfig(one_class_filter=True)
    return run_eda(spark, incidents(spark, sf), config=config, as_of="2001-09-01", key="inc_id")[0]


# The best date column of the incidents is date_rptd; with outliers kept and no column required, cleaning leaves dated rows as they are.
PROFILE_COLUMNS = ("date_occ", "time_occ", "crm_cd_desc", "status_desc", "vict_age", "lat", "lon", "loss")
PROFILE_SQL = f"""
{WITH_INCIDENTS}, cleaned AS (
  SELECT DISTINCT * FROM incidents WHERE try_cast(date_rptd AS TIMESTAMP) BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2001-09-01'
), gaps AS (
  {" UNION ALL ".join(f"SELECT '{c}' AS name, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS value FROM cleaned" for c in PROFILE_COLUMNS)}
), tops AS (
  SELECT 'crm_cd_desc' AS name, coalesce(crm_cd_desc, 'None') AS entry, count(*) AS n FROM cleaned GROUP BY ALL
  UNION ALL SELECT 'status_desc', status_desc, count(*) FROM cleaned GROUP BY ALL
), histograms AS (
  SELECT * FROM (WITH {histogram_sql("cleaned", {c: c for c in INCIDENT_NUMBERS})})
)
SELECT 'missing' AS part, name, NULL AS entry, round(value, 9) AS value FROM gaps
UNION ALL SELECT 'category', name, entry, n::DOUBLE FROM tops QUALIFY row_number() OVER (PARTITION BY name ORDER BY n DESC, entry) <= 20
UNION ALL SELECT 'histogram', "column", CAST(bin AS VARCHAR), "count"::DOUBLE FROM histograms
UNION ALL SELECT 'bounds', "column", CAST(bin AS VARCHAR), low FROM histograms
"""


@query("l01_profile", PROFILE_SQL)
def l01_profile(spark, sf):
    """Missing shares, histograms and categories of the cleaned table as one long table."""
    config = EdaConfig(iqr_clip=False, zscore_winsor=False, drop_any_missing=False, use_us_holidays=False)
    tables = run_eda(spark, incidents(spark, sf), config=config, as_of="2001-09-01", key="inc_id")[1]

    def part(name, of, entry, value):
        return tables[of].select(F.lit(name).alias("part"), F.col("column").alias("name"), entry.cast("string").alias("entry"), value.cast("double").alias("value"))

    gaps = part("missing", "missingness", F.lit(None), F.round("fraction", 9)).filter(F.col("name").isin(*PROFILE_COLUMNS))
    found = [part("histogram", "histograms", F.col("bin"), F.col("count")), part("bounds", "histograms", F.col("bin"), F.round("low", 6))]
    numbers = [f.filter(F.col("name").isin(*INCIDENT_NUMBERS)) for f in found]
    return gaps.unionByName(part("category", "top_categories", F.col("value"), F.col("count"))).unionByName(numbers[0]).unionByName(numbers[1])
