"""Samples, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from casefile.catalog.registry import query
from casefile.catalog.tables import WITH_INCIDENTS, incidents, table
from casefile.config import MLConfig
from casefile.operators import sampling
from casefile.operators.ranking import order_hash
from casefile.operators.series import count_per_day


def _hash(key: str) -> str:
    return f"md5(concat('42:', CAST({key} AS VARCHAR)))"


@query("m01_simple_sample", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_hash('o_orderkey')} LIMIT 1000")
def m01(spark, sf):
    return sampling.simple_sample(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 1000, "o_orderkey")


@query(
    "m02_sample_for_task",
    f"""
    {WITH_INCIDENTS}, t AS (SELECT least(1.0::DOUBLE, 2000 / count(*)) AS f FROM incidents),
    r AS (SELECT inc_id, crm_cd_desc, row_number() OVER (PARTITION BY crm_cd_desc ORDER BY {_hash('inc_id')}) AS rn,
            count(*) OVER (PARTITION BY crm_cd_desc) AS n FROM incidents WHERE crm_cd_desc IS NOT NULL)
    SELECT inc_id, crm_cd_desc FROM r, t WHERE rn <= greatest(1, floor(n * f))
    """,
)
def m02(spark, sf):
    return sampling.sample_for_task(incidents(spark, sf).select("inc_id", "crm_cd_desc"), "crm_cd_desc", 2000, "inc_id")


BY_TARGET_SQL = f"""
    {WITH_INCIDENTS}, r AS (
      SELECT inc_id, crm_cd_desc, row_number() OVER (PARTITION BY crm_cd_desc ORDER BY {_hash('inc_id')}) AS rn,
        count(*) OVER (PARTITION BY crm_cd_desc) AS n, count(*) OVER () AS total FROM incidents WHERE crm_cd_desc IS NOT NULL)
    SELECT inc_id, crm_cd_desc FROM r WHERE total <= 3000 OR rn <= greatest(1, floor(n / total::DOUBLE * 3000))
"""


@query("m03_sample_by_target", BY_TARGET_SQL)
def m03(spark, sf):
    return sampling.sample_by_target(incidents(spark, sf).select("inc_id", "crm_cd_desc"), "crm_cd_desc", 3000, "inc_id")


def _dual_sql(share: str) -> str:
    return f"""
    WITH r AS (
      SELECT c_custkey, c_mktsegment, c_nationkey, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY {_hash('c_custkey')}) AS rn,
        count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) AS n, count(*) OVER (PARTITION BY c_nationkey) AS stratum, count(*) OVER () AS total,
        (SELECT count(DISTINCT c_nationkey) FROM customer) AS strata FROM customer),
    s AS (SELECT *, {share} AS share FROM r)
    SELECT c_custkey, c_mktsegment, c_nationkey FROM s
    WHERE total <= 500 OR stratum <= share OR rn <= greatest(1, floor(n / stratum::DOUBLE * share))
    """


@query("m04_dual_proportional", _dual_sql("greatest(1, floor(stratum / total::DOUBLE * 500))"))
def m04(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return sampling.sample_dual(df, "c_mktsegment", "c_nationkey", 500, key="c_custkey")


@query("m04_dual_equalized", _dual_sql("greatest(1, 500 // strata)"))
def m04_equal(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return sampling.sample_dual(df, "c_mktsegment", "c_nationkey", 500, equalize=True, key="c_custkey")


@query("m05_prepare_sample", BY_TARGET_SQL)
def m05(spark, sf):
    df = incidents(spark, sf).select("inc_id", "crm_cd_desc")
    return sampling.prepare_sample(df, "crm_cd_desc", MLConfig(sample_n=3000), "inc_id")


@query("m06_shuffled", f"SELECT o_orderkey, {_hash('o_orderkey')} AS place FROM orders")
def m06(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey")
    return sampling.shuffled(df.withColumn("place", order_hash(df, "o_orderkey", 42)), "o_orderkey")


@query(
    "m07_train_test_split",
    f"""
    WITH r AS (
      SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_hash('o_orderkey')}) AS rn,
        count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
    SELECT o_orderkey, o_orderstatus, rn <= round(n * 0.2) AS is_test FROM r
    """,
)
def m07(spark, sf):
    return sampling.mark_test_rows(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", 0.2, "o_orderkey")


@query(
    "m08_stratified_folds",
    f"""
    SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (ORDER BY o_orderstatus, {_hash('o_orderkey')}) - 1) % 5 AS INTEGER) AS fold FROM orders
    """,
)
def m08(spark, sf):
    return sampling.assign_folds(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", 5, "o_orderkey")


@query(
    "m09_rolling_splits",
    """
    WITH n AS (SELECT o_orderstatus, CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) + 1 AS INTEGER) AS n FROM orders GROUP BY o_orderstatus),
    p AS (SELECT o_orderstatus, n, CAST(unnest([n - 90, n - 60, n - 30]) AS INTEGER) AS start FROM n)
    SELECT o_orderstatus, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY start) AS INTEGER) AS split, start, 3 AS n_splits FROM p
    """,
)
def m09(spark, sf):
    series = count_per_day(table(spark, sf, "orders"), F.col("o_orderdate"), ["o_orderstatus"])
    return sampling.rolling_splits(series, ["o_orderstatus"], 30, 90, 3)
