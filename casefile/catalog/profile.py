"""Column profiles, associations and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from casefile.catalog.registry import query
from casefile.catalog.tables import SCORES_SQL, WITH_INCIDENTS, incidents, scores, table
from casefile.functions import dates
from casefile.operators import profiling
from casefile.operators.series import count_per_day, daily_counts, fill_days, series_summary

INCIDENT_NUMBERS = ("lat", "lon", "vict_age", "loss")


def _rounded(df, digits: int = 6, *names: str):
    return df.select(*[F.round(c, digits).alias(c) if c in names else c for c in df.columns])


@query(
    "a01_missingness",
    f"{WITH_INCIDENTS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 9) AS fraction FROM incidents"
        for c in ("inc_id", "date_occ", "time_occ", "date_rptd", "lat", "lon", "crm_cd_desc", "status_desc", "vict_age", "loss", "const_col")
    ),
)
def a01(spark, sf):
    return _rounded(profiling.missingness(incidents(spark, sf)), 9, "fraction")


def histogram_sql(source: str, columns: dict[str, str]) -> str:
    parts = " UNION ALL ".join(f"SELECT '{n}' AS \"column\", CAST({e} AS DOUBLE) AS x FROM {source} WHERE {e} IS NOT NULL" for n, e in columns.items())
    return f"""
    v AS ({parts}),
    ends AS (SELECT "column", CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo, CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
             FROM v GROUP BY "column"),
    bins AS (
      SELECT "column", CAST(range AS INTEGER) AS bin, lo + range * ((hi - lo) / 30) AS low,
        CASE WHEN range = 29 THEN hi ELSE lo + (range + 1) * ((hi - lo) / 30) END AS high FROM ends, range(0, 30))
    SELECT b."column", b.bin, round(b.low, 6) AS low, round(b.high, 6) AS high, count(v.x) AS "count"
    FROM bins b LEFT JOIN v ON v."column" = b."column" AND v.x >= b.low AND (v.x < b.high OR (b.bin = 29 AND v.x <= b.high))
    GROUP BY ALL
    """


@query("a02_histograms", f"{WITH_INCIDENTS}, " + histogram_sql("incidents", {c: c for c in INCIDENT_NUMBERS}))
def a02(spark, sf):
    return _rounded(profiling.numeric_histograms(incidents(spark, sf), INCIDENT_NUMBERS), 6, "low", "high")


@query(
    "a02_histograms_lineitem",
    "WITH " + histogram_sql("lineitem", {c: c for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}),
)
def a02_lineitem(spark, sf):
    return _rounded(profiling.numeric_histograms(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]), 6, "low", "high")


@query("a03_top_categories", f"{WITH_INCIDENTS} SELECT coalesce(crm_cd_desc, 'None') AS value, count(*) AS \"count\" FROM incidents GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 20")
def a03(spark, sf):
    return profiling.top_categories(incidents(spark, sf), "crm_cd_desc")


@query(
    "a03_top_categories_many",
    """
    WITH v AS (SELECT 'p_brand' AS "column", p_brand AS value FROM part UNION ALL SELECT 'p_type', p_type FROM part UNION ALL SELECT 'p_name', p_name FROM part),
    c AS (SELECT "column", value, count(*) AS "count" FROM v GROUP BY ALL)
    SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY "count" DESC, value) <= 20
    """,
)
def a03_many(spark, sf):
    return profiling.top_categories_of(table(spark, sf, "part"), ["p_brand", "p_type", "p_name", "not_there"])


def _pearson_sql(columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, 'pearson' AS measure, round(corr({a}, {b}), 6) AS value FROM incidents" for a in columns for b in columns
    )


@query("a04_pearson", f"{WITH_INCIDENTS} " + _pearson_sql(INCIDENT_NUMBERS))
def a04(spark, sf):
    return _rounded(profiling.pearson(incidents(spark, sf), INCIDENT_NUMBERS), 6, "value")


def _nmi_sql(source: str, columns: tuple[str, ...], label: str = "nmi") -> str:
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, coalesce({a}, 'None') AS x, coalesce({b}, 'None') AS y FROM {source}" for a in columns for b in columns
    )
    return f"""
    pairs AS ({pairs}),
    xy AS (SELECT a, b, x, y, count(*)::DOUBLE AS n FROM pairs GROUP BY ALL),
    m AS (SELECT *, sum(n) OVER (PARTITION BY a, b) AS t, sum(n) OVER (PARTITION BY a, b, x) AS nx, sum(n) OVER (PARTITION BY a, b, y) AS ny FROM xy),
    i AS (SELECT a, b, sum(n / t * ln(n * t / (nx * ny))) AS mi, sum(-n / t * ln(nx / t)) AS hx, sum(-n / t * ln(ny / t)) AS hy FROM m GROUP BY a, b),
    {label} AS (SELECT a, b, 'nmi' AS measure, round(mi / ((hx + hy) / 2), 6) AS value FROM i)
    """


@query("a05_mutual_information", f"{WITH_INCIDENTS}, {_nmi_sql('incidents', ('crm_cd_desc', 'status_desc', 'date_occ'))} SELECT * FROM nmi")
def a05(spark, sf):
    return _rounded(profiling.mutual_information(incidents(spark, sf), ["crm_cd_desc", "status_desc", "date_occ"]), 6, "value")


def _anova_sql(source: str, numbers: tuple[str, ...], groups: tuple[str, ...], digits: int) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, coalesce({b}, 'None') AS g, coalesce({a}::DOUBLE, (SELECT quantile_cont({a}::DOUBLE, 0.5) FROM {source})) AS x FROM {source}"
        for a in numbers for b in groups
    )
    return f"""
    rows_ AS ({rows}),
    g AS (SELECT a, b, g, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM rows_ GROUP BY ALL),
    w AS (SELECT *, sum(n * m) OVER (PARTITION BY a, b) / sum(n) OVER (PARTITION BY a, b) AS grand FROM g),
    anova AS (
      SELECT a, b, 'anova_f' AS measure, round((sum(n * (m - grand) ** 2) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), {digits}) AS value
      FROM w GROUP BY a, b)
    """


@query("a06_anova_f", f"{WITH_INCIDENTS}, {_anova_sql('incidents', INCIDENT_NUMBERS, ('crm_cd_desc', 'status_desc'), 5)} SELECT * FROM anova")
def a06(spark, sf):
    return _rounded(profiling.anova_f(incidents(spark, sf), INCIDENT_NUMBERS, ["crm_cd_desc", "status_desc"]), 5, "value")


@query(
    "a07_mixed_association",
    f"""
    {WITH_INCIDENTS}, {_nmi_sql('incidents', ('crm_cd_desc', 'status_desc'))},
    {_anova_sql('incidents', ('vict_age', 'loss'), ('crm_cd_desc', 'status_desc'), 5)}
    {_pearson_sql(('vict_age', 'loss'))} UNION ALL SELECT * FROM nmi UNION ALL SELECT * FROM anova
    """,
)
def a07(spark, sf):
    df = incidents(spark, sf).select("date_occ", "crm_cd_desc", "status_desc", "vict_age", "loss")
    long = profiling.mixed_association(df)
    return long.withColumn("value", F.when(F.col("measure") == "anova_f", F.round("value", 5)).otherwise(F.round("value", 6)))


@query(
    "a08_hour_day_pivot",
    "SELECT CAST(isodow(ts) - 1 AS INTEGER) AS weekday, " + ", ".join(f"count(*) FILTER (WHERE hour(ts) = {h}) AS h{h}" for h in range(24))
    + " FROM events GROUP BY 1",
)
def a08(spark, sf):
    return profiling.hour_day_pivot(table(spark, sf, "events").select(F.weekday("ts").alias("weekday"), F.hour("ts").alias("hour")))


def _daily_sql(source: str, ts: str, key: str | None, where: str = "true", kind: str = "BIGINT") -> str:
    k, group = (f"{key}, ", f"{key}, ") if key else ("", "")
    on = f"s.{key} = c.{key} AND " if key else ""
    head = f"s.{key}, " if key else ""
    by = f"GROUP BY {key}" if key else ""
    return f"""
    c AS (SELECT {k}CAST({ts} AS DATE) AS ds, count(*) AS n FROM {source} WHERE {where} GROUP BY {group}CAST({ts} AS DATE)),
    spine AS (SELECT {k}CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds FROM c {by}),
    series AS (SELECT {head}s.ds, CAST(coalesce(c.n, 0) AS {kind}) AS y FROM spine s LEFT JOIN c ON {on}s.ds = c.ds)
    """


@query("a09_rows_per_day", f"WITH {_daily_sql('orders', 'o_orderdate', None)} SELECT * FROM series")
def a09(spark, sf):
    return count_per_day(table(spark, sf, "orders"), F.col("o_orderdate"))


@query("a10_daily_counts", f"WITH {_daily_sql('events', 'ts', 'event_type', kind='DOUBLE')} SELECT * FROM series")
def a10(spark, sf):
    return daily_counts(table(spark, sf, "events"), ["event_type"], "ts")


@query(
    "a10_daily_counts_best_date",
    f"""
    {WITH_INCIDENTS}, t AS (SELECT try_cast(date_rptd AS TIMESTAMP) AS ts FROM incidents),
    {_daily_sql('t', 'ts', None, "ts BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2001-03-01'", 'DOUBLE')} SELECT * FROM series
    """,
)
def a10_best(spark, sf):
    return daily_counts(incidents(spark, sf), as_of="2001-03-01")


@query(
    "j01_date_spine",
    f"""
    WITH o AS (SELECT o_orderdate, concat(o_orderstatus, ':', o_orderpriority) AS kind FROM orders),
    {_daily_sql('o', 'o_orderdate', 'kind')} SELECT * FROM series
    """,
)
def j01(spark, sf):
    # many days of these series have no order
    kind = F.concat("o_orderstatus", F.lit(":"), "o_orderpriority").alias("kind")
    counts = table(spark, sf, "orders").groupBy(kind, F.col("o_orderdate").cast("date").alias("ds")).agg(F.count(F.lit(1)).alias("y"))
    return fill_days(counts, ["kind"])


@query(
    "j02_weekend_holidays",
    """
    SELECT event_type, count(*) FILTER (WHERE isodow(ts) >= 6) AS weekend,
      count(*) FILTER (WHERE CAST(ts AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15')) AS holiday FROM events GROUP BY event_type
    """,
)
def j02(spark, sf):
    marked = dates.add_time_features(table(spark, sf, "events").select("event_type", "ts"), "ts")
    return marked.groupBy("event_type").agg(F.count_if(F.col("is_weekend") == 1).alias("weekend"), F.count_if(F.col("is_holiday") == 1).alias("holiday"))


@query("a11_class_distribution", "SELECT l_returnflag AS label, count(*) AS \"count\" FROM lineitem GROUP BY ALL")
def a11(spark, sf):
    return profiling.class_distribution(table(spark, sf, "lineitem"), "l_returnflag")


@query("a12_distinct_count", f"{WITH_INCIDENTS} SELECT count(DISTINCT date_occ) AS n_distinct FROM incidents")
def a12(spark, sf):
    return profiling.distinct_count(incidents(spark, sf), "date_occ")


@query(
    "a13_series_summary",
    f"""
    WITH {_daily_sql('orders', 'o_orderdate', 'o_orderstatus')}
    SELECT o_orderstatus, min(ds) AS first_day, max(ds) AS last_day, count(*) AS n, round(avg(y), 9) AS mean, round(stddev_samp(y), 9) AS sd,
      count(*) FILTER (WHERE y = 0) AS zero_days FROM series GROUP BY o_orderstatus
    """,
)
def a13(spark, sf):
    series = count_per_day(table(spark, sf, "orders"), F.col("o_orderdate"), ["o_orderstatus"])
    return _rounded(series_summary(series, ["o_orderstatus"]), 9, "mean", "sd")


@query(
    "a16_class_weights",
    """
    WITH c AS (SELECT l_returnflag AS label, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT label, n AS "count", round(sum(n) OVER () / (count(*) OVER () * n), 9) AS weight FROM c
    """,
)
def a16(spark, sf):
    return _rounded(profiling.class_weights(table(spark, sf, "lineitem"), "l_returnflag"), 9, "weight")


@query(
    "a16_positive_weight",
    f"""
    WITH s AS ({SCORES_SQL}), w AS (SELECT count(*) FILTER (WHERE label = 0) / count(*) FILTER (WHERE label = 1) AS r FROM s)
    SELECT doc_id, round(CASE WHEN label = 1 THEN r ELSE 1.0 END, 9) AS weight FROM s, w
    """,
)
def a16_positive(spark, sf):
    df = scores(spark, sf)
    ratio = profiling.positive_weight(df, "label")
    return df.select("doc_id", F.round(F.when(F.col("label") == 1, F.lit(ratio)).otherwise(1.0), 9).alias("weight"))
