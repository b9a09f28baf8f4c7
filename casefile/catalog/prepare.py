"""Reading, schema, dates and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from casefile.catalog.registry import query
from casefile.catalog.tables import AS_OF, INCIDENTS_SQL, SCORES_SQL, WITH_INCIDENTS, incidents, scores, table
from casefile.functions import dates, hexgrid
from casefile.functions.values import col, safe_file_name
from casefile.operators import cleaning, ranking, schema
from casefile.operators.cluster_scores import combination_label, parse_combination
from casefile.operators.series import count_per_day
from casefile.session import scratch_folder as scratch
from casefile.sources import load_table, save_records_json, save_result_csv, save_table

# ---- sources and sinks ------------------------------------------------------


@query(
    "s01_read_csv",
    """
    SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, CAST(sum(o_custkey) AS BIGINT) AS custkeys
    FROM orders GROUP BY o_orderstatus
    """,
)
def s01(spark, sf):
    path = save_table(table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_totalprice"), f"{scratch(spark)}.csv.gz")
    read = load_table(spark, path)
    return read.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.sum("o_custkey").alias("custkeys")
    )


@query("s02_read_parquet", "SELECT p_partkey, p_brand, p_retailprice FROM part WHERE p_size > 25")
def s02(spark, sf):
    return load_table(spark, f"{sf}/part.parquet").filter("p_size > 25").select("p_partkey", "p_brand", "p_retailprice")


@query("s03_accept_table", "SELECT s_suppkey, s_acctbal FROM supplier")
def s03(spark, sf):
    return load_table(spark, table(spark, sf, "supplier")).select("s_suppkey", "s_acctbal")


@query("s05_save_table", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def s05(spark, sf):
    wanted = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return load_table(spark, save_table(wanted, f"{scratch(spark)}.parquet"))


@query("s06_save_result_csv", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def s06(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    path = save_result_csv(counts, scratch(spark))
    return spark.read.option("header", True).schema("o_orderpriority string, n bigint").csv(path)


@query("s07_save_records_json", "SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY event_type")
def s07(spark, sf):
    records = table(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.max("ts").alias("_newest")
    )
    return spark.read.schema("event_type string, n bigint, mean double").json(save_records_json(records, scratch(spark)))


# ---- schema -----------------------------------------------------------------


@query("p01_normalize_columns", f"{WITH_INCIDENTS} SELECT inc_id, date_occ, crm_cd_desc AS crm_cd_1, loss AS a_b_ FROM incidents")
def p01(spark, sf):
    raw = incidents(spark, sf).select("inc_id", "date_occ", "crm_cd_desc", "loss").toDF("Inc ID", " DATE OCC ", "Crm Cd 1", "a--b!")
    return schema.normalize_columns(raw)


@query("p02_coordinate_columns", f"{WITH_INCIDENTS} SELECT inc_id, lat AS found_lat, lon AS found_lon FROM incidents")
def p02(spark, sf):
    df = incidents(spark, sf).withColumnRenamed("lat", "latitude").withColumnRenamed("lon", "lng")
    lat, lon = schema.coordinate_columns(df)
    return df.select("inc_id", col(lat).alias("found_lat"), col(lon).alias("found_lon"))


@query(
    "p03_parse_any_date",
    """
    SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS from_seconds, CAST(o_orderdate AS TIMESTAMP) AS from_millis,
      CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS from_text,
      CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 13 HOUR + INTERVAL 5 MINUTE END AS from_clock
    FROM orders
    """,
)
def p03(spark, sf):
    day = F.col("o_orderdate").cast("date")
    seconds = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    bad = F.col("o_orderkey") % 5 == 0
    df = table(spark, sf, "orders").select(
        "o_orderkey", seconds.alias("from_seconds"), (seconds * 1000).cast("double").alias("from_millis"),
        F.when(bad, "n/a").otherwise(F.date_format(day, "MM/dd/yyyy")).alias("from_text"),
        F.when(bad, "13/45/99").otherwise(F.concat(F.date_format(day, "MM/dd/yyyy"), F.lit(" 01:05:00 PM"))).alias("from_clock"),
    )
    names = ["from_seconds", "from_millis", "from_text", "from_clock"]
    units = dates.epoch_units(df, names[:2])
    return df.select("o_orderkey", *[dates.parse_date(df, n, units).alias(n) for n in names])


HHMM_SQL = """
    CAST(try_cast(date_occ AS DATE) AS TIMESTAMP)
      + INTERVAL 1 HOUR * least(coalesce(time_occ, 0) // 100, 23) + INTERVAL 1 MINUTE * least(coalesce(time_occ, 0) % 100, 59)
"""


@query("p04_combine_date_time", f"{WITH_INCIDENTS} SELECT inc_id, {HHMM_SQL} AS numeric_time, {HHMM_SQL} AS text_time FROM incidents")
def p04(spark, sf):
    df = incidents(spark, sf).withColumn("text_occ", F.concat(F.col("time_occ").cast("string"), F.lit(".0")))
    return df.select(
        "inc_id", dates.combine_date_time(df, "date_occ", "time_occ").alias("numeric_time"),
        dates.combine_date_time(df, "date_occ", "text_occ").alias("text_time"),
    )


@query(
    "p05_best_date_column",
    f"""
    {WITH_INCIDENTS},
    parsed AS (
      SELECT 'date_occ' AS candidate, 0 AS position, try_cast(date_occ AS TIMESTAMP) AS ts FROM incidents
      UNION ALL SELECT 'date_rptd', 1, try_cast(date_rptd AS TIMESTAMP) FROM incidents
      UNION ALL SELECT 'date_occ+time_occ', 2, {HHMM_SQL} FROM incidents),
    days AS (
      SELECT candidate, position, CAST(ts AS DATE) AS day, count(*) AS n,
        count(*) FILTER (WHERE ts BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '{AS_OF}') AS good
      FROM parsed GROUP BY ALL),
    rates AS (
      SELECT candidate, position, sum(n) FILTER (WHERE day IS NOT NULL) / sum(n) AS valid_rate,
        sum(good) / sum(n) FILTER (WHERE day IS NOT NULL) AS good_share,
        max(n) FILTER (WHERE day IS NOT NULL) / sum(n) FILTER (WHERE day IS NOT NULL) AS top_share
      FROM days GROUP BY candidate, position),
    scored AS (
      SELECT *, valid_rate * (0.5 + 0.5 * good_share) - CASE WHEN top_share > 0.8 THEN 0.5 ELSE 0 END AS score FROM rates)
    SELECT candidate, round(valid_rate, 9) AS valid_rate, round(good_share, 9) AS good_share, round(top_share, 9) AS top_share,
      round(score, 9) AS score, CAST(row_number() OVER (ORDER BY score DESC, position) = 1 AS INTEGER) AS chosen
    FROM scored
    """,
)
def p05(spark, sf):
    scored = schema.score_date_columns(incidents(spark, sf), AS_OF)
    rounded = [F.round(c, 9).alias(c) for c in ("valid_rate", "good_share", "top_share", "score")]
    return scored.select("candidate", *rounded, "chosen")


@query(
    "p05_fixed_date",
    f"{WITH_INCIDENTS} SELECT inc_id, try_cast(date_rptd AS TIMESTAMP) AS date_fixed FROM incidents",
)
def p05_fixed(spark, sf):
    return schema.add_fixed_date(incidents(spark, sf), AS_OF).select("inc_id", "date_fixed")


@query(
    "p06_guess_datetime_column",
    f"{WITH_INCIDENTS} SELECT 'opened' AS guessed, CAST(date_occ AS DATE) AS day, count(*) AS n FROM incidents GROUP BY day",
)
def p06(spark, sf):
    # no known name is left, so the parse rates decide
    df = incidents(spark, sf).select("status_desc", "crm_cd_desc", F.col("date_occ").alias("opened"), F.col("date_rptd").alias("closed"))
    name = schema.infer_datetime_column(df)
    return df.groupBy(F.lit(name).alias("guessed"), dates.parse_date(df, name).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p07_infer_datetime_columns",
    f"{WITH_INCIDENTS} SELECT 'date_occ' AS inferred, CAST(date_occ AS TIMESTAMP) AS parsed, inc_id FROM incidents",
)
def p07(spark, sf):
    df, name = schema.infer_datetime_columns(incidents(spark, sf))
    return df.select(F.lit(name).alias("inferred"), dates.parse_date(df, name).alias("parsed"), "inc_id")


@query(
    "p08_time_features",
    f"""
    {WITH_INCIDENTS}, dated AS (SELECT inc_id, {HHMM_SQL} AS ts FROM incidents)
    SELECT inc_id, ts AS date_dt, date_trunc('day', ts)::TIMESTAMP AS date, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
      CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour,
      CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend
    FROM dated
    """,
)
def p08(spark, sf):
    df = incidents(spark, sf)
    dated = df.withColumn("date_dt", dates.combine_date_time(df, "date_occ", "time_occ"))
    dated = dated.withColumn("date", dates.midnight(F.col("date_dt")))
    featured = dates.add_time_features(dated, "date_dt", use_us_holidays=False)
    return featured.select("inc_id", "date_dt", "date", "year", "month", "weekday", "hour", "is_weekend")


# Federal holidays written out once more, with weekend shifts, for the checks.
HOLIDAYS_SQL = """
years AS (SELECT CAST(range AS INTEGER) AS y FROM range(1990, 2031)),
firsts AS (SELECT y, m, make_date(y, m, 1) AS f FROM years, (SELECT CAST(range AS INTEGER) AS m FROM range(1, 13))),
fixed AS (
  SELECT make_date(y, md.m, md.d) AS day FROM years, (VALUES (1, 1, 0), (6, 19, 2021), (7, 4, 0), (11, 11, 0), (12, 25, 0)) md(m, d, since)
  WHERE y >= md.since),
holidays AS (
  SELECT CAST(CASE isodow(day) WHEN 6 THEN day - 1 WHEN 7 THEN day + 1 ELSE day END AS DATE) AS day FROM fixed
  UNION SELECT CAST(f + CAST((7 + r.dow - isodow(f)) % 7 + 7 * (r.n - 1) AS INTEGER) AS DATE) FROM firsts,
    (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) r(m, dow, n) WHERE firsts.m = r.m
  UNION SELECT CAST(last_day(f) - CAST(isodow(last_day(f)) - 1 AS INTEGER) AS DATE) FROM firsts WHERE m = 5)
"""


@query(
    "p09_series_features",
    f"""
    WITH {HOLIDAYS_SQL}, c AS (SELECT CAST(o_orderdate AS DATE) AS ds, count(*) AS n FROM orders GROUP BY ds),
    spine AS (SELECT CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds FROM c)
    SELECT s.ds, CAST(coalesce(n, 0) AS BIGINT) AS y, CAST(isodow(s.ds) - 1 AS INTEGER) AS dow, CAST(month(s.ds) AS INTEGER) AS month,
      CASE WHEN isodow(s.ds) >= 6 THEN 1 ELSE 0 END AS is_weekend, CASE WHEN s.ds IN (SELECT day FROM holidays) THEN 1 ELSE 0 END AS is_holiday
    FROM spine s LEFT JOIN c ON s.ds = c.ds
    """,
)
def p09(spark, sf):
    return dates.add_series_features(count_per_day(table(spark, sf, "orders"), F.col("o_orderdate")))


@query(
    "p10_holiday_flag",
    f"""
    WITH {HOLIDAYS_SQL}
    SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) IN (SELECT day FROM holidays) THEN 1 ELSE 0 END AS is_holiday FROM orders
    """,
)
def p10(spark, sf):
    return dates.add_holiday_flag(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "is_holiday")


@query("p12_drop_constant", f"{WITH_INCIDENTS} SELECT * EXCLUDE (const_col) FROM incidents")
def p12(spark, sf):
    return schema.drop_constant(incidents(spark, sf))


@query("p13_drop_columns", f"{WITH_INCIDENTS} SELECT inc_id, status_desc, loss FROM incidents")
def p13(spark, sf):
    df = incidents(spark, sf).select("inc_id", "status_desc", "loss", "vict_age")
    return schema.drop_columns(df, ["vict_age", "not_there"])


@query(
    "p14_low_cardinality",
    """
    WITH n AS (SELECT count(DISTINCT p_name) AS a, count(DISTINCT p_brand) AS b, count(DISTINCT p_type) AS c FROM part)
    SELECT 'p_name' AS kept FROM n WHERE a <= 30 UNION ALL SELECT 'p_brand' FROM n WHERE b <= 30 UNION ALL SELECT 'p_type' FROM n WHERE c <= 30
    """,
)
def p14(spark, sf):
    kept = schema.low_cardinality(table(spark, sf, "part"), ["p_name", "p_brand", "p_type"], 30)
    return spark.createDataFrame([(c,) for c in kept], "kept string")


@query("p15_bool_to_int", "SELECT p_partkey, CAST(p_size > 25 AS INTEGER) AS is_big FROM part")
def p15(spark, sf):
    return schema.bool_to_int(table(spark, sf, "part").select("p_partkey", (F.col("p_size") > 25).alias("is_big")))


@query(
    "p16_downcast_numeric",
    """
    SELECT l_orderkey AS k, l_linenumber AS n, l_quantity AS q, CAST(round(l_extendedprice * 4) / 4 AS DOUBLE) AS quarter, l_discount AS d,
      CASE WHEN (SELECT max(l_orderkey) FROM lineitem) < 32768 THEN 'smallint' ELSE 'int' END || ',tinyint,tinyint,float,double' AS types
    FROM lineitem
    """,
)
def p16(spark, sf):
    df = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("q"),
        (F.rint(F.col("l_extendedprice") * 4) / 4).alias("quarter"), F.col("l_discount").alias("d"),
    )
    small = schema.downcast_numeric(df)
    types = ",".join(f.dataType.simpleString() for f in small.schema.fields)
    # back to the wide types, so that the check compares the values
    return small.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in df.schema.fields], F.lit(types).alias("types"))


@query(
    "p17_hex_cells",
    f"""
    {WITH_INCIDENTS}, xy AS (
      SELECT lon * cos(radians(34.0)) * 111195.07973436875 AS x, lat * 111195.07973436875 AS y FROM incidents WHERE lat IS NOT NULL AND lon IS NOT NULL),
    axial AS (SELECT (sqrt(3.0::DOUBLE) / 3 * x - y / 3) / 460.0 AS q, (y * 2 / 3) / 460.0 AS r FROM xy),
    cube AS (SELECT q, r, -q - r AS s, round(q) AS rq, round(r) AS rr, round(-q - r) AS rs FROM axial),
    far AS (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs - s) AS ds FROM cube),
    cells AS (
      SELECT CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS cq,
        CASE WHEN dq > dr AND dq > ds THEN rr WHEN dr > ds THEN -rq - rs ELSE rr END AS cr FROM far)
    SELECT concat(CAST(cq AS BIGINT), ':', CAST(cr AS BIGINT)) AS hex, count(*) AS "count" FROM cells GROUP BY hex
    """,
)
def p17(spark, sf):
    df = incidents(spark, sf)
    return hexgrid.count_by_cell(hexgrid.add_hex_cell(df, *schema.coordinate_columns(df)))


@query(
    "p18_combination_labels",
    """
    SELECT concat(l_returnflag, ' + ', l_linestatus, ' (eps=', l_discount, '_min=', l_linenumber, ')') AS combination, l_returnflag AS embedding,
      l_linestatus AS algorithm, l_discount AS eps, l_linenumber AS min_samples, count(*) AS n FROM lineitem GROUP BY ALL
    """,
)
def p18(spark, sf):
    config = F.concat(F.lit("eps="), F.col("l_discount").cast("string"), F.lit("_min="), F.col("l_linenumber").cast("string"))
    label = combination_label(F.col("l_returnflag"), F.col("l_linestatus"), config)
    parts = parse_combination(F.col("combination"))
    wanted = [parts[c].alias(c) for c in ("embedding", "algorithm", "eps", "min_samples")]
    return table(spark, sf, "lineitem").groupBy(label.alias("combination")).agg(F.count(F.lit(1)).alias("n")).select("combination", *wanted, "n")


@query(
    "x03_safe_file_name",
    "SELECT p_partkey, regexp_replace(concat(p_name, ' / ', p_type), '[^\\p{L}\\p{N}._-]', '_', 'g') AS safe FROM part",
)
def x03(spark, sf):
    return table(spark, sf, "part").select("p_partkey", safe_file_name(F.concat("p_name", F.lit(" / "), "p_type")).alias("safe"))


# ---- cleaning ---------------------------------------------------------------


@query(
    "c01_date_range",
    f"""
    {WITH_INCIDENTS} SELECT inc_id, try_cast(date_rptd AS TIMESTAMP) AS ts FROM incidents
    WHERE try_cast(date_rptd AS TIMESTAMP) BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '{AS_OF}'
    """,
)
def c01(spark, sf):
    df = incidents(spark, sf)
    return cleaning.filter_date_range(df.select("inc_id", dates.parse_date(df, "date_rptd").alias("ts")), F.col("ts"), as_of=AS_OF)


@query(
    "c02_date_range_or_widen",
    "SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1990-01-01' AND TIMESTAMP '1999-12-31'",
)
def c02(spark, sf):
    # nothing is dated in the first window, so the second one applies
    return cleaning.filter_date_range_or_widen(table(spark, sf, "orders"), F.col("o_orderdate"), "1999-12-31").select("o_orderkey")


@query("c03_drop_missing_target", f"{WITH_INCIDENTS} SELECT inc_id, crm_cd_desc, vict_age FROM incidents WHERE crm_cd_desc IS NOT NULL")
def c03(spark, sf):
    return cleaning.drop_missing(incidents(spark, sf).select("inc_id", "crm_cd_desc", "vict_age"), ["crm_cd_desc"])


@query("c04_dropna_any", f"{WITH_INCIDENTS} SELECT * FROM incidents WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in ("date_occ", "time_occ", "lat", "lon", "crm_cd_desc", "vict_age")))
def c04(spark, sf):
    return cleaning.drop_missing(incidents(spark, sf))


@query("c05_dedupe", INCIDENTS_SQL)
def c05(spark, sf):
    df = incidents(spark, sf)
    return cleaning.deduplicate(df.unionByName(df.filter("inc_id % 10 = 0")))


@query(
    "c06_coord_issues",
    f"""
    {WITH_INCIDENTS}
    SELECT 'zero_zero_coords' AS issue, count(*) AS "count" FROM incidents WHERE coalesce(lat, 0) = 0 AND coalesce(lon, 0) = 0 HAVING count(*) > 0
    UNION ALL SELECT 'outside_LA_bbox', count(*) FROM incidents
    WHERE NOT coalesce(lat BETWEEN 33.3 AND 34.9 AND lon BETWEEN -119.1 AND -117.5, false) HAVING count(*) > 0
    """,
)
def c06(spark, sf):
    df = incidents(spark, sf)
    return cleaning.coordinate_issues(df, *schema.coordinate_columns(df))


@query(
    "c06_drop_bad_coords",
    f"{WITH_INCIDENTS} SELECT inc_id, lat, lon FROM incidents WHERE lat BETWEEN 33.3 AND 34.9 AND lon BETWEEN -119.1 AND -117.5",
)
def c06_drop(spark, sf):
    return cleaning.drop_bad_coordinates(incidents(spark, sf).select("inc_id", "lat", "lon"), "lat", "lon")


@query(
    "c07_iqr_clip",
    f"""
    {WITH_INCIDENTS}, q AS (
      SELECT quantile_cont(loss, 0.25) AS a, quantile_cont(loss, 0.75) AS b, quantile_cont(vict_age::DOUBLE, 0.25) AS c,
        quantile_cont(vict_age::DOUBLE, 0.75) AS d FROM incidents)
    SELECT inc_id, round(greatest(least(loss, b + 1.5 * (b - a)), a - 1.5 * (b - a)), 4) AS loss,
      CASE WHEN vict_age IS NOT NULL THEN round(greatest(least(vict_age::DOUBLE, d + 1.5 * (d - c)), c - 1.5 * (d - c)), 4) END AS vict_age
    FROM incidents, q
    """,
)
def c07(spark, sf):
    clipped = cleaning.iqr_clip(incidents(spark, sf).select("inc_id", "loss", "vict_age"), ["loss", "vict_age"])
    return clipped.select("inc_id", F.round("loss", 4).alias("loss"), F.round("vict_age", 4).alias("vict_age"))


@query(
    "c08_zscore_winsor",
    f"""
    {WITH_INCIDENTS}, s AS (
      SELECT avg(loss) AS m, stddev_pop(loss) AS s, avg(vict_age) AS am, stddev_pop(vict_age) AS asd FROM incidents)
    SELECT inc_id, round(greatest(least(loss, m + 4 * s), m - 4 * s), 4) AS loss,
      CASE WHEN vict_age IS NOT NULL THEN round(greatest(least(vict_age::DOUBLE, am + 4 * asd), am - 4 * asd), 4) END AS vict_age
    FROM incidents, s
    """,
)
def c08(spark, sf):
    done = cleaning.zscore_winsorize(incidents(spark, sf).select("inc_id", "loss", "vict_age"), ["loss", "vict_age"])
    return done.select("inc_id", F.round("loss", 4).alias("loss"), F.round("vict_age", 4).alias("vict_age"))


@query("c09_one_class_filter")
def c09(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return cleaning.one_class_filter(df, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("c09_one_class_share", "SELECT count(*) AS n_rows, true AS share_kept FROM lineitem")
def c09_share(spark, sf):
    """Whether the filter leaves out one row in a hundred, give or take one."""
    n = table(spark, sf, "lineitem").select(F.count(F.lit(1)).alias("n_rows"))
    kept = c09(spark, sf).select(F.count(F.lit(1)).alias("kept"))
    near = F.abs(F.col("n_rows") * 0.99 - F.col("kept")) <= 1
    return n.withColumn("one", F.lit(1)).join(kept.withColumn("one", F.lit(1)), "one").select("n_rows", near.alias("share_kept"))


@query("c10_above_threshold", f"WITH s AS ({SCORES_SQL}) SELECT doc_id, round(score, 9) AS score FROM s WHERE score >= 0.6")
def c10(spark, sf):
    return cleaning.above_threshold(scores(spark, sf), "score").select("doc_id", F.round("score", 9).alias("score"))


@query(
    "j04_side_by_side",
    """
    WITH c AS (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS row_index FROM customer),
    s AS (SELECT *, row_number() OVER (ORDER BY s_suppkey DESC) - 1 AS row_index FROM (SELECT s_suppkey, s_name AS c_name FROM supplier))
    SELECT coalesce(c.row_index, s.row_index) AS row_index, c_custkey, c.c_name, s_suppkey, s.c_name AS c_name_right
    FROM c FULL JOIN s ON c.row_index = s.row_index
    """,
)
def j04(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("c_name"), (-F.col("s_suppkey")).alias("falling"))
    return ranking.side_by_side(customers, suppliers, ["c_custkey"], ["falling"]).drop("falling")


@query(
    "x15_factorize",
    f"""
    {WITH_INCIDENTS}, seen AS (SELECT crm_cd_desc AS v, row_number() OVER (ORDER BY min(inc_id)) - 1 AS code FROM incidents WHERE crm_cd_desc IS NOT NULL GROUP BY 1)
    SELECT inc_id, crm_cd_desc, coalesce(code, -1) AS code FROM incidents LEFT JOIN seen ON crm_cd_desc = v
    """,
)
def x15(spark, sf):
    return ranking.factorize(incidents(spark, sf).select("inc_id", "crm_cd_desc"), "crm_cd_desc", order=["inc_id"])


@query(
    "x15_factorize_many",
    """
    WITH seen AS (SELECT o_custkey AS v, row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS code FROM orders GROUP BY 1)
    SELECT o_orderkey, o_custkey, code FROM orders JOIN seen ON o_custkey = v
    """,
)
def x15_many(spark, sf):
    return ranking.factorize(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", order=["o_orderkey"])
