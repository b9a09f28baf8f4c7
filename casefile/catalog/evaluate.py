"""Running totals, ranks and classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from casefile.catalog.registry import query
from casefile.catalog.tables import FLAGS_SQL, SCORES_SQL, flags, scores, table
from casefile.operators import evaluation as ev
from casefile.operators.explain import top_features
from casefile.operators.ranking import rank_by_hash, running_totals, top_rows

TOTALS_SQL = f"""
WITH s AS ({SCORES_SQL}),
g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg FROM s GROUP BY score),
t AS (SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS cum_pos, CAST(sum(neg) OVER w AS BIGINT) AS cum_neg,
        lead(pos) OVER w2 AS next_pos, lead(neg) OVER w2 AS next_neg,
        row_number() OVER w2 AS rn, sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
      FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING), w2 AS (ORDER BY score DESC))
"""


@query("w05_running_totals", f"{TOTALS_SQL} SELECT round(score, 9) AS score, pos, neg, cum_pos, cum_neg, next_pos, next_neg FROM t")
def w05(spark, sf):
    return ev.score_table(scores(spark, sf)).withColumn("score", F.round("score", 9))


@query(
    "w05_running_totals_bucketed",
    """
    WITH g AS (SELECT l_extendedprice AS price, count(*) AS n FROM lineitem GROUP BY l_extendedprice)
    SELECT price, n, CAST(sum(n) OVER (ORDER BY price ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_n FROM g
    """,
)
def w05_bucketed(spark, sf):
    prices = table(spark, sf, "lineitem").groupBy(F.col("l_extendedprice").alias("price")).agg(F.count(F.lit(1)).alias("n"))
    return running_totals(prices, "price", ["n"], rows_per_bucket=5_000)


@query(
    "w05_rank_by_hash",
    """
    SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(concat('42:', CAST(o_orderkey AS VARCHAR)))) AS rank
    FROM orders
    """,
)
def w05_rank(spark, sf):
    return rank_by_hash(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderstatus"], "o_orderkey", 42)


@query("w06_top_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def w06(spark, sf):
    return top_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 10, "o_totalprice", "o_orderkey")


@query(
    "i03_top_features",
    """
    WITH f AS (SELECT l_shipmode_ AS method, feature, sum(v) AS importance FROM (
      SELECT l_returnflag AS l_shipmode_, CAST(l_suppkey AS VARCHAR) AS feature, l_quantity AS v FROM lineitem) GROUP BY ALL)
    SELECT *, CAST(row_number() OVER (PARTITION BY method ORDER BY importance DESC, feature) AS INTEGER) AS place FROM f QUALIFY place <= 20
    """,
)
def i03(spark, sf):
    # any table of (method, feature, importance) will do
    table_ = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("method"), F.col("l_suppkey").cast("string").alias("feature"))
    return top_features(table_.agg(F.sum("l_quantity").alias("importance")))


@query("e01_accuracy", f"WITH f AS ({FLAGS_SQL}) SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM f")
def e01(spark, sf):
    return ev.accuracy(flags(spark, sf)).select(F.round("accuracy", 9).alias("accuracy"))


@query(
    "e02_macro_f1",
    f"""
    WITH f AS ({FLAGS_SQL}), c AS (SELECT DISTINCT label AS c FROM f UNION SELECT DISTINCT prediction FROM f),
    p AS (SELECT c, count(*) FILTER (WHERE label = c AND prediction = c) AS tp, count(*) FILTER (WHERE label <> c AND prediction = c) AS fp,
            count(*) FILTER (WHERE label = c AND prediction <> c) AS fn FROM f, c GROUP BY c)
    SELECT round(avg(2.0 * tp / (2 * tp + fp + fn)), 9) AS macro_f1 FROM p
    """,
)
def e02(spark, sf):
    return ev.macro_f1(flags(spark, sf)).select(F.round("macro_f1", 9).alias("macro_f1"))


@query("e03_roc_auc", f"{TOTALS_SQL} SELECT round(sum(neg * (cum_pos - pos / 2)) / max(all_pos * all_neg), 9) AS roc_auc FROM t")
def e03(spark, sf):
    return ev.roc_auc(scores(spark, sf)).select(F.round("roc_auc", 9).alias("roc_auc"))


@query("e04_average_precision", f"{TOTALS_SQL} SELECT round(sum(pos * cum_pos / (cum_pos + cum_neg)) / max(all_pos), 9) AS avg_precision FROM t")
def e04(spark, sf):
    return ev.average_precision(scores(spark, sf)).select(F.round("avg_precision", 9).alias("avg_precision"))


@query(
    "e05_roc_points",
    f"""
    {TOTALS_SQL}
    SELECT 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr, 'infinity'::DOUBLE AS threshold
    UNION ALL SELECT round(cum_neg / all_neg, 9), round(cum_pos / all_pos, 9), round(score, 9) FROM t
    WHERE rn = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
    """,
)
def e05(spark, sf):
    points = ev.roc_points(scores(spark, sf))
    finite = F.when(F.col("threshold") < float("inf"), F.round("threshold", 9)).otherwise(F.col("threshold"))
    return points.select(F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"), finite.alias("threshold"))


@query(
    "e06_pr_points",
    f"""
    {TOTALS_SQL}
    SELECT round(cum_pos / (cum_pos + cum_neg), 9) AS precision, round(cum_pos / all_pos, 9) AS recall, round(score, 9) AS threshold FROM t
    UNION ALL SELECT 1.0, 0.0, NULL
    """,
)
def e06(spark, sf):
    return ev.pr_points(scores(spark, sf)).select(*[F.round(c, 9).alias(c) for c in ("precision", "recall", "threshold")])


@query(
    "e07_confusion_matrix",
    f"""
    WITH f AS ({FLAGS_SQL}), c AS (SELECT label AS c FROM f UNION SELECT prediction FROM f)
    SELECT a.c AS label, b.c AS prediction, count(f.label) AS "count"
    FROM c a CROSS JOIN c b LEFT JOIN f ON f.label = a.c AND f.prediction = b.c GROUP BY ALL
    """,
)
def e07(spark, sf):
    return ev.confusion_matrix(flags(spark, sf))


@query(
    "e09_comparison_table",
    f"""
    WITH r AS (SELECT source AS model, round(avg(CASE WHEN n_chars > 500 THEN n_chars END), 6) AS cv_score, round(avg(n_chars), 6) AS duration_seconds
               FROM documents GROUP BY source) SELECT * FROM r WHERE cv_score IS NOT NULL
    """,
)
def e09(spark, sf):
    # stands in for a table of results: one row per source, some without a score
    results = table(spark, sf, "documents").groupBy(F.col("source").alias("model")).agg(
        F.round(F.avg(F.when(F.col("n_chars") > 500, F.col("n_chars"))), 6).alias("cv_score"), F.round(F.avg("n_chars"), 6).alias("duration_seconds")
    )
    return ev.comparison_table(results)
