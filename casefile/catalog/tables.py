"""The test tables and the incident-like tables derived from them.

The column lists are SQL that reads the same on Spark and in the check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The moment up to which dates count as plausible in the queries.
AS_OF = "2001-03-01 00:00:00"

INCIDENT_COLUMNS = {
    "inc_id": "o_orderkey",
    "date_occ": "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "time_occ": "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST((o_orderkey % 24) * 100 + (o_custkey % 60) AS INT) END",
    "date_rptd": "CASE WHEN o_orderkey % 23 = 0 THEN 'garbage' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "lat": "CASE WHEN o_orderkey % 29 = 0 THEN CAST(0 AS DOUBLE) WHEN o_orderkey % 31 = 0 THEN NULL"
    " ELSE CAST(33 AS DOUBLE) + CAST(o_custkey % 200 AS DOUBLE) / 100 END",
    "lon": "CASE WHEN o_orderkey % 29 = 0 THEN CAST(0 AS DOUBLE) WHEN o_orderkey % 31 = 0 THEN NULL"
    " ELSE CAST(-119 AS DOUBLE) + CAST(o_orderkey % 200 AS DOUBLE) / 100 END",
    "crm_cd_desc": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END",
    "status_desc": "o_orderstatus",
    "vict_age": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(18 + o_custkey % 60 AS INT) END",
    "loss": "CASE WHEN o_orderkey % 101 = 0 THEN o_totalprice * 20 ELSE o_totalprice END",
    "const_col": "'US'",
}
INCIDENTS_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in INCIDENT_COLUMNS.items()) + " FROM orders"
WITH_INCIDENTS = f"WITH incidents AS ({INCIDENTS_SQL})"

SCORES_SQL = """
SELECT l.doc_id, CAST(l.quality AS INT) AS label, CAST(d.n_chars % 97 AS DOUBLE) / 97 AS score
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
"""

# Each return flag and the one a wrong prediction names.
ROTATED = "CASE l_returnflag WHEN 'A' THEN 'N' WHEN 'N' THEN 'R' ELSE 'A' END"
FLAG_COLUMNS = {
    "label": "l_returnflag",
    "prediction": f"CASE WHEN (l_orderkey + l_linenumber) % 4 = 0 THEN {ROTATED} ELSE l_returnflag END",
}
FLAGS_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in FLAG_COLUMNS.items()) + " FROM lineitem"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in INCIDENT_COLUMNS.items()])


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels, documents = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    return labels.join(documents, "doc_id").selectExpr(
        "doc_id", "CAST(quality AS INT) AS label", "CAST(n_chars % 97 AS DOUBLE) / 97 AS score"
    )


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in FLAG_COLUMNS.items()])


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as (vec_id, vec, label), vec as doubles."""
    return table(spark, sf_dir, "embeddings").selectExpr("vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS vec", "label")


def plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two components of each embedding as (vec_id, vec, label)."""
    return points(spark, sf_dir).selectExpr("vec_id", "slice(vec, 1, 2) AS vec", "label")
