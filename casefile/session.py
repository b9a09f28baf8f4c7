"""Session settings and the reliable cut of a plan's lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows and bytes of an aggregated side table that may be sent to every executor.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20
# Rows from which a table is worth dealing out to all cores, and rows that one task of a fit should hold at most.
SPREAD_ROWS, TASK_ROWS = 100_000, 1_000_000


def build_session(app: str = "casefile", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; `master` only for local runs."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder; fall back to a local one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix=f"casefile-{os.getpid()}-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def durable(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder and continue from there.

    The files outlive lost executors, so nothing upstream is ever recomputed.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Spark removes the files that an execution shuffled as soon as it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Meanwhile shuffle files do not outlive the query that wrote them, instead of waiting for the driver's
    garbage collection. For loops whose rounds are `durable`; a table that is read again unwritten is made again."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder beside the session's checkpoints."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def stored(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Like `durable`, as a Parquet table: for wide tables of which later passes read
    a few columns at a time. `schema` reads columns as another type of the same storage."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def stored_with(df: DataFrame, metrics: Sequence[Column]) -> tuple[DataFrame, dict]:
    """Like `stored`, with aggregates of the rows that are collected while they are written."""
    seen = Observation()
    watched = df.observe(seen, *metrics) if metrics else df
    table = stored(watched)
    return table, seen.get if metrics else {}


def spread(table: DataFrame, task_rows: int | None = None) -> DataFrame:
    """Deal a stored table out to all cores, and to tasks of `task_rows` rows at most, when its
    files make fewer partitions.

    For the iterative fits. Files are cut by their compressed bytes, of which rows take many times as
    much once they are vectors, so tables that fits hold are cut by rows. For a small table more
    tasks only cost. Only for tables read back, whose plan runs nothing.
    """
    wanted, held = table.sparkSession.sparkContext.defaultParallelism, table.rdd.getNumPartitions()
    if held >= wanted and not task_rows:
        return table
    rows = table.count()
    wanted = max(wanted, -(-rows // task_rows)) if task_rows else wanted
    return table if held >= wanted or rows < SPREAD_ROWS else table.repartition(wanted)


def _bytes_of(field: T.StructField) -> Column:
    """About how many bytes a value takes; texts and arrays by their length."""
    c = F.col("`" + field.name.replace("`", "``") + "`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.octet_length(c) + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(F.struct(c))) + 16
    return F.lit(16)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Materialise a side table and mark it for broadcast only when its counted rows
    and bytes are within the bounds. Returns the table and whether it was small."""
    table = durable(df)
    row = sum((F.coalesce(_bytes_of(f), F.lit(16)) for f in table.schema.fields), F.lit(0))
    rows, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()
    small = rows <= max_rows and size <= max_bytes
    return (F.broadcast(table), True) if small else (table, False)
