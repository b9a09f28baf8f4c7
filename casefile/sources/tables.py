"""Reading and writing tables, chosen by file suffix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefile.sources.text_types import read_typed_csv

# Suffixes understood when reading and when writing.
CSV_SUFFIXES = (".csv", ".csv.gz", ".csv.bz2")
PARQUET_SUFFIX = ".parquet"

# The category choices of the demo table.
DEMO_CATEGORIES = {
    "category_A": ("Type1", "Type2", "Type3"),
    "category_B": ("Group1", "Group2"),
    "status": ("Active", "Inactive", "Pending"),
}


def load_table(
    spark: SparkSession, source: DataFrame | str, schema: T.StructType | str | None = None
) -> DataFrame:
    """A DataFrame as it is, or the Parquet / CSV table behind a path.

    CSV types are found over the whole column, in the one reading that copies the text to
    Parquet, unless a schema is given.
    """
    if isinstance(source, DataFrame):
        return source
    path = str(source)
    lowered = path.lower().rstrip("/")
    if lowered.endswith(PARQUET_SUFFIX):
        return spark.read.parquet(path)
    if lowered.endswith(CSV_SUFFIXES):
        if schema is None:
            return read_typed_csv(spark, path)
        return spark.read.option("header", True).option("multiLine", False).schema(schema).csv(path)
    raise ValueError(f"unsupported table format: {path} (use .parquet, .csv, .csv.gz or .csv.bz2)")


def save_table(df: DataFrame, path: str) -> str:
    """Write a table as Parquet or CSV, by suffix; any other suffix is an error."""
    lowered = path.lower().rstrip("/")
    if lowered.endswith(PARQUET_SUFFIX):
        df.write.mode("overwrite").parquet(path)
    elif lowered.endswith(CSV_SUFFIXES):
        writer = df.write.mode("overwrite").option("header", True)
        if lowered.endswith(".gz"):
            writer = writer.option("compression", "gzip")
        elif lowered.endswith(".bz2"):
            writer = writer.option("compression", "bzip2")
        writer.csv(path)
    else:
        raise ValueError(f"unsupported table format: {path} (use .parquet or .csv)")
    return path


def save_result_csv(df: DataFrame, path: str) -> str:
    """Write a result table as CSV with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def save_records_json(df: DataFrame, path: str) -> str:
    """Write result records as JSON lines, leaving out private (`_name`) columns."""
    df.select(*[c for c in df.columns if not c.startswith("_")]).write.mode("overwrite").json(path)
    return path


def demo_blobs(
    spark: SparkSession,
    n: int = 1000,
    centers: int = 4,
    dims: int = 10,
    std: float = 2.0,
    seed: int = 42,
    categories: dict[str, Sequence[str]] = DEMO_CATEGORIES,
) -> DataFrame:
    """Gaussian blobs around uniform centres in [-10, 10], plus random categories.

    Every value is drawn from a hash of the row id, so the table is the same on
    any number of partitions.
    """

    def uniform(tag: str, *parts) -> F.Column:
        text = F.concat_ws(":", F.lit(f"{seed}:{tag}"), *[F.col(p).cast("string") for p in parts])
        word = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double")
        return (word + 0.5) / float(16**12)

    df = spark.range(n).withColumn("_blob", (F.col("id") % centers).cast("int"))
    for j in range(dims):
        centre = uniform(f"centre{j}", "_blob") * 20 - 10
        noise = F.sqrt(-2 * F.ln(uniform(f"r{j}", "id"))) * F.cos(2 * F.pi() * uniform(f"a{j}", "id"))
        df = df.withColumn(f"feature_{j}", centre + noise * std)
    for name, values in categories.items():
        pick = F.floor(uniform(name, "id") * len(values)).cast("int") + 1
        df = df.withColumn(name, F.element_at(F.array(*[F.lit(v) for v in values]), pick))
    return df.drop("_blob")
