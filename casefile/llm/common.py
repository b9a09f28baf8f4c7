"""Reading the corpus tables and writing pieces of expressions they share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from casefile.session import scratch_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text) of any table that has them; all other columns are left behind."""
    return docs.select(docs[id_column].cast(LongType()).alias("doc_id"), docs[text_column].cast(StringType()).alias("text"))


def fresh_name(df: DataFrame, wish: str) -> str:
    """`wish`, lengthened until it clashes with no column of `df`."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id as text leaves `fold`; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """`df` as a Parquet table in the shared folder, and where that is."""
    path = f"{scratch_folder(df.sparkSession)}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def forget(spark: SparkSession, path: str) -> None:
    """Remove a table made by `written` that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let the driver notice dropped tables, so that their shuffle files go before the next pass."""
    spark.sparkContext._jvm.System.gc()


def bounded_ids(labels: DataFrame, rows: int) -> DataFrame:
    """(doc_id): distinct ids of `labels`, chosen by their hash, about nine tenths of `rows` and never more than `rows`."""
    ids = labels.select(labels["doc_id"].cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    total = ids.count()
    if total > 0.9 * rows:
        ids = ids.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fit")), F.lit(1 << 30)) < int((1 << 30) * 0.9 * rows / total))
    return ids.limit(rows)


def taken_from(text: Column, most_bytes: int, pieces: int = 4) -> Column:
    """A text of up to `most_bytes` as it is; of a longer one `pieces` pieces at places that a hash of it chooses, `most_bytes` in all at most.

    For learning from a bounded number of labelled texts of any length.
    """
    size = most_bytes // (4 * pieces)  # characters of up to four bytes
    room = F.length(text) - size

    def piece(k: int) -> Column:
        at = F.floor(room / pieces * k + F.pmod(F.xxhash64(text, F.lit(k)), F.lit(1 << 20)) / float(1 << 20) * room / pieces)
        return F.substr(text, at.cast("int") + 1, F.lit(size))

    return F.when(F.octet_length(text) <= most_bytes, text).otherwise(F.concat_ws(" ", *[piece(k) for k in range(pieces)]))
