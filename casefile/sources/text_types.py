"""Types of text columns, found while the text is copied.

Every value votes for all types that can hold it. The votes are counted as the raw columns are
written to a Parquet copy, so the source is read once whatever its compression; the copy is then
read with each column as the first type, in the order of the table below, that all values voted for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefile.functions.values import col
from casefile.session import stored_with

WHOLE = r"^[+-]?\d{1,19}$"
NUMBER = r"^([+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|NaN|-?Inf|-?Infinity)$"
DAY = r"^\d{4}-\d{2}-\d{2}$"
MOMENT = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?)?$"
FLAG = r"^(?i:true|false)$"
# Narrow types first: whole numbers are numbers as well, and days are moments.
LATTICE = (("boolean", FLAG), ("int", WHOLE), ("bigint", WHOLE), ("double", NUMBER), ("date", DAY), ("timestamp", MOMENT))


def type_votes(columns: list[str]) -> list[Column]:
    """Aggregates: present values of every column, and those that each type can hold."""
    votes = []
    for i, c in enumerate(columns):
        votes.append(F.count(col(c)).alias(f"n{i}"))
        votes += [F.count_if(col(c).rlike(shape) & col(c).try_cast(kind).isNotNull()).alias(f"{kind}{i}") for kind, shape in LATTICE]
    return votes


def elected(votes: dict, i: int) -> str:
    """The type of column i; text without values, or if no type holds all of them."""
    if not votes[f"n{i}"]:
        return "string"
    return next((kind for kind, _ in LATTICE if votes[f"{kind}{i}"] == votes[f"n{i}"]), "string")


def read_typed_csv(spark: SparkSession, path: str, malformed: str | None = None) -> DataFrame:
    """A CSV table with a header, each column of the narrowest type that holds all its values.

    Rows with too few or too many fields are kept, with nulls for what is missing; `malformed` names a column for
    their raw text (null for all other rows).
    """
    reader = spark.read.option("header", True).option("multiLine", False)
    names = reader.csv(path).columns  # reads the header only
    fields = [T.StructField(c, T.StringType()) for c in names]
    if malformed:
        fields.append(T.StructField(malformed, T.StringType()))
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    raw, votes = stored_with(reader.schema(T.StructType(fields)).csv(path), type_votes(names))
    typed = [col(c).cast(elected(votes, i)).alias(c) for i, c in enumerate(names)]
    return raw.select(*typed, *([col(malformed)] if malformed else []))
