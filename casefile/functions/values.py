"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, _FLOATING)


def is_integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, _INTEGRAL)


def is_number(dtype: T.DataType, bool_as_numeric: bool = False) -> bool:
    """Whether a type counts as numeric; whether booleans do is up to the caller."""
    if isinstance(dtype, T.BooleanType):
        return bool_as_numeric
    return isinstance(dtype, T.NumericType)


def col(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def missing(df: DataFrame, name: str) -> Column:
    """True where a value is null or NaN."""
    c = col(name)
    return c.isNull() | F.isnan(c) if is_floating(df.schema[name].dataType) else c.isNull()


def present_number(df: DataFrame, name: str) -> Column:
    """The column as a double in which NaN is null."""
    c = col(name).cast("double")
    return F.when(~F.isnan(c), c) if is_floating(df.schema[name].dataType) else c


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn every NaN into null, so that later steps know one kind of missing value."""
    return df.select(
        *[
            F.nullif(col(f.name), F.lit(float("nan")).cast(f.dataType)).alias(f.name)
            if is_floating(f.dataType)
            else col(f.name)
            for f in df.schema.fields
        ]
    )


def clip(c: Column, low, high) -> Column:
    """Bound a value to [low, high]; a null stays null."""
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(high)), F.lit(low)))


def linspace(start: Column, stop: Column, num: int) -> Column:
    """`num` evenly spaced doubles from start to stop, both included, as an array."""
    if num == 1:
        return F.array(start.cast("double"))
    step = (stop - start).cast("double") / (num - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(num - 1)), lambda i: start + i * step)


def safe_file_name(c: Column) -> Column:
    """Replace everything but letters, digits, dot, underscore and dash by `_`."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}._-]", "_")


def as_text(c: Column, missing_text: str = "None") -> Column:
    """The value as text, with missing values as a text of their own."""
    return F.coalesce(c.cast("string"), F.lit(missing_text))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))]


def long_form(df: DataFrame, columns: Sequence[str], name: str = "column", value: str = "value") -> DataFrame:
    """One row per (row, column) of equally typed columns, in a single pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), col(c).alias(value)) for c in columns])
    return df.select(F.inline(pairs))
