"""Numbers for the values of text columns, as tables that are joined.

A dictionary has one row for each distinct value of each column: how often it occurs and its slot, the
place of the value in sorted order. No list of values is held on the driver or in a closure.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefile.functions.values import col, long_form, missing
from casefile.operators.ranking import with_row_index
from casefile.session import broadcast_if_small, durable, stored

# Bytes per value and names of vectors stay out of the driver above this many slots a column.
MODEL_SLOTS = 10_000


def dictionary_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n, slot) of all present values, slots from 0 in the order of the texts.

    All columns are counted in one pass and numbered in one global order.
    """
    texts = df.select(*[col(c).cast("string").alias(c) for c in columns])
    counts = long_form(texts, list(columns)).filter("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = with_row_index(counts, "_at", ["column", "value"])
    first = placed.groupBy("column").agg(F.min("_at").alias("_first"))
    # one row for each column
    starts = F.create_map(*[F.lit(v) for r in first.collect() for v in (r["column"], r["_first"])]) if columns else F.create_map()
    return durable(placed.select("column", "value", "n", (F.col("_at") - F.element_at(starts, F.col("column"))).alias("slot")))


def dictionary_sizes(dictionary: DataFrame) -> dict[str, int]:
    return {r["column"]: r["size"] for r in dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("size")).collect()}


def with_slot(df: DataFrame, column: str, dictionary: DataFrame, name: str) -> DataFrame:
    """Append the slot of a column's value, null for unknown and missing ones.

    `dictionary` has (value, slot). Small ones are sent to all tasks, others are joined by value; a value that
    very many rows have is then split by adaptive execution, as it is one row of the dictionary.
    """
    joined = df.join(dictionary.select(F.col("value").alias("_value"), F.col("slot").alias(name)), col(column).cast("string") == F.col("_value"), "left")
    return joined.drop("_value")


class Classes:
    """Distinct target values as a table (value, slot), in sorted order; a list of them is made only when asked for."""

    def __init__(self, table: DataFrame, count: int):
        self.table, self._count, self._list = table, count, None

    def __len__(self) -> int:
        return self._count

    def __iter__(self) -> Iterator:
        if self._list is None:
            self._list = [r["value"] for r in self.table.select("value", "slot").orderBy("slot").toLocalIterator()]
        return iter(self._list)

    def __getitem__(self, at):
        return list(self)[at]

    def __eq__(self, other) -> bool:
        return list(self) == list(other)


def classes_of(df: DataFrame, target: str) -> Classes:
    values = df.filter(~missing(df, target)).select(col(target).alias("value")).distinct()
    numbered = durable(with_row_index(values, "slot", ["value"]))
    return Classes(numbered, numbered.count())


def as_sparse_vectors(df: DataFrame, columns: dict[str, int], entries: dict[str, F.Column]) -> DataFrame:
    """Append vector columns: `entries[c]` is an array of (at, value) with rising places below `columns[c]`.

    The vectors are written with their storage type and read back as vectors, so that they are put
    together by expressions alone.
    """
    plain = df
    for c, size in columns.items():
        parts = F.struct(
            F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
            F.transform(entries[c], lambda e: e["at"].cast("int")).alias("indices"),
            F.transform(entries[c], lambda e: e["value"].cast("double")).alias("values"),
        )
        plain = plain.withColumn(c, parts)
    fields = [T.StructField(f.name, VectorUDT(), True, {"ml_attr": {"num_attrs": columns[f.name]}}) if f.name in columns else f for f in plain.schema.fields]
    return stored(plain, T.StructType(fields))


def vector_entries(vector: F.Column) -> F.Column:
    """The non-zero entries of a vector as an array of (at, value)."""
    v = F.unwrap_udt(vector)
    sparse = F.zip_with(v["indices"], v["values"], lambda i, x: F.struct(i.alias("at"), x.alias("value")))
    dense = F.filter(F.transform(v["values"], lambda x, i: F.struct(i.alias("at"), x.alias("value"))), lambda e: e["value"] != 0)
    return F.when(v["type"] == 0, sparse).otherwise(dense)


class JoinedOneHot(Transformer):
    """Appends one-hot slots of long dictionaries to a vector: values are looked up by joins and gathered into one sparse vector."""

    def __init__(self, base: str | None, width: int, columns: Sequence[str], dictionary: DataFrame, sizes: dict[str, int], output: str):
        super().__init__()
        self.base, self.width, self.output = base, width, output
        self.columns = list(columns)
        self.tables = {c: broadcast_if_small(dictionary.filter(F.col("column") == c).select("value", "slot"))[0] for c in self.columns}
        self.sizes = {c: sizes.get(c, 0) for c in self.columns}

    def _transform(self, df: DataFrame) -> DataFrame:
        entries = vector_entries(F.col(self.base)) if self.base else F.array().cast("array<struct<at:int,value:double>>")
        at, found, out = self.width, [], df
        for i, c in enumerate(self.columns):
            out = with_slot(out, c, self.tables[c], f"_slot{i}")
            slot = F.col(f"_slot{i}")
            found.append(F.when(slot.isNotNull(), F.struct((slot + at).cast("int").alias("at"), F.lit(1.0).alias("value"))))
            at += self.sizes[c]
        gathered = F.concat(entries, F.array_compact(F.array(*found)))
        vectors = as_sparse_vectors(out, {self.output: at}, {self.output: gathered})
        return vectors.drop(*[f"_slot{i}" for i in range(len(self.columns))], *([self.base] if self.base else []))
