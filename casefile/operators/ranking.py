"""Global ranks and running totals that never sort a whole group in one task.

Rows are first counted per (group, slice of the order); the running count of the
slices is tiny, and only rows of one slice meet in one task. Orders over values are dealt
out as ranges, one to a partition; what comes before a partition is one number for each.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casefile.functions.values import col, missing
from casefile.session import broadcast_if_small, durable

# Hex digits of the hash that name a slice: 16**4 slices per group.
SLICE_DIGITS = 4
# Rows wanted in a range where their number is chosen beforehand.
ROWS_PER_BUCKET = 1_000_000


def order_hash(df: DataFrame, key: str | Sequence[str] | None, seed: int) -> Column:
    """md5 of `seed:key`: the same random order on any partitioning and engine.

    Without a key the whole row is hashed; equal rows may then swap places.
    """
    names = [key] if isinstance(key, str) else list(key or df.columns)
    if len(names) == 1:
        text = col(names[0]).cast("string")
    else:
        text = F.concat_ws("|", *[F.coalesce(col(n).cast("string"), F.lit("\u0000")) for n in names])
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(text, F.lit(""))))


def _with_hash(df: DataFrame, key, seed: int) -> DataFrame:
    return df.withColumn("_hash", order_hash(df, key, seed)).withColumn("_slice", F.substring("_hash", 1, SLICE_DIGITS))


def _slice_offsets(hashed: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows of each (group, slice) and rows of the group in earlier slices."""
    counts = hashed.groupBy(*[col(g) for g in groups], "_slice").agg(F.count(F.lit(1)).alias("_in_slice"))
    earlier = Window.partitionBy(*[col(g) for g in groups]).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_in_slice").over(earlier), F.lit(0)))


def rank_by_hash(df: DataFrame, groups: Sequence[str], key, seed: int, name: str = "rank") -> DataFrame:
    """1-based position of every row inside its group, in hash order.

    Group columns must hold no nulls.
    """
    hashed = _with_hash(df, key, seed)
    on = [*groups, "_slice"]
    offsets = _slice_offsets(hashed, groups).select(*[col(g) for g in on], "_before")
    inside = F.row_number().over(Window.partitionBy(*[col(g) for g in on]).orderBy("_hash"))
    return hashed.join(offsets, on).withColumn(name, F.col("_before") + inside).select(*[col(c) for c in df.columns], name)


def _with_cut(df: DataFrame, groups: Sequence[str], quotas: DataFrame, key, seed: int) -> tuple[DataFrame, list[Column]]:
    """Hashed rows with `_cut`, the slice in which the quota of their group falls, and
    `_rest`, the rows wanted of that slice. No quota, no cut."""
    hashed = _with_hash(df, key, seed)
    if not groups:
        groups = ["_all"]
        hashed, quotas = hashed.withColumn("_all", F.lit(1)), quotas.withColumn("_all", F.lit(1))
    keys = [col(g) for g in groups]
    offsets = _slice_offsets(hashed, groups).join(quotas.select(*keys, "quota"), list(groups))
    # the last slice a quota reaches; a group without quota keeps nothing
    cut = offsets.filter(F.col("_before") < F.col("quota")).groupBy(*keys).agg(
        F.max("_slice").alias("_cut"), F.max_by(F.col("quota") - F.col("_before"), "_slice").alias("_rest")
    )
    cut, _ = broadcast_if_small(cut)
    return hashed.join(cut, list(groups), "left"), [*keys, F.col("_slice")]


def take_quota(df: DataFrame, groups: Sequence[str], quotas: DataFrame, key, seed: int) -> DataFrame:
    """The first `quota` rows of each group in hash order.

    `quotas` holds one row per group with a column `quota`. Slices above the cut are
    dropped by the scan, so little more than the sample is shuffled.
    """
    placed, slices = _with_cut(df, groups, quotas, key, seed)
    near = placed.filter(F.col("_slice") <= F.col("_cut"))
    place = F.row_number().over(Window.partitionBy(*slices).orderBy("_hash"))
    kept = near.withColumn("_place", place).filter((F.col("_slice") < F.col("_cut")) | (F.col("_place") <= F.col("_rest")))
    return kept.select(*[col(c) for c in df.columns])


def mark_quota(
    df: DataFrame, groups: Sequence[str], quotas: DataFrame, key, seed: int, name: str = "picked"
) -> DataFrame:
    """Flag the rows `take_quota` would take, keeping all rows.

    Whole slices below the cut are in, whole slices above it are out; only the slice
    of the cut is shuffled and sorted.
    """
    placed, slices = _with_cut(df, groups, quotas, key, seed)
    columns = [col(c) for c in df.columns]
    sure = placed.filter(F.col("_cut").isNull() | (F.col("_slice") != F.col("_cut")))
    sure = sure.select(*columns, F.coalesce(F.col("_slice") < F.col("_cut"), F.lit(False)).alias(name))
    edge = placed.filter(F.col("_slice") == F.col("_cut"))
    place = F.row_number().over(Window.partitionBy(*slices).orderBy("_hash"))
    return sure.unionByName(edge.select(*columns, (place <= F.col("_rest")).alias(name)))


def _ranged(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    """Rows dealt out by consecutive ranges of the order, sorted inside, with the number of their range."""
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return durable(dealt.sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id()))


def running_totals(
    df: DataFrame,
    order_col: str,
    sums: Sequence[str],
    descending: bool = False,
    leads: Sequence[str] = (),
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Running sums over a global order, as `cum_<name>`, this row included.

    `order_col` is a number, distinct per row (group by it first: that also turns
    a hot value into one row). `leads` adds `next_<name>`, the value of the
    following row. The order is cut into ranges by the exchange itself, about
    `rows_per_bucket` rows each if given; only one row per range is ever ordered as a whole.
    """
    partitions = max(1, math.ceil(df.count() / rows_per_bucket)) if rows_per_bucket else None
    # ranges follow the wanted direction, so that totals always grow with their number
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    parts = _ranged(df, [order], partitions)
    first = F.max_by if descending else F.min_by
    totals = parts.groupBy("_range").agg(
        *[F.sum(s).alias(f"_sum_{s}") for s in sums], *[first(v, order_col).alias(f"_first_{v}") for v in leads]
    )
    ranges = Window.orderBy("_range")
    earlier = ranges.rowsBetween(Window.unboundedPreceding, -1)
    offsets, _ = broadcast_if_small(
        totals.select(
            "_range",
            *[F.coalesce(F.sum(f"_sum_{s}").over(earlier), F.lit(0)).alias(f"_before_{s}") for s in sums],
            *[F.lead(f"_first_{v}").over(ranges).alias(f"_after_{v}") for v in leads],
        )
    )
    inside = Window.partitionBy("_range").orderBy(order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = parts.join(offsets, "_range")
    cums = [(F.col(f"_before_{s}") + F.sum(s).over(upto)).alias(f"cum_{s}") for s in sums]
    nexts = [F.coalesce(F.lead(v).over(inside), F.col(f"_after_{v}")).alias(f"next_{v}") for v in leads]
    return out.select(*[col(c) for c in df.columns], *cums, *nexts)


# Spark's row ids hold the partition above and the place in it below this bit.
_PLACE_BITS = 33


def with_row_index(df: DataFrame, name: str = "row_index", order: Sequence[str] = ()) -> DataFrame:
    """Append a gapless 0-based index: in the order of `order`, or as the rows are read.

    Partitions are counted and what lies before each is added to a row's place in it; no row
    is moved for that. Rows equal in all of `order` may swap places.
    """
    placed = df
    if order:
        keys = [col(c).asc_nulls_first() for c in order]
        placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = durable(placed.withColumn(name, F.monotonically_increasing_id()))
    part, place = F.shiftright(col(name), _PLACE_BITS), col(name).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    # one row for each partition
    held = sorted(placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = [0, *accumulate(r["n"] for r in held)]
    offsets = [(r["part"], b) for r, b in zip(held, before)]
    if len(offsets) < 2:
        return placed.withColumn(name, place)
    table, _ = broadcast_if_small(df.sparkSession.createDataFrame(offsets, "_part long, _before long"))
    indexed = placed.join(table, part == F.col("_part"))
    return indexed.select(*[col(c) for c in df.columns], (F.col("_before") + place).alias(name))


def side_by_side(left: DataFrame, right: DataFrame, left_order: Sequence[str] = (), right_order: Sequence[str] = (), suffix: str = "_right") -> DataFrame:
    """The columns of two tables row by row, as their rows are read or in the given orders.

    The longer table's last rows have nulls beside them. A column of `right` whose name is taken
    gets `suffix` as often as needed. The place of a row is its `row_index` in the result.
    """
    taken, renamed = {c.lower() for c in left.columns} | {"row_index"}, []
    for c in right.columns:
        new = c
        while new.lower() in taken:
            new += suffix
        taken.add(new.lower())
        renamed.append(new)
    if "row_index" in {c.lower() for c in left.columns}:
        raise ValueError("a column is called row_index already")
    # a private index name, so that `right` may have any column
    one = with_row_index(left, "row_index", left_order)
    two = with_row_index(right.toDF(*[f"c{i}" for i in range(len(renamed))]), "row_index", [f"c{right.columns.index(c)}" for c in right_order])
    joined = one.join(two, "row_index", "full")
    return joined.select("row_index", *[col(c) for c in left.columns], *[F.col(f"c{i}").alias(c) for i, c in enumerate(renamed)])


def factorize(df: DataFrame, column: str, name: str = "code", order: Sequence[str] = ()) -> DataFrame:
    """Append the number of a value in the order of first sight; missing values (null, NaN) have -1.

    First sight goes by `order`, or by the rows as they are read. Values are numbered as a
    table and joined back, so there may be any number of them.
    """
    indexed = with_row_index(df, "_at", order)
    seen = indexed.filter(~missing(df, column)).groupBy(col(column).alias("_value")).agg(F.min("_at").alias("_first"))
    numbered, _ = broadcast_if_small(with_row_index(seen, "_code", ["_first"]).select("_value", "_code"))
    coded = indexed.join(numbered, col(column) == F.col("_value"), "left")
    return coded.select(*[col(c) for c in df.columns], F.coalesce("_code", F.lit(-1).cast("long")).alias(name))


def top_rows(df: DataFrame, n: int, by: str, *ties: str, descending: bool = True) -> DataFrame:
    """The n rows with the best score, missing scores last, ties by name."""
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return df.orderBy(first, *ties).limit(n)
