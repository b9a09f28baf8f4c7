"""Shards cut from the order of a Hilbert curve through several metadata dimensions.

Every dimension is quantised to the same number of bits by a fixed rule, the curve index is found
by walking a table of states, and rows sorted by it are cut into runs. Rows near on the curve are
alike in every dimension, so each shard covers a small box that a reader can skip by its bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BITS = 4
# Sizes at which a new level of the size dimension begins: half octaves from 64 bytes.
SIZE_STEPS = [64 * 2**k + (32 * 2**k if half else 0) for k in range(8) for half in (0, 1)][:15]
# Slices that rows of one curve cell are dealt into, so that no task sorts a whole cell.
SLICES = 1 << 16


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Digit and next state for each (state, corner) of a walk down the cells of the curve.

    A state is the entry corner and the direction in which the curve leaves a cell; corners of a
    cell are visited in Gray code order, turned to that entry and direction.
    """
    size = 1 << dims

    def turn(v: int, by: int) -> int:
        by %= dims
        return ((v >> by) | (v << (dims - by))) & (size - 1)

    def place(v: int) -> int:
        found = 0
        while v:
            found ^= v
            v >>= 1
        return found

    def gray(v: int) -> int:
        return v ^ (v >> 1)

    def entry(i: int) -> int:
        return 0 if i == 0 else gray(2 * ((i - 1) // 2))

    def ones_at_end(i: int) -> int:
        n = 0
        while i & 1:
            n, i = n + 1, i >> 1
        return n

    def direction(i: int) -> int:
        if i == 0:
            return 0
        return ones_at_end(i if i % 2 else i - 1) % dims

    digits, following = [], []
    for start in range(size):
        for way in range(dims):
            for corner in range(size):
                digit = place(turn(corner ^ start, way + 1))
                back = turn(entry(digit), dims - (way + 1) % dims)
                digits.append(digit)
                following.append((start ^ back) * dims + (way + direction(digit) + 1) % dims)
    return digits, following


def curve_index(levels: list[Column], bits: int = BITS) -> Column:
    """Place on the curve of a point given by whole numbers below 2**bits."""
    dims = len(levels)
    digits, following = curve_tables(dims)
    to_digit, to_state = F.array(*map(F.lit, digits)), F.array(*map(F.lit, following))

    def step(acc: Column, shift: Column) -> Column:
        corner = F.lit(0)
        for d, level in enumerate(levels):
            corner = corner + F.call_function("shiftright", level, shift).bitwiseAND(F.lit(1)) * (1 << d)
        at = acc["state"] * (1 << dims) + corner
        return F.struct(F.get(to_state, at).alias("state"), (acc["place"] * (1 << dims) + F.get(to_digit, at)).alias("place"))

    begin = F.struct(F.lit(0).alias("state"), F.lit(0).alias("place"))
    return F.aggregate(F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)]), begin, step, lambda acc: acc["place"])


def size_level(size: Column) -> Column:
    """How many of the fixed steps the size has reached."""
    return sum((F.when(size >= step, 1).otherwise(0) for step in SIZE_STEPS), F.lit(0))


def name_level(name: Column, bits: int = BITS) -> Column:
    """A name's level: the first digit of its MD5, so that equal names share it; null counts as its own name."""
    return F.conv(F.substr(F.md5(F.coalesce(name.cast("string"), F.lit("\0")).cast("binary")), F.lit(1), F.lit(1)), 16, 10).cast("int") % (1 << bits)


def shard_rows(docs: DataFrame, shards: int, levels: list[Column], bits: int = BITS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, curve): rows of `docs` in `shards` runs of the curve.

    The law is `rows`: run lengths differ by one at most, the first runs being the longer ones, and
    slots count from 0 without gaps. Within a cell rows go by the MD5 of id and text, then by id and
    checksum; rows equal in all of these are interchangeable. A null text has size 8 and checksum 0;
    a null id or metadata value is placed like any other. With fewer rows than shards the last
    shards stay empty; no rows give no rows.
    """
    text = docs[text_column].cast("string")
    mark = F.md5(F.concat_ws("\0", docs[id_column].cast("string"), F.md5(text.cast("binary"))).cast("binary"))
    rows = docs.select(
        docs[id_column].cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        *[level.cast("int").alias(f"l{i}") for i, level in enumerate(levels)],
        mark.alias("mark"),
    )
    rows = rows.select("doc_id", "size", "text_crc32", "mark", curve_index([F.col(f"l{i}") for i in range(len(levels))], bits).alias("curve"))
    rows = rows.withColumn("slice", F.conv(F.substr("mark", F.lit(1), F.lit(4)), 16, 10).cast("int") % SLICES)
    held = rows.groupBy("curve", "slice").agg(F.count(F.lit(1)).alias("n"))
    in_cell = W.partitionBy("curve").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    slices = held.select("curve", "slice", F.coalesce(F.sum("n").over(in_cell), F.lit(0)).alias("before"))
    # one row per cell of the curve, 2**(bits * dims) at most
    cells = held.groupBy("curve").agg(F.sum("n").alias("n"))
    along = W.orderBy("curve").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select("curve", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("ahead"), F.sum("n").over(W.partitionBy()).alias("total"))
    placed = rows.join(slices, ["curve", "slice"]).join(F.broadcast(cells), "curve")
    inside = W.partitionBy("curve", "slice").orderBy("mark", F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    rank = F.col("ahead") + F.col("before") + F.row_number().over(inside) - 1
    ranked = placed.select("doc_id", "size", "text_crc32", "curve", "total", rank.alias("rank"))
    each = F.floor(F.col("total") / shards).cast("long")
    longer = F.col("total") % shards
    in_longer = F.col("rank") < longer * (each + 1)
    later = F.col("rank") - longer * (each + 1)
    shard = F.when(in_longer, F.floor(F.col("rank") / (each + 1))).otherwise(longer + F.floor(later / each)).cast("int")
    slot = F.when(in_longer, F.col("rank") % (each + 1)).otherwise(later % each).cast("long")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.alias("shard"), slot.alias("slot"), "curve")


def corpus_levels(docs: DataFrame, text_column: str = "text") -> list[Column]:
    """Language, source and size of a corpus row as levels of the curve."""
    size = F.coalesce(F.octet_length(docs[text_column].cast("string")), F.lit(0)) + 8
    return [name_level(docs["lang"]), name_level(docs["source"]), size_level(size)]


def shard_bounds(sharded: DataFrame, columns: list[str]) -> DataFrame:
    """Smallest and largest value of each column in each shard: what a reader needs to skip shards."""
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))])
