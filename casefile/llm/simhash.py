"""Near-duplicate groups by SimHash fingerprints.

Fingerprints are embedded by the number of set bits in each of 32 segments. The Manhattan
distance of two embeddings is never above the Hamming distance of the fingerprints, so a range
join on the grid of embeddings finds every possible partner. The join lists no pairs: two
points of the grid lie within 2 of each other exactly if some grid point is within 1 of both, so
every point is sent to itself and its direct neighbours, and points that meet nobody are out.
The same is done exactly for the fingerprints that are left: two of them differ in at most two
bits exactly if some 64-bit word differs in at most one bit from both. What meets is linked to
the smallest fingerprint present, which grows with the rows and not with pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.llm.common import fresh_name, texts_of
from casefile.session import durable

SHINGLE = 3
# Segments of two bits hold 0, 1 or 2: enough different points that chance meetings stay rare in billions of fingerprints.
SEGMENTS = 32
_EVEN = 0x5555555555555555
# Shingles whose bits are counted at once, so that a very long text needs no large array.
BLOCK = 1 << 16
MAX_ROUNDS = 200


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit-wise majority of the XXH64 values of all word shingles, as a signed long; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    first, last = starts[:n].tolist(), ends[min(shingle, len(words)) - 1 :].tolist()
    votes = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        cut = [xxhash.xxh64_intdigest(line[a:b], 42) for a, b in zip(first[at : at + BLOCK], last[at : at + BLOCK], strict=True)]
        rows = np.array(cut, dtype=">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    bits = (votes * 2 > n).astype(np.uint8)
    return int(np.packbits(bits).view(">i8")[0])


def fingerprint_of(text: Column) -> Column:
    """Fingerprints of whole texts, batch by batch."""

    @F.pandas_udf("long")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t) for t in batch], dtype="int64")

    return run(text)


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _cell(value: Column) -> Column:
    """Set bits of each segment, two binary digits each, added without carry into the sign."""
    low, high = value.bitwiseAND(F.lit(_EVEN)), F.shiftrightunsigned(value, 1).bitwiseAND(F.lit(_EVEN))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _near_cells(cell: Column) -> Column:
    """The cell and all others within Manhattan distance 1."""
    found = [cell]
    for i in range(SEGMENTS):
        here = F.shiftrightunsigned(cell, 2 * i).bitwiseAND(F.lit(3))
        both = 3 << 2 * i
        # 0 and 1 differ in one digit, 1 and 2 in both
        found.append(F.when(here < 2, cell.bitwiseXOR(F.lit(1 << 2 * i).cast("long"))))
        found.append(F.when(here > 0, cell.bitwiseXOR(F.lit(both - (1 << 64) if both >> 63 else both).cast("long"))))
    return F.array_compact(F.array(*found))


def _near_words(value: Column) -> Column:
    """The fingerprint and all words one bit away."""
    flips = F.array(*[F.lit(-(1 << 63) if i == 63 else 1 << i).cast("long") for i in range(64)])
    return F.concat(F.array(value), F.transform(flips, lambda f: value.bitwiseXOR(f)))


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """(a, b): links that join all distinct values of `fp` within Hamming distance 2 into their groups.

    Links are between values at most 4 apart that share a word within one bit of both; the
    groups they make are those of the values at most 2 apart.
    """
    cells = prints.select("fp", _cell(F.col("fp")).alias("cell"))
    held = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    near = held.select("cell", "n", F.explode(_near_cells(F.col("cell"))).alias("spot"))
    meeting = near.groupBy("spot").agg(F.sum("n").alias("n")).filter("n > 1").select("spot")
    # a cell is of use if one of its spots saw more than one fingerprint
    useful = near.join(meeting, "spot", "left_semi").select("cell").distinct()
    left = cells.join(useful, "cell", "left_semi").select("fp")
    words = left.select("fp", F.explode(_near_words(F.col("fp"))).alias("word"))
    heads = words.groupBy("word").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("all")).filter(F.size("all") > 1)
    return heads.select("a", F.explode("all").alias("b")).filter("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(fp, head): every linked value with the smallest one of its group, the head itself included.

    Large-star and small-star rounds in turn, written out each time, until nothing moves. Every
    node in a round is summed up by one minimum before the join, and adaptive execution can split
    the links of a node that has very many.
    """
    links = durable(links.select("a", "b"))
    if links.isEmpty():
        return links.select(F.col("a").alias("fp"), F.col("b").alias("head"))
    for _ in range(MAX_ROUNDS):
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        large = durable(large)
        # small-star: larger end b keeps its smaller neighbours, all tied to the smallest of them
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        tied = large.join(low, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
        small = tied.unionByName(low.select(F.col("m").alias("x"), F.col("b").alias("y"))).filter("x <> y")
        small = durable(small.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        moved = small.join(links, ["a", "b"], "left_anti").limit(1).count() + links.join(small, ["a", "b"], "left_anti").limit(1).count()
        links = small
        if not moved:
            heads = links.select(F.col("a").alias("fp"), F.col("a").alias("head")).distinct()
            return links.select(F.col("b").alias("fp"), F.col("a").alias("head")).unionByName(heads)
    raise RuntimeError(f"groups did not settle within {MAX_ROUNDS} rounds")


def fingerprint_groups(prints: DataFrame) -> DataFrame:
    """(fp, head) for all values of `fp` that have a partner."""
    return components(fingerprint_links(prints.select("fp").distinct()))


def simhash_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of `docs`.

    `component_id` is the smallest id reachable over fingerprints at most two bits apart. Null,
    empty and blank texts have the fingerprint zero and are linked like any other; rows without
    an id are labelled like the rest and give no label themselves (null if nobody has an id).
    Equal rows stay as they are; other columns are ignored; no rows give no rows.
    """
    texts = texts_of(docs, id_column, text_column)
    rows = durable(texts.select("doc_id", fingerprint_of(F.col("text")).alias("fp")))
    prints = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    groups = prints.join(fingerprint_groups(prints), "fp", "left").select("fp", F.coalesce("head", "fp").alias("head"), "least")
    labels = groups.groupBy("head").agg(F.min("least").alias("component_id"))
    named = groups.join(labels, "head").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs`, one for each near-duplicate group, all columns kept.

    The row with the smallest id stays (rows without id last; among equal ids the smallest
    SHA-256 of the text; of rows equal in both, any one).
    """
    mark, best, own = (fresh_name(docs, n) for n in ("fp_of_row", "best_of_group", "key_of_row"))
    key = F.struct(F.col(id_column).isNull().alias("n"), F.col(id_column).cast("long").alias("i"), F.sha2(F.col(text_column).cast("binary"), 256).alias("h"))
    rows = docs.withColumn(mark, fingerprint_of(F.col(text_column).cast("string")))
    prints = durable(rows.groupBy(mark).agg(F.min(key).alias("least")).withColumnRenamed(mark, "fp"))
    groups = prints.join(fingerprint_groups(prints), "fp", "left").select(F.coalesce("head", "fp").alias("head"), "fp", "least")
    winners = groups.groupBy("head").agg(F.min_by(F.struct("fp", "least"), "least").alias("w"))
    # a winner is the best row of its own fingerprint, so the table is joined once, with few rows
    winners = winners.select(F.col("w.fp").alias(mark), F.col("w.least").alias(best))
    kept = rows.join(winners, mark).withColumn(own, key).filter(F.col(own).eqNullSafe(F.col(best)))
    return kept.dropDuplicates([mark]).select(*docs.columns)
