"""Comparison of all points with all others, block by block."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Points of a block at most, and numbers: a task holds two blocks of some tens of megabytes.
BLOCK_ROWS, BLOCK_NUMBERS = 65_536, 4 << 20
# Blocks of this many points are not cut further to give all cores work.
SMALL_BLOCK_ROWS = 2048
PAIRS_PER_CORE = 4
# Distances that a task holds at a time.
STRIP_NUMBERS = 2 << 20


def block_pairs(points: DataFrame, key: str, block_rows: int = BLOCK_ROWS):
    """Every ordered pair of blocks of `points`, whose vectors are in `x`, for `applyInPandas`.

    Blocks are dealt by the hash of `key`, which must be nearly unique. No task holds more than
    two blocks at a time; the rows moved are the points times the number of blocks. There are as
    many blocks as give all cores work; only tables beyond that many full blocks are cut further.
    """
    rows, width = points.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    small = min(block_rows, SMALL_BLOCK_ROWS)
    full = max(small, min(block_rows, BLOCK_NUMBERS // max(1, width or 1)))
    busy = math.ceil(math.sqrt(PAIRS_PER_CORE * points.sparkSession.sparkContext.defaultParallelism))
    blocks = max(1, -(-rows // full), min(-(-rows // small), busy))
    here = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    # a few more partitions than pairs, so that hardly two of them meet in one
    tasks = 1 if blocks == 1 else min(4 * blocks * blocks, 10_000)
    left = points.withColumn("_i", here).withColumn("_j", every).repartition(tasks, "_i", "_j")
    right = points.withColumn("_j", here).withColumn("_i", every).repartition(tasks, "_i", "_j")
    return left.groupBy("_i", "_j").cogroup(right.groupBy("_i", "_j"))


def strips(rows: int, across: int) -> Iterator[slice]:
    """Slices of the rows of one block whose distances from `across` points may be held at once."""
    step = max(1, STRIP_NUMBERS // max(1, across))
    for at in range(0, rows, step):
        yield slice(at, min(at + step, rows))


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of `x` from all rows of `y`."""
    return np.sqrt(np.maximum((x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1) - 2 * x @ y.T, 0.0))


def within(x: np.ndarray, y: np.ndarray, eps: float) -> np.ndarray:
    """Which rows of `y` are at most `eps` from each row of `x`; pairs too close to that for a
    matrix product to tell are measured one by one."""
    own, other = (x**2).sum(axis=1), (y**2).sum(axis=1)
    gap = own[:, None] + other - 2 * x @ y.T - eps * eps
    unsure = np.finfo(float).eps * (4 * x.shape[1] + 16) * (own[:, None] + other + eps * eps)
    near = gap <= 0
    a, b = np.nonzero(~(np.abs(gap) > unsure))
    for at in range(0, len(a), 16_384):
        i, j = a[at : at + 16_384], b[at : at + 16_384]
        near[i, j] = np.cumsum((x[i] - y[j]) ** 2, axis=1)[:, -1] <= eps * eps
    return near
