"""Sums of distances between all points of the plane or of space, without listing the pairs.

The Euclidean silhouette needs, for every point, the summed distance from all points of each cluster. Away from
zero a distance is a smooth function of both its ends, so the points of a box act on a box farther away like weights
on a small Chebyshev grid (Fong and Darve, 2009). Boxes halve level by level; each meets those that are not next to it
but whose parents are, and only points of neighbouring smallest boxes are compared one by one. Work grows with the
points, times the number of levels. With `NODES` grid points a side, sums of far boxes are right to some nine digits.
"""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.session import durable

# Grid points of a box for each dimension, by dimension.
NODES = {1: 16, 2: 12, 3: 8}
MOST_DIMS = max(NODES)
# Levels looked at in one go, and levels at most: smaller boxes are below the precision of the coordinates.
LEVEL_STEP, MOST_LEVELS = 8, 44
# Points of a smallest box that one task holds.
PART_ROWS = 8192
# Distances worked out at a time; so few stay in the cache of a core.
STRIP_NUMBERS = 1 << 15
TASKS_PER_CORE = 4

NODE = "level int, cell array<long>, at binary, names binary, weights binary"


def silhouette_sum(spots: DataFrame, sizes: dict[int, int], dims: int) -> float:
    """Summed silhouette of all points. `spots` are distinct (x, c) with their count `n`, without nulls; `sizes`
    are the points of each cluster, at least two of them."""
    low, high = _corners(spots, dims)
    side = float(max(high - low)) or 1.0
    spots = durable(spots.withColumn("deep", _cell(low, side, MOST_LEVELS)))
    level, most = _smallest_boxes(spots, dims)
    tasks = TASKS_PER_CORE * spots.sparkSession.sparkContext.defaultParallelism
    line = [F.col("x")[j].alias(f"x{j}") for j in range(dims)]
    placed = spots.select(*line, "c", "n", _above("deep", MOST_LEVELS - level).alias("cell"))
    parts = F.lit(0)
    if most > PART_ROWS:
        held = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("_parts"))
        placed, parts = placed.join(held, "cell"), F.pmod(F.xxhash64(*[f"x{j}" for j in range(dims)], "c"), F.col("_parts")).cast("int")
    dealt = placed.withColumn("part", parts).repartition(tasks, "cell", "part")
    leaves = durable(dealt.groupBy("cell", "part").applyInPandas(_pack, "cell array<long>, part int, x binary, c binary, n binary"))
    none = {k: F.lit(None).cast("binary") for k in ("x", "c", "n", "names", "u")}
    shape = ["cell", "part", "level", "x", "c", "n", "names", "u"]
    own = leaves.withColumn("level", F.lit(-1)).withColumns({k: none[k] for k in ("names", "u")}).select(*shape)
    around = [F.array(*[F.lit(o).cast("long") for o in offset]) for offset in product((-1, 0, 1), repeat=dims)]
    beside = leaves.select("cell", "part", F.explode(F.array(*around)).alias("_o"))
    beside = beside.select("part", "cell", F.zip_with("cell", "_o", lambda a, b: a + b).alias("near"))
    near = beside.join(leaves.select(F.col("cell").alias("near"), "x", "c", "n"), "near")
    found = own.unionByName(near.withColumn("level", F.lit(0)).withColumns({k: none[k] for k in ("names", "u")}).select(*shape))
    if level > 1:
        far = _from_far(leaves, low, side, level, dims, tasks)
        levels = F.explode(F.sequence(F.lit(2), F.lit(level))).alias("level")
        over = leaves.select("cell", "part", levels).withColumn("_box", F.transform("cell", lambda v: F.call_function("shiftright", v, F.lit(level) - F.col("level"))))
        over = over.join(far.withColumnRenamed("cell", "_box"), ["level", "_box"])
        found = found.unionByName(over.withColumns({k: none[k] for k in ("x", "c", "n")}).select(*shape))

    names = np.array(sorted(sizes))
    counts = np.array([float(sizes[c]) for c in names])

    def scored(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        mine = group[group["level"] < 0].iloc[0]
        x, c, n = _points(mine, dims)
        total = np.zeros((len(x), len(names)))
        for row in group[group["level"] == 0].itertuples():
            y, other, weight = _points(row, dims)
            total += _summed(x, y, _by_cluster(np.searchsorted(names, other), weight, len(names)))
        for row in group[group["level"] > 0].itertuples():
            width = side / 2**row.level
            box = np.array([v >> (level - row.level) for v in key[0]])
            which = np.searchsorted(names, np.frombuffer(row.names, np.int64))
            total[:, which] += _grid_weights(x, low + box * width, width, dims) @ np.frombuffer(row.u).reshape(-1, len(which))
        at, rows = np.searchsorted(names, c), np.arange(len(x))
        inner = total[rows, at] / np.maximum(counts[at] - 1, 1)
        outer = total / counts
        outer[rows, at] = np.inf
        outer = outer.min(axis=1)
        width = (outer - inner) / np.maximum(np.maximum(inner, outer), 1e-300)
        return pd.DataFrame({"s": [float((n * np.where(counts[at] > 1, width, 0.0)).sum())]})

    return found.repartition(tasks, "cell", "part").groupBy("cell", "part").applyInPandas(scored, "s double").agg(F.sum("s")).first()[0]


def _corners(spots: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    ends = [f(F.col("x")[j]) for f in (F.min, F.max) for j in range(dims)]
    row = spots.agg(*ends).first()
    return np.array(row[:dims]), np.array(row[dims:])


def _cell(low: np.ndarray, side: float, level: int) -> Column:
    """Whole-number coordinates of the box that holds `x`."""
    last = 2**level - 1

    def place(v: Column, j: Column) -> Column:
        start = F.element_at(F.array(*[F.lit(float(a)) for a in low]), j + 1)
        return F.least(F.floor((v - start) / F.lit(side) * F.lit(float(2**level))), F.lit(last).cast("long"))

    return F.transform("x", place)


def _above(cell: str, levels: int) -> Column:
    return F.transform(cell, lambda v: F.call_function("shiftright", v, F.lit(levels)))


def _smallest_boxes(spots: DataFrame, dims: int) -> tuple[int, int]:
    """The level at which near and far boxes cost least together, and the most spots that one of its boxes holds."""
    grid, costs, done, held = NODES[dims] ** dims, {}, -1, 0
    while done < MOST_LEVELS:
        deepest = min(done + LEVEL_STEP, MOST_LEVELS)
        boxes = spots.groupBy(_above("deep", MOST_LEVELS - deepest).alias("cell")).agg(F.count(F.lit(1)).alias("k"))
        levels = F.explode(F.sequence(F.lit(done + 1), F.lit(deepest))).alias("level")
        every = boxes.select("k", "cell", levels).select("k", "level", F.transform("cell", lambda v: F.call_function("shiftright", v, F.lit(deepest) - F.col("level"))).alias("cell"))
        found = every.groupBy("level", "cell").agg(F.sum("k").cast("double").alias("k")).groupBy("level").agg(
            F.sum(F.col("k") * F.col("k")).alias("pairs"), F.sum(F.least(F.col("k"), F.lit(float(grid)))).alias("held"), F.max("k").alias("most")
        )
        for row in found.orderBy("level").collect():
            # every box meets at most 6^d - 3^d boxes of its level
            held += row["held"] if row["level"] > 1 else 0
            costs[row["level"]] = (3**dims * row["pairs"] + (6**dims - 3**dims) * grid * held, row["most"])
        done = deepest
        best = min(costs, key=lambda at: costs[at][0])
        if best < done or costs[done][1] <= 1:
            break
    return best, int(costs[best][1])


def _pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    x = np.ascontiguousarray(group[[c for c in group.columns if c.startswith("x")]].to_numpy(float))
    return pd.DataFrame({
        "cell": [list(key[0])], "part": [key[1]], "x": [x.tobytes()],
        "c": [group["c"].to_numpy(np.int64).tobytes()], "n": [group["n"].to_numpy(float).tobytes()],
    })


def _points(row, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row.x).reshape(-1, dims), np.frombuffer(row.c, np.int64), np.frombuffer(row.n)


def _by_cluster(codes: np.ndarray, weight: np.ndarray, wide: int) -> np.ndarray:
    out = np.zeros((len(codes), wide))
    out[np.arange(len(codes)), codes] = weight
    return out


def _summed(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Distances of `x` from `y`, added up with each column of weights."""
    used = np.flatnonzero(weights.any(axis=0))
    out, narrow = np.zeros((len(x), weights.shape[1])), weights[:, used]
    step = max(1, STRIP_NUMBERS // max(1, len(y)))
    for at in range(0, len(x), step):
        gap = np.zeros((len(x[at : at + step]), len(y)))
        for j in range(x.shape[1]):
            gap += np.square(x[at : at + step, j, None] - y[None, :, j])
        out[at : at + step, used] = np.sqrt(gap, out=gap) @ narrow
    return out


def _grid(start: np.ndarray, width: float, dims: int) -> np.ndarray:
    """The Chebyshev grid of a box."""
    line = np.cos((2 * np.arange(NODES[dims]) + 1) * math.pi / (2 * NODES[dims]))
    return start + (np.array(list(product(line, repeat=dims))) + 1) * (width / 2)


def _grid_weights(x: np.ndarray, start: np.ndarray, width: float, dims: int) -> np.ndarray:
    """How much of each grid point of a box every point is worth, by polynomial interpolation."""
    p = NODES[dims]
    turns = np.arange(p)
    line = np.cos(np.outer(turns, (2 * np.arange(p) + 1) * math.pi / (2 * p))) * np.where(turns, 2.0, 1.0)[:, None] / p
    out = np.ones((len(x), 1))
    for j in range(dims):
        here = np.clip((x[:, j] - start[j]) / width * 2 - 1, -1, 1)
        share = np.cos(turns * np.arccos(here)[:, None]) @ line
        out = (out[:, :, None] * share[:, None, :]).reshape(len(x), -1)
    return out


def _condensed(at: np.ndarray, weights: np.ndarray, start: np.ndarray, width: float, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The points of a box as they are, or moved to its grid where that is less."""
    if len(at) <= NODES[dims] ** dims:
        return at, weights
    return _grid(start, width, dims), _grid_weights(at, start, width, dims).T @ weights


def _from_far(leaves: DataFrame, low: np.ndarray, side: float, level: int, dims: int, tasks: int) -> DataFrame:
    """(level, cell, names, u): for every box and cluster the summed distances of its grid points from the boxes that
    it is the first to see from afar."""

    def row_of(at_level, cell, at, names, weights):
        return [at_level, list(cell), at.tobytes(), np.asarray(names, np.int64).tobytes(), np.ascontiguousarray(weights).tobytes()]

    columns = ["level", "cell", "at", "names", "weights"]

    def raised(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples():
                x, c, n = _points(row, dims)
                names, codes = np.unique(c, return_inverse=True)
                weights = _by_cluster(codes, n, len(names))
                for up in range(2, level + 1):
                    cell, width = np.array([v >> (level - up) for v in row.cell]), side / 2**up
                    at, moved = _condensed(x, weights, low + cell * width, width, dims)
                    out.append(row_of(up, cell, at, names, moved))
            yield pd.DataFrame(out, columns=columns)

    def merged(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        held = [(np.frombuffer(r.at).reshape(-1, dims), np.frombuffer(r.names, np.int64), np.frombuffer(r.weights)) for r in group.itertuples()]
        names = np.unique(np.concatenate([h[1] for h in held]))
        weights = []
        for at, own, w in held:
            wide = np.zeros((len(at), len(names)))
            wide[:, np.searchsorted(names, own)] = w.reshape(len(at), -1)
            weights.append(wide)
        return np.concatenate([h[0] for h in held]), names, np.concatenate(weights)

    def joined(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        at, names, weights = merged(group)
        width = side / 2 ** key[0]
        at, weights = _condensed(at, weights, low + np.array(key[1]) * width, width, dims)
        return pd.DataFrame([row_of(key[0], key[1], at, names, weights)], columns=columns)

    def seen(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        width = side / 2 ** key[0]
        at, names, weights = merged(group)
        u = _summed(_grid(low + np.array(key[1]) * width, width, dims), at, weights)
        return pd.DataFrame({"level": [key[0]], "cell": [list(key[1])], "names": [names.tobytes()], "u": [u.tobytes()]})

    parts = leaves.select("cell", "x", "c", "n").mapInPandas(raised, NODE)
    boxes = durable(parts.repartition(tasks, "level", "cell").groupBy("level", "cell").applyInPandas(joined, NODE))
    # children of the parent's neighbours
    offsets = [F.array(*[F.lit(o).cast("long") for o in offset]) for offset in product(range(-2, 4), repeat=dims)]
    met = boxes.select("level", "cell", F.explode(F.array(*offsets)).alias("_o"))
    met = met.withColumn("_other", F.zip_with("cell", "_o", lambda v, o: v - F.pmod(v, F.lit(2)) + o)).drop("_o")
    apart = F.exists(F.zip_with("cell", "_other", lambda v, o: F.abs(v - o)), lambda gap: gap > 1)
    pairs = met.filter(apart).join(boxes.withColumnRenamed("cell", "_other"), ["level", "_other"]).drop("_other")
    return pairs.repartition(tasks, "level", "cell").groupBy("level", "cell").applyInPandas(seen, "level int, cell array<long>, names binary, u binary")
