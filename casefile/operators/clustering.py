"""KMeans with restarts, exact DBSCAN, and the search grid over embeddings."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.functions.values import col
from casefile.operators.pairs import block_pairs, strips, within
from casefile.operators.ranking import running_totals
from casefile.session import broadcast_if_small, durable

# Pairs of candidate boxes are compared point by point once this few pairs are left.
DIRECT_PAIRS = 65_536
# Dimensions up to which the neighbour cells of a grid cell are simply listed.
GRID_DIMS = 3
# Dimensions above which cells hold single points and boxes keep few of them apart: all spots are compared there, block by block.
BOX_DIMS = 10
# Points of one cell that meet a neighbour in one task.
SALT_ROWS = 100_000
MAX_LEVELS = 400
# KMeans runs that share the cluster.
STARTS_AT_ONCE = 4


def kmeans(df: DataFrame, id_col: str, vec: str, k: int, starts: int = 10, seed: int = 42) -> DataFrame:
    """(id, cluster): the best of several seeded runs by within-cluster cost, some of them side by side."""
    points = df.select(col(id_col), array_to_vector(col(vec)).alias("features")).persist()

    def one(s: int) -> tuple[float, int, KMeansModel]:
        model = KMeans(k=k, seed=seed + s, initMode="k-means||", maxIter=100).fit(points)
        return model.summary.trainingCost, s, model

    with ThreadPool(min(starts, STARTS_AT_ONCE)) as pool:
        best = min(pool.map(inheritable_thread_target(df.sparkSession)(one), range(starts)), key=lambda found: found[:2])
    out = best[2].transform(points).select(col(id_col), F.col("prediction").alias("cluster"))
    out = durable(out)
    points.unpersist()
    return out


def dbscan(df: DataFrame, id_col: str, vec: str, eps: float, min_samples: int = 10) -> DataFrame:
    """(id, cluster): density clusters numbered by their smallest core point, -1 noise.

    Exact. Points fall into cells whose diagonal is at most eps, so points of one
    cell are neighbours without being compared, and a cell with `min_samples` points
    needs no counting at all. Equal points are one location with a weight. Only cells
    within reach are compared, and two full cells through ever smaller boxes, never
    pair by pair. In more than `BOX_DIMS` dimensions all locations are compared, block
    by block, and only counts and spanning forests leave a task. A point that reaches
    several clusters joins the one with the smallest core point. Ids are whole numbers.
    """
    points = df.select(col(id_col).cast("long").alias("id"), col(vec).cast("array<double>").alias("x"))
    # 0.0 and -0.0 are the same place
    points = points.withColumn("x", F.transform("x", lambda v: v + F.lit(0.0)))
    spots = durable(points.groupBy("x").agg(F.min("id").alias("spot"), F.count(F.lit(1)).alias("n")))
    first = spots.select(F.size("x").alias("d")).first()
    if first is None:
        return df.select(col(id_col), F.lit(-1).alias("cluster"))
    dims = first["d"]
    labels, label = (_by_cells if dims <= BOX_DIMS else _by_blocks)(spots, eps, dims, min_samples)
    numbers = running_totals(
        labels.select(F.col("label").cast("double").alias("at"), F.lit(1).alias("one")).distinct(), "at", ["one"]
    ).select(F.col("at").cast("long").alias("label"), (F.col("cum_one") - 1).cast("int").alias("cluster"))
    done = spots.select("x", "spot").join(label, "spot", "left").join(numbers, "label", "left").select("x", "cluster")
    done, _ = broadcast_if_small(done)
    out = points.join(done, "x")
    return out.select(F.col("id").alias(id_col), F.coalesce("cluster", F.lit(-1)).alias("cluster"))


def _by_cells(spots: DataFrame, eps: float, dims: int, min_samples: int) -> tuple[DataFrame, DataFrame]:
    """(label) of all clusters and (spot, label), by cells within reach."""
    side = eps / math.sqrt(dims) * (1 - 1e-9)
    spots = spots.withColumn("cell", F.transform("x", lambda v: F.floor(v / side)))
    cells = spots.groupBy("cell").agg(F.sum("n").alias("held"), F.count(F.lit(1)).alias("spots"), *_corners(dims))
    cells = durable(_as_box(cells, dims, "cell", "held", "spots"))
    near = durable(_grid_pairs(cells, side, eps, dims) if dims <= GRID_DIMS else _tree_pairs(cells, side, eps, dims))
    spots = durable(spots.join(cells.select("cell", "held"), "cell"))
    core = durable(_core_spots(spots, cells, near, eps, min_samples))
    flags = core.withColumn("core", F.lit(True))
    spots = durable(spots.join(flags, "spot", "left").withColumn("core", F.coalesce("core", F.lit(False))))
    core_spots = spots.filter("core").select("cell", "spot", "x")
    heads = durable(core_spots.groupBy("cell").agg(F.min("spot").alias("head")))
    links = _linked_cells(core_spots, heads, near, side, eps, dims)
    labels = connected_components(heads.select(F.col("head").alias("id")), links).withColumnRenamed("id", "head")
    cell_label = heads.join(labels, "head").select("cell", "label")
    inside = spots.join(cell_label, "cell").select("spot", "label")
    reached = _reached(spots.filter("not core"), core_spots, cells, near, eps).join(
        cell_label.withColumnRenamed("cell", "other"), "other"
    ).select("spot", "label")
    return labels, inside.unionByName(reached).groupBy("spot").agg(F.min("label").alias("label"))


def _by_blocks(spots: DataFrame, eps: float, dims: int, min_samples: int) -> tuple[DataFrame, DataFrame]:
    """The same from all pairs of spots, block by block.

    Neighbours are counted, not listed; of the links between two blocks a task returns a spanning
    forest, no longer than the blocks.
    """
    spots = durable(spots.filter(F.col("x").isNotNull()).withColumn("place", F.monotonically_increasing_id()))

    def counted(left, right):
        held = np.zeros(len(left))
        weight = right["n"].to_numpy(dtype=float)
        for part, near in _near_strips(left, right, eps):
            held[part] = near @ weight
        return pd.DataFrame({"place": left["place"], "held": np.rint(held).astype("int64")})

    blocks = block_pairs(spots.select("place", "x", "n"), "place")
    held = blocks.applyInPandas(counted, "place long, held long").groupBy("place").agg(F.sum("held").alias("held"))
    core = held.select("place", (F.col("held") >= min_samples).alias("_full"))
    spots = spots.join(core, "place").select("place", "spot", "x", (F.col("_full") & F.col("spot").isNotNull()).alias("core"))
    spots = durable(spots)
    core_spots = durable(spots.filter("core").select("place", "spot", "x"))

    def forest(key, left, right):
        edges = []
        if key[0] <= key[1]:
            root = np.arange(len(right))
            places = left["place"].to_numpy()
            for part, near in _near_strips(left, right, eps):
                for a, row in zip(places[part].tolist(), near, strict=True):
                    met = root[row]
                    if len(met) and (met == met[0]).all():
                        edges.append((a, met[0]))
                    elif len(met):
                        trees = np.unique(met)
                        edges += [(a, t) for t in trees.tolist()]
                        root[np.isin(root, trees)] = trees[0]
        found = pd.DataFrame(edges, columns=["a", "b"], dtype="int64")
        return found.assign(b=right["place"].to_numpy()[found["b"].to_numpy()])

    links = block_pairs(core_spots.select("place", "x"), "place").applyInPandas(forest, "a long, b long").filter("a <> b")
    parts = connected_components(core_spots.select(F.col("place").alias("id")), links)
    parts = durable(core_spots.select("place", "spot").join(parts.withColumnRenamed("id", "place").withColumnRenamed("label", "tree"), "place"))
    named = parts.groupBy("tree").agg(F.min("spot").alias("label"))
    labels = durable(parts.join(named, "tree").select("place", "spot", "label"))
    marked = durable(spots.join(labels.select("place", "label"), "place", "left").select("place", "spot", "x", "core", F.coalesce("label", F.lit(0)).alias("label")))

    def reached(left, right):
        left, right = left[~left["core"]], right[right["core"]].sort_values("label")
        label = right["label"].to_numpy()
        found = []
        for part, near in _near_strips(left, right, eps):
            some = near.any(axis=1)
            found.append(pd.DataFrame({"place": left["place"].to_numpy()[part][some], "label": label[near.argmax(axis=1)[some]]}))
        return pd.concat(found) if found else pd.DataFrame({"place": [], "label": []})

    borders = block_pairs(marked.drop("spot"), "place").applyInPandas(reached, "place long, label long")
    inside = labels.select("spot", "label")
    outside = borders.join(spots.select("place", "spot"), "place").select("spot", "label")
    return labels, inside.unionByName(outside).groupBy("spot").agg(F.min("label").alias("label"))


def _near_strips(left: pd.DataFrame, right: pd.DataFrame, eps: float) -> Iterator[tuple[slice, np.ndarray]]:
    """Which places of the right block are within eps of those of the left one, some rows at a time."""
    if left.empty or right.empty:
        return
    x, y = np.stack(left["x"].to_numpy()), np.stack(right["x"].to_numpy())
    own, there = left["place"].to_numpy(), right["place"].to_numpy()
    for part in strips(len(x), len(y)):
        yield part, within(x[part], y, eps) | (own[part][:, None] == there[None, :])


# ---- boxes ------------------------------------------------------------------


def _corners(dims: int, low: str = "x", high: str = "x") -> list[F.Column]:
    lows = [F.min(F.get(low, j)).alias(f"_lo{j}") for j in range(dims)]
    return lows + [F.max(F.get(high, j)).alias(f"_hi{j}") for j in range(dims)]


def _as_box(df: DataFrame, dims: int, *keep: str) -> DataFrame:
    lo, hi = F.array(*[f"_lo{j}" for j in range(dims)]), F.array(*[f"_hi{j}" for j in range(dims)])
    return df.select(*keep, lo.alias("lo"), hi.alias("hi"))


def _sum_squares(a: F.Column) -> F.Column:
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v)


def _distance2(a: F.Column, b: F.Column) -> F.Column:
    return _sum_squares(F.zip_with(a, b, lambda p, q: p - q))


def _gap2(lo_a, hi_a, lo_b, hi_b) -> F.Column:
    """Squared distance between the nearest points of two boxes."""
    one = F.zip_with(lo_b, hi_a, lambda p, q: F.greatest(p - q, F.lit(0.0)))
    two = F.zip_with(lo_a, hi_b, lambda p, q: F.greatest(p - q, F.lit(0.0)))
    return _sum_squares(F.zip_with(one, two, lambda p, q: F.greatest(p, q)))


def _span2(lo_a, hi_a, lo_b, hi_b) -> F.Column:
    """Squared distance between the farthest points of two boxes."""
    one = F.zip_with(hi_b, lo_a, lambda p, q: F.abs(p - q))
    two = F.zip_with(hi_a, lo_b, lambda p, q: F.abs(p - q))
    return _sum_squares(F.zip_with(one, two, lambda p, q: F.greatest(p, q)))


# ---- cells within reach -----------------------------------------------------


def _grid_pairs(cells: DataFrame, side: float, eps: float, dims: int) -> DataFrame:
    """(cell, other) for all ordered pairs of cells within eps, by listing the fixed
    set of neighbour offsets of each cell."""
    reach = math.ceil(eps / side)
    offsets = []
    for o in product(range(-reach, reach + 1), repeat=dims):
        gap2 = sum((max(abs(v) - 1, 0) * side) ** 2 for v in o)
        if any(o) and gap2 <= eps * eps:
            offsets.append(F.array(*[F.lit(v).cast("long") for v in o]))
    around = cells.select("cell", "lo", "hi", F.explode(F.array(*offsets)).alias("_o"))
    around = around.withColumn("other", F.zip_with("cell", "_o", lambda a, b: a + b)).drop("_o")
    there = cells.select(F.col("cell").alias("other"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    gap2 = _gap2(F.col("lo"), F.col("hi"), F.col("lo2"), F.col("hi2"))
    return around.join(there, "other").filter(gap2 <= eps * eps).select("cell", "other")


def _tree_pairs(cells: DataFrame, side: float, eps: float, dims: int) -> DataFrame:
    """The same in many dimensions, where offsets cannot be listed: pairs of boxes
    within reach are halved along the widest dimensions, level by level, until few
    cells are left in a pair."""
    extent = cells.agg(*_corners(dims, "lo", "hi")).first()
    origin = [extent[f"_lo{j}"] for j in range(dims)]
    widths = [max(extent[f"_hi{j}"] - origin[j], side) * 1.000001 for j in range(dims)]

    def node(width: list[float]) -> F.Column:
        return F.array(*[F.floor((F.get("lo", j) - origin[j]) / width[j]) for j in range(dims)])

    found = None
    pending = None
    for _ in range(MAX_LEVELS):
        placed = durable(cells.withColumn("node", node(widths)))
        boxes = _as_box(placed.groupBy("node").agg(F.count(F.lit(1)).alias("size"), *_corners(dims, "lo", "hi")), dims, "node", "size")
        if pending is None:
            pending = boxes.select(F.col("node").alias("a"), F.col("node").alias("b"))
        left = boxes.select(F.col("node").alias("a"), F.col("lo").alias("lo1"), F.col("hi").alias("hi1"), F.col("size").alias("s1"))
        right = boxes.select(F.col("node").alias("b"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.col("size").alias("s2"))
        gap2 = _gap2(F.col("lo1"), F.col("hi1"), F.col("lo2"), F.col("hi2"))
        open_pairs = durable(pending.join(left, "a").join(right, "b").filter(gap2 <= eps * eps).select("a", "b", "s1", "s2"))
        finest = all(w <= side for w in widths)
        few = (F.col("s1") * F.col("s2") <= DIRECT_PAIRS) | F.lit(finest)
        here = placed.select(F.col("node").alias("a"), "cell", F.col("lo").alias("lo1"), F.col("hi").alias("hi1"))
        there = placed.select(F.col("node").alias("b"), F.col("cell").alias("other"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
        close = open_pairs.filter(few).select("a", "b").join(here, "a").join(there, "b").filter(gap2 <= eps * eps)
        part = durable(close.filter(F.col("cell") != F.col("other")).select("cell", "other"))
        found = part if found is None else found.unionByName(part)
        wide = open_pairs.filter(~few).select("a", "b")
        if wide.isEmpty():
            # unordered pairs of nodes were followed; give both directions
            mirrored = found.select(F.col("other").alias("cell"), F.col("cell").alias("other"))
            return found.unionByName(mirrored).distinct()
        widest = sorted(range(dims), key=lambda j: -widths[j])[:2]
        finer = [w / 2 if j in widest else w for j, w in enumerate(widths)]
        children = placed.select("node", node(finer).alias("child")).distinct()
        grown = wide.join(children.select(F.col("node").alias("a"), F.col("child").alias("a2")), "a")
        grown = grown.join(children.select(F.col("node").alias("b"), F.col("child").alias("b2")), "b")
        pending = grown.filter((F.col("a") != F.col("b")) | (F.col("a2") <= F.col("b2")))
        pending = durable(pending.select(F.col("a2").alias("a"), F.col("b2").alias("b")))
        widths = finer
    raise RuntimeError("cells could not be separated; is eps positive?")


def _salted_meet(few: DataFrame, near: DataFrame, many: DataFrame, cells: DataFrame) -> DataFrame:
    """Join spots (`spot`, `x`, `cell`) of thin cells with the spots of all cells in reach
    (`other`, `x2`, ...), splitting cells that hold many spots over several tasks."""
    parts = cells.select(F.col("cell").alias("other"), F.ceil(F.col("spots") / SALT_ROWS).cast("int").alias("_parts"))
    meet = few.join(near, "cell").join(parts, "other")
    meet = meet.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    spread = many.join(parts.withColumnRenamed("other", "cell"), "cell")
    spread = spread.withColumn("_salt", F.pmod(F.xxhash64("spot"), F.col("_parts")).cast("int")).drop("_parts")
    spread = spread.withColumnRenamed("cell", "other").withColumnRenamed("x", "x2").withColumnRenamed("spot", "spot2")
    return meet.join(spread, ["other", "_salt"])


def _core_spots(spots: DataFrame, cells: DataFrame, near: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """Spots with at least `min_samples` points within eps, themselves included."""
    full = spots.filter(F.col("held") >= min_samples).select("spot")
    thin = spots.filter(F.col("held") < min_samples).select("cell", "spot", "x", "held")
    met = _salted_meet(thin, near, spots.select("cell", "spot", "x", "n"), cells)
    close = met.filter(_distance2(F.col("x"), F.col("x2")) <= eps * eps)
    beyond = close.groupBy("spot").agg(F.sum("n").alias("more"))
    counted = thin.select("spot", "held").join(beyond, "spot", "left")
    more = F.coalesce("more", F.lit(0))
    return full.unionByName(counted.filter(F.col("held") + more >= min_samples).select("spot"))


def _reached(border: DataFrame, core_spots: DataFrame, cells: DataFrame, near: DataFrame, eps: float) -> DataFrame:
    """(spot, other): cells in which a non-core spot has a core neighbour."""
    met = _salted_meet(border.select("cell", "spot", "x"), near, core_spots, cells)
    return met.filter(_distance2(F.col("x"), F.col("x2")) <= eps * eps).select("spot", "other").distinct()


def _linked_cells(core_spots: DataFrame, heads: DataFrame, near: DataFrame, side: float, eps: float, dims: int) -> DataFrame:
    """(a, b) by head: pairs of cells with core spots within eps of each other.

    A pair of boxes is settled when it is certainly near, certainly far or small
    enough to compare; otherwise both are cut into smaller boxes.
    """
    own = heads.select("cell", F.col("head").alias("a"))
    far = heads.select(F.col("cell").alias("other"), F.col("head").alias("b"))
    pairs = near.filter(F.col("cell") < F.col("other")).join(own, "cell").join(far, "other")
    pending = durable(pairs.select("a", "b", F.col("cell").alias("na"), F.col("other").alias("nb")))
    found = None
    for level in range(MAX_LEVELS):
        scale = side / 2**level
        placed = core_spots.withColumn("node", F.transform("x", lambda v: F.floor(v / scale)))
        used = pending.select(F.explode(F.array("na", "nb")).alias("node")).distinct()
        placed = placed.join(used, "node").select("node", "x")
        boxes = _as_box(placed.groupBy("node").agg(F.count(F.lit(1)).alias("size"), *_corners(dims)), dims, "node", "size")
        left = boxes.select(F.col("node").alias("na"), F.col("lo").alias("lo1"), F.col("hi").alias("hi1"), F.col("size").alias("s1"))
        right = boxes.select(F.col("node").alias("nb"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.col("size").alias("s2"))
        gap2 = _gap2(F.col("lo1"), F.col("hi1"), F.col("lo2"), F.col("hi2"))
        span2 = _span2(F.col("lo1"), F.col("hi1"), F.col("lo2"), F.col("hi2"))
        # nearest and farthest point of two boxes are as exact as a point pair's distance
        # only if both are single points; leave a little room otherwise
        sure = span2 <= eps * eps * (1 - 1e-12)
        seen = pending.join(left, "na").join(right, "nb").filter(gap2 <= eps * eps * (1 + 1e-12))
        seen = durable(seen.select("a", "b", "na", "nb", "s1", "s2", sure.alias("sure")))
        certain = seen.filter("sure").select("a", "b").distinct()
        doubt = seen.join(certain, ["a", "b"], "left_anti")
        few = F.col("s1") * F.col("s2") <= DIRECT_PAIRS
        here = placed.select(F.col("node").alias("na"), F.col("x").alias("x1"))
        there = placed.select(F.col("node").alias("nb"), F.col("x").alias("x2"))
        compared = doubt.filter(few).join(here, "na").join(there, "nb")
        close = compared.filter(_distance2(F.col("x1"), F.col("x2")) <= eps * eps).select("a", "b").distinct()
        part = durable(certain.unionByName(close))
        found = part if found is None else found.unionByName(part)
        wide = doubt.filter(~few).join(part, ["a", "b"], "left_anti").select("a", "b", "na", "nb")
        wide = durable(wide)
        if wide.isEmpty():
            return found.distinct()
        children = placed.select("node", F.transform("x", lambda v: F.floor(v / (scale / 2))).alias("child")).distinct()
        grown = wide.join(children.select(F.col("node").alias("na"), F.col("child").alias("ca")), "na")
        grown = grown.join(children.select(F.col("node").alias("nb"), F.col("child").alias("cb")), "nb")
        pending = durable(grown.select("a", "b", F.col("ca").alias("na"), F.col("cb").alias("nb")))
    raise RuntimeError("cells could not be separated; is eps positive?")


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, label): each node with the smallest id it is connected to.

    Every round takes the smallest label of the neighbours and then the label of
    that label, so long chains shrink by jumps; each round is written out.
    """
    both = durable(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = durable(nodes.select("id", F.col("id").alias("label")))
    for _ in range(MAX_LEVELS):
        offered = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("best"))
        lowered = labels.join(offered, "id", "left").select("id", "label", F.least("label", "best").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("label").alias("lower"))
        stepped = durable(lowered.join(jump, "low").select("id", "label", F.col("lower").alias("new")))
        changed = stepped.filter(F.col("new") != F.col("label")).limit(1).count()
        labels = stepped.select("id", F.col("new").alias("label"))
        if not changed:
            return labels
    raise RuntimeError("components did not settle")
