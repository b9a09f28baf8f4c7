"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut into halves, each half has a codebook of its own, and the two nearest code words
name a vector's cell in the product grid. A search visits cells by growing sum of the two distances.
How many cells that takes is measured: for a bounded number of vectors all partners among all rows
are searched without the index, and the number of cells is the smallest that reaches the wanted
share of them. Every vector is then compared with its own cell and those it visits, in
double precision. Of two cells only one visits the other, so that a pair is met once.

Equal vectors are one vector with a count. Cells of any size are compared block by block, and what
leaves a comparison is a sum and the head of its group for each vector, never a list of pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.llm.common import forget, written
from casefile.llm.simhash import components
from casefile.session import durable

# Vectors that the codebooks are fitted on, vectors searched without index to choose the number of cells, and the share of partners to reach.
FIT_ROWS, QUERY_ROWS, TARGET_RECALL = 20_000, 2_000, 0.995
# Vectors wanted in a cell, and code words a half at most; beyond 16 million times CELL vectors cells grow.
CELL, MOST_WORDS = 64, 4096
# Vectors compared at once; larger cells are cut into blocks of this size.
BLOCK = 2048
STEPS = 15


@dataclass
class MultiIndex:
    """`words[h]`: code words of half h, one a row; vectors are cut or filled up with zeros to `width` for the grid."""

    words: tuple[np.ndarray, np.ndarray]
    width: int

    def distances(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances from both halves to all code words, less the square of the half."""
        half = self.width // 2
        return tuple((w * w).sum(axis=1) - 2 * part @ w.T for w, part in zip(self.words, (units[:, :half], units[:, half:]), strict=True))

    def home(self, near: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        return near[0].argmin(axis=1) * len(self.words[1]) + near[1].argmin(axis=1)

    def visited(self, near: tuple[np.ndarray, np.ndarray], cells: int) -> np.ndarray:
        """The first `cells` cells by the sum of distances, a row for each vector.

        With the words of both halves in order, the cell of the a-th and b-th has a b cells before it at least,
        so only those with a b up to `cells` are looked at.
        """
        orders = [np.argsort(d, axis=1, kind="stable")[:, :cells] for d in near]
        a, b = (g.ravel() for g in np.indices((orders[0].shape[1], orders[1].shape[1])))
        some = (a + 1) * (b + 1) <= cells
        a, b = a[some], b[some]
        sums = np.take_along_axis(near[0], orders[0], 1)[:, a] + np.take_along_axis(near[1], orders[1], 1)[:, b]
        first = np.argsort(sums, axis=1, kind="stable")[:, :cells]
        return np.take_along_axis(orders[0], a[first], 1) * len(self.words[1]) + np.take_along_axis(orders[1], b[first], 1)

    def rank(self, near: tuple[np.ndarray, np.ndarray], cells: np.ndarray) -> np.ndarray:
        """How many cells come before the given one, for each vector; cells that are as near but for rounding do not."""
        i, j = np.divmod(cells, len(self.words[1]))
        rows = np.arange(len(cells))
        at = near[0][rows, i] + near[1][rows, j]
        return np.array([np.searchsorted(np.sort(d1), s - 1e-12 - d0, side="left").sum() for d0, d1, s in zip(near[0], near[1], at, strict=True)], np.int64)


def _floats(kind: str) -> str:
    return "<f4" if kind == "array<float>" else "<f8"


def _vectors(parts: list[bytes], kind: str) -> list[np.ndarray]:
    return [np.frombuffer(p, kind).astype(np.float64) for p in parts]


def unit(vector: np.ndarray) -> np.ndarray:
    """Scaled by its largest component first, so that no square overflows or vanishes."""
    vector = vector / np.abs(vector).max()
    return vector / np.sqrt(vector @ vector)


def units_of(parts: list[bytes], kind: str, width: int) -> np.ndarray:
    """Unit vectors of `width`, cut or filled up with zeros."""
    out = np.zeros((len(parts), width))
    for row, vector in zip(out, _vectors(parts, kind), strict=True):
        vector = unit(vector)[:width]
        row[: len(vector)] = vector
    return out


def keyed(embeddings: DataFrame, kind: str) -> DataFrame:
    """(vec_id, key, vec): the vector's bytes and their digest; both null where it is null, zero or has null or non-finite components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, vecs = [], []
            for row in batch.column(1):
                vector = None
                if row.is_valid and row.values.null_count == 0:
                    vector = row.values.to_numpy(zero_copy_only=False) + 0.0  # no negative zero
                good = vector is not None and len(vector) > 0 and np.isfinite(vector).all() and np.abs(vector).max() > 0
                data = vector.astype(kind).tobytes() if good else None
                vecs.append(data)
                keys.append(hashlib.blake2b(data, digest_size=16).digest() if good else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())], names=["vec_id", "key", "vec"])

    number = "float" if kind == "<f4" else "double"
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), embeddings["embedding"].cast(f"array<{number}>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, key binary, vec binary")


def _near_means(points: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """Means of `count` groups after a fixed number of Lloyd steps; groups that run empty keep their mean."""
    means = points[rng.choice(len(points), count, replace=False)].copy()
    for _ in range(STEPS):
        owner = ((means * means).sum(axis=1) - 2 * points @ means.T).argmin(axis=1)
        sums = np.stack([np.bincount(owner, weights=column, minlength=count) for column in points.T], axis=1) if points.shape[1] else means
        held = np.bincount(owner, minlength=count)
        means[held > 0] = (sums / np.maximum(held, 1)[:, None])[held > 0]
    return means


def _sample(vectors: DataFrame, total: int, rows: int, mark: str) -> list[bytes]:
    """At most `rows` vectors, chosen by their hash."""
    few = vectors.filter(F.pmod(F.xxhash64("key", F.lit(mark)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 0.95 * rows / total)) + 1)
    return [bytes(v) for v in few.orderBy("key").limit(rows).select("vec").toArrow().column("vec").to_pylist()]


def fit_index(vectors: DataFrame, total: int, kind: str, fit_rows: int = FIT_ROWS, cell: int = CELL) -> MultiIndex:
    """Codebooks from at most `fit_rows` vectors; as many words as give cells of `cell` vectors each."""
    width = vectors.groupBy(F.length("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()["n"] // np.dtype(kind).itemsize
    points = units_of(_sample(vectors, total, fit_rows, "fit"), kind, width)
    count = max(1, min(MOST_WORDS, int(np.ceil(np.sqrt(total / cell))), len(points)))
    rng, half = np.random.default_rng(7), width // 2
    return MultiIndex((_near_means(points[:, :half], count, rng), _near_means(points[:, half:], count, rng)), width)


def found_by_rank(vectors: DataFrame, index: MultiIndex, queries: list[bytes], kind: str, least: float) -> DataFrame:
    """(query, rank, n): partners of each query among all rows, found without the index, by the rank of their cell in the query's search."""
    spark = vectors.sparkSession
    wanted = [unit(v) for v in _vectors(queries, kind)]
    lengths = np.array([len(w) for w in wanted])
    shared = spark.sparkContext.broadcast((index.words, index.width, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, width, queries = shared.value
        index = MultiIndex(words, width)
        near_q = index.distances(units_of(queries, kind, index.width))
        groups = {n: (np.flatnonzero(lengths == n), np.stack([w for w in wanted if len(w) == n])) for n in set(lengths.tolist())}
        for batch in batches:
            parts = batch.column(0).to_pylist()
            for at in range(0, len(parts), BLOCK):
                some = parts[at : at + BLOCK]
                rows = [unit(v) for v in _vectors(some, kind)]
                home = index.home(index.distances(units_of(some, kind, index.width)))
                for n, (which, asked) in groups.items():
                    mine = [i for i, r in enumerate(rows) if len(r) == n]
                    if not mine:
                        continue
                    q, r = np.nonzero(asked @ np.stack([rows[i] for i in mine]).T >= least)
                    q, r = which[q], np.array(mine)[r]
                    other = np.array([queries[a] != some[b] for a, b in zip(q.tolist(), r.tolist(), strict=True)], bool)
                    q, cells = q[other], home[r[other]]
                    pairs, counts = np.unique(np.stack([q, cells]), axis=1, return_counts=True)
                    ranks = index.rank(tuple(d[pairs[0]] for d in near_q), pairs[1]) if len(counts) else counts
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[0].astype(np.int64)), pa.array(ranks.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["query", "rank", "n"])

    found = vectors.select("vec").mapInArrow(run, "query long, rank long, n long")
    return found.groupBy("query", "rank").agg(F.sum("n").alias("n"))


def cells_needed(found: DataFrame, recall: float) -> int:
    """The smallest number of cells in which a query finds the wanted share of its partners on average; 1 if nobody has partners."""
    share = found.join(found.groupBy("query").agg(F.sum("n").alias("all")), "query")
    by_rank = share.groupBy("rank").agg(F.sum(F.col("n") / F.col("all")).alias("s")).orderBy("rank").collect()  # as many rows as cells at most
    total, seen = sum(r["s"] for r in by_rank), 0.0
    for r in by_rank:
        seen += r["s"]
        if seen >= recall * total * (1 - 1e-12):
            return int(r["rank"]) + 1
    return 1


def _placed(vectors: DataFrame, index: MultiIndex, cells: int, kind: str) -> DataFrame:
    """(cell, guest, key, n, vec): every vector in its own cell and, as a guest, in the cells before it that its search visits."""
    shared = vectors.sparkSession.sparkContext.broadcast((index.words, index.width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = MultiIndex(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                near = index.distances(units_of(part.column(2).to_pylist(), kind, index.width))
                home = index.home(near)
                seen = index.visited(near, cells)
                guest, place = np.nonzero(seen < home[:, None])
                rows = pa.array(np.concatenate([np.arange(len(home)), guest]))
                columns = [pa.array(np.concatenate([home, seen[guest, place]])), pa.array(np.arange(len(rows)) >= len(home)), *(c.take(rows) for c in part.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "guest", "key", "n", "vec"])

    return vectors.select("key", "n", "vec").mapInArrow(run, "cell long, guest boolean, key binary, n long, vec binary")


def _blocks(placed: DataFrame) -> DataFrame:
    """`placed` dealt to comparisons (cell, own, other): block `own` of the cell's vectors with block `other` of them, or of the guests (-1 - its number)."""
    held = placed.groupBy("cell").agg(F.count_if(~F.col("guest")).alias("m"), F.count_if("guest").alias("g"))
    held = held.select("cell", *[F.ceil(F.col(c) / BLOCK).cast("int").alias(c) for c in ("m", "g")])
    rows = placed.join(held, "cell").withColumn("mine", F.pmod(F.xxhash64("key"), F.greatest(F.when(F.col("guest"), F.col("g")).otherwise(F.col("m")), F.lit(1))).cast("int"))
    blocks = F.when(F.col("m") > 0, F.sequence(F.lit(0), F.greatest(F.col("m") - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    guests = F.when(F.col("g") > 0, F.sequence(F.lit(1), F.greatest(F.col("g"), F.lit(1)))).otherwise(F.array().cast("array<int>"))
    with_guests = F.transform(guests, lambda e: F.struct(F.col("mine").alias("own"), (-e).alias("other")))
    with_own = F.transform(blocks, lambda c: F.struct(F.least("mine", c).alias("own"), F.greatest("mine", c).alias("other")))
    as_guest = F.transform(blocks, lambda c: F.struct(c.alias("own"), (-1 - F.col("mine")).alias("other")))
    met = F.explode(F.when(F.col("guest"), as_guest).otherwise(F.concat(with_own, with_guests)))
    return rows.select("cell", "guest", "mine", "key", "n", "vec", met.alias("met")).select("cell", "met.own", "met.other", "guest", "mine", "key", "n", "vec")


def _heads(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """The smallest number in the group of each of `count` nodes joined by edges (a, b)."""
    head = np.arange(count)
    while True:
        low = np.minimum(head[a], head[b])
        new = head.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, head[a], low)
        np.minimum.at(new, head[b], low)
        new = new[new]
        if (new == head).all():
            return head
        head = new


def _compared(blocks: DataFrame, kind: str, least: float) -> DataFrame:
    """(key, links, head): for every vector with a partner in a comparison, how many vectors it links to there and the first of its group."""
    names = ["key", "links", "head"]

    def run(table: pa.Table) -> pa.Table:
        own, other = table.column("own")[0].as_py(), table.column("other")[0].as_py()
        guest, mine = (table.column(c).to_numpy() for c in ("guest", "mine"))
        left = np.flatnonzero(~guest & (mine == own))
        right = left if other == own else np.flatnonzero(guest if other < 0 else ~guest & (mine == other))
        keys, n, vecs = table.column("key").to_pylist(), table.column("n").to_numpy(), table.column("vec").to_pylist()
        units = [unit(v) for v in _vectors(vecs, kind)]
        length = np.array([len(u) for u in units])
        links, edges = np.zeros(len(keys), np.int64), []
        for width in np.intersect1d(length[left], length[right]).tolist():
            a, b = left[length[left] == width], right[length[right] == width]
            one, two = np.stack([units[i] for i in a]), np.stack([units[i] for i in b])
            for at in range(0, len(b), BLOCK):  # guests of one block may be more than a block
                x, y = np.nonzero(one @ two[at : at + BLOCK].T >= least)
                x, y = a[x], b[y + at]
                if other == own:
                    x, y = x[x < y], y[x < y]
                links += np.bincount(x, weights=n[y], minlength=len(keys)).astype(np.int64) + np.bincount(y, weights=n[x], minlength=len(keys)).astype(np.int64)
                head = _heads(x, y, len(keys))
                edges.append((np.flatnonzero(head != np.arange(len(keys))), head[head != np.arange(len(keys))]))
        some = np.flatnonzero(links)
        if not len(some):
            return pa.table([pa.array([], pa.binary()), pa.array([], pa.int64()), pa.array([], pa.binary())], names=names)
        head = _heads(np.concatenate([e[0] for e in edges]), np.concatenate([e[1] for e in edges]), len(keys))
        return pa.table([pa.array([keys[i] for i in some], pa.binary()), pa.array(links[some]), pa.array([keys[head[i]] for i in some], pa.binary())], names=names)

    return blocks.groupBy("cell", "own", "other").applyInArrow(run, "key binary, links long, head binary")


def linked_vectors(embeddings: DataFrame, least: float = 0.9, recall: float = TARGET_RECALL, fit_rows: int = FIT_ROWS, query_rows: int = QUERY_ROWS, cell: int = CELL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `embeddings` (vec_id, embedding).

    Two rows are linked if the cosine of their vectors is `least` or more; `component_id` is the smallest id
    reachable, `kept` whether it is the row's own. No pair below `least` is linked; of those above it the
    index finds about `recall` or more, measured on at most `query_rows` vectors (with as many rows as that or
    fewer, on all of them). Vectors that are null, zero, empty or hold null or non-finite components link
    with nothing; neither do vectors of different lengths. Repeated rows link with each other; null ids give no
    label (the component is null if nobody has an id). Other columns are ignored, no rows give none.
    """
    spark = embeddings.sparkSession
    kind = _floats(dict(embeddings.dtypes)["embedding"])
    rows = keyed(embeddings, kind)
    distinct = rows.filter("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"), F.first("vec").alias("vec"))
    vectors, path = written(distinct)
    total = vectors.count()
    if total:
        index = fit_index(vectors, total, kind, fit_rows, cell)
        found = durable(found_by_rank(vectors, index, _sample(vectors, total, query_rows, "query"), kind, least))
        placed, place = written(_placed(vectors, index, cells_needed(found, recall), kind))
        met = durable(_compared(_blocks(placed), kind, least))
        forget(spark, place)
        links = durable(met.groupBy("key").agg(F.sum("links").alias("links")))
        groups = components(met.filter("key <> head").select(F.col("head").alias("a"), F.col("key").alias("b")).distinct())
        named = vectors.select("key", "n", "least").join(links, "key", "left").join(groups.withColumnRenamed("fp", "key"), "key", "left")
        named = named.withColumn("head", F.coalesce("head", "key"))
        labels = named.groupBy("head").agg(F.min("least").alias("component_id"))
        named = durable(named.join(labels, "head").select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"))
    else:
        named = vectors.select("key", F.lit(0).cast("long").alias("n_links"), F.col("least").alias("component_id"))
    out = rows.select("vec_id", "key").join(named, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"))
    if total:
        forget(spark, path)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
