"""Many two-class logistic regressions over parts of the same rows, fitted side by side.

Folds, sizes of a learning curve and strengths of the penalty differ in which rows count and how they are
scaled, not in the rows themselves. All rows are packed once, in blocks of one cell (a fold, or a fold and a size);
imputing, scaling and one-hot coding as fitted on a part are linear in the packed columns, so each part has a small
matrix for them, made from sums by cell. One scan makes a Newton step of all fits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.functions.values import col, present_number
from casefile.operators.dictionaries import dictionary_of, dictionary_sizes
from casefile.operators.quantiles import quantiles

# Packed columns up to which second derivatives are summed; wider tables are fitted one by one.
MOST_WIDTH = 64
SCORED = ("roc_auc", "accuracy", "f1_macro")
# Rows packed at a time, and rows that a scan works on at a time.
BLOCK_ROWS, STRIP_ROWS = 65_536, 4096
# Scores wanted in a range that one task ranks, and ranges at most.
RANGE_ROWS, MOST_RANGES = 100_000, 512
# Tasks whose sums the driver adds up by itself; those of more are added up by this many tasks first.
DRIVER_PARTS = 32
MOST_STEPS, LEAST_GAIN = 100, 1e-13


@dataclass
class Layout:
    """Which packed column holds what: 1, numbers (0 if missing), marks of missing numbers, then for each
    category column a mark for each value and, if any is missing, one for that."""

    centre: np.ndarray
    scale: np.ndarray
    holes: list[int]
    values: list[list[str]]
    gaps: list[int]

    @property
    def width(self) -> int:
        return 1 + len(self.centre) + len(self.holes) + sum(map(len, self.values)) + len(self.gaps)

    def hole(self, number: int) -> int:
        return 1 + len(self.centre) + self.holes.index(number)

    def marks(self, category: int) -> int:
        """The first packed column of a category column; the mark of missing values comes behind its values."""
        before = sum(map(len, self.values[:category])) + sum(g < category for g in self.gaps)
        return 1 + len(self.centre) + len(self.holes) + before

    def expand(self, numbers: np.ndarray, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(numbers), self.width))
        lost = np.isnan(numbers)
        out[:, 0] = 1.0
        out[:, 1 : 1 + len(self.centre)] = np.where(lost, 0.0, numbers)
        for i in self.holes:
            out[:, self.hole(i)] = lost[:, i]
        for i, values in enumerate(self.values):
            at = self.marks(i)
            out[:, at : at + len(values)] = codes[:, i, None] == np.arange(len(values))
            if i in self.gaps:
                out[:, at + len(values)] = codes[:, i] < 0
        return out


@dataclass
class Fit:
    """One regression: the cells it is fitted on, its inverse penalty, and in the end its weights on the packed columns."""

    cells: np.ndarray
    C: float
    weights: np.ndarray | None = None


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    small = np.exp(-np.abs(margin))
    return np.where(margin >= 0, 1.0, small) / (1.0 + small)


class SharedRows:
    """Packed rows with label and weight, cut into cells."""

    def __init__(self, df: DataFrame, layout: Layout, numeric: Sequence[str], categorical: Sequence[str], cell: Column, cells: int):
        self.layout, self.cells = layout, cells
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.rows = df.withColumn("_cell", cell.cast("int"))
        self.blocks = self._packed().persist(StorageLevel.MEMORY_AND_DISK)
        width = layout.width

        def squares(total, cell, y, w, x):
            total[: cells * width * width].reshape(cells, width, width)[cell] += x.T @ x
            total[cells * width * width :].reshape(cells, 2)[cell] += w[y == 0].sum(), w[y == 1].sum()

        total = self._sums(cells * width * width + cells * 2, squares)
        self.gram = total[: cells * width * width].reshape(cells, width, width)
        self.weight = total[cells * width * width :].reshape(cells, 2)

    def __enter__(self) -> SharedRows:
        return self

    def __exit__(self, *_) -> None:
        self.blocks.unpersist()

    def _packed(self) -> DataFrame:
        layout, n = self.layout, len(self.numeric)
        sets = [pa.array(v, pa.string()) for v in layout.values]

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, rows = [], 0
            for batch in batches:
                held.append(batch)
                rows += batch.num_rows
                if rows >= BLOCK_ROWS:
                    yield packed(pa.Table.from_batches(held))
                    held, rows = [], 0
            if rows:
                yield packed(pa.Table.from_batches(held))

        def packed(table: pa.Table) -> pa.RecordBatch:
            plain = [c.to_numpy() for c in table.columns[: 3 + n]]
            cell, label, weight = plain[:3]
            numbers = np.empty((len(cell), n))
            for i, x in enumerate(plain[3:]):
                numbers[:, i] = (x - layout.centre[i]) / layout.scale[i]
            codes = np.empty((len(cell), len(sets)), np.int16)
            for i, known in enumerate(sets):
                codes[:, i] = pc.fill_null(pc.index_in(table.column(3 + n + i), value_set=known), -1).to_numpy()
            order = np.argsort(cell, kind="stable")
            names, starts = np.unique(cell[order], return_index=True)
            # the sign of a weight is the class
            signed = np.copysign(weight, np.where(label == 1, 1.0, -1.0))
            parts = [order[a:b] for a, b in zip(starts, [*starts[1:], len(order)], strict=True)]
            blobs = [[v[p].tobytes() for p in parts] for v in (signed, numbers, codes)]
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), *[pa.array(b, pa.binary()) for b in blobs]], names=["cell", "signed", "numbers", "codes"]
            )

        wanted = [F.col("_cell"), F.col("label").cast("double").alias("label"), F.col("weight").cast("double").alias("weight")]
        wanted += [present_number(self.rows, c).alias(f"n{i}") for i, c in enumerate(self.numeric)]
        wanted += [col(c).cast("string").alias(f"c{i}") for i, c in enumerate(self.categorical)]
        return self.rows.select(*wanted).mapInArrow(pack, "cell int, signed binary, numbers binary, codes binary")

    def _reader(self) -> Callable:
        layout, n, c = self.layout, len(self.numeric), len(self.categorical)

        def strips(batch: pa.RecordBatch) -> Iterator[tuple]:
            """Cell, classes, weights and packed columns of a strip of rows of one cell."""
            for cell, signed, numbers, codes in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                signed = np.frombuffer(signed)
                numbers = np.frombuffer(numbers).reshape(len(signed), n)
                codes = np.frombuffer(codes, np.int16).reshape(len(signed), c)
                for at in range(0, len(signed), STRIP_ROWS):
                    part = slice(at, at + STRIP_ROWS)
                    yield cell, (~np.signbit(signed[part])).astype(float), np.abs(signed[part]), layout.expand(numbers[part], codes[part])

        return strips

    def _sums(self, size: int, work: Callable) -> np.ndarray:
        """One scan; `work(total, cell, classes, weights, columns)` adds a strip to `total`."""
        strips = self._reader()

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                for strip in strips(batch):
                    work(total, *strip)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for data in (d for batch in batches for d in batch.column(0)):
                total += np.frombuffer(data.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        found = self.blocks.mapInArrow(task, "sums binary")
        if self.blocks.rdd.getNumPartitions() > DRIVER_PARTS:
            found = found.repartition(DRIVER_PARTS).mapInArrow(added, "sums binary")
        # one row for each task
        return sum((np.frombuffer(r["sums"]) for r in found.collect()), np.zeros(size))

    def _medians(self, parts: Sequence[tuple], parallelism: int) -> dict[tuple, list[float | None]]:
        """Exact medians of the columns in which a number is missing, for every part."""
        names = [self.numeric[i] for i in self.layout.holes]
        if not names:
            return {p: [] for p in parts}

        def one(part: tuple) -> list[float | None]:
            found = quantiles(self.rows.filter(F.col("_cell").isin([int(c) for c in np.flatnonzero(part)])), names, [0.5])
            return [found[c][0] for c in names]

        with ThreadPool(min(parallelism, len(parts))) as pool:
            return dict(zip(parts, pool.map(inheritable_thread_target(self.rows.sparkSession)(one), parts), strict=True))

    def _coding(self, cells: np.ndarray, medians: Sequence[float | None]) -> np.ndarray:
        """Features and intercept (rows) of a part as combinations of the packed columns, as `Preprocessor` fits them."""
        layout, gram = self.layout, self.gram[cells].sum(axis=0)
        sums, n, rows = gram[0], gram[0, 0], []
        for i in range(len(layout.centre)):
            row, median = np.zeros(layout.width), None
            lost = sums[layout.hole(i)] if i in layout.holes else 0.0
            if n > lost:
                if i in layout.holes:
                    median = (medians[layout.holes.index(i)] - layout.centre[i]) / layout.scale[i]
                filled = median or 0.0
                mean, square = (sums[1 + i] + filled * lost) / n, (gram[1 + i, 1 + i] + filled**2 * lost) / n
                variance = square - mean**2
                deviation = np.sqrt(variance) if variance > 1e-13 * square else 1.0 / layout.scale[i]
                row[0], row[1 + i] = -mean / deviation, 1.0 / deviation
                if i in layout.holes:
                    row[layout.hole(i)] = filled / deviation
            rows.append(row)
        for i, values in enumerate(layout.values):
            at = layout.marks(i)
            counts = sums[at : at + len(values)]
            # the most frequent value, the smallest text on ties; values are in sorted order
            mode = int(np.argmax(counts)) if len(values) else 0
            for k in range(len(values)):
                row = np.zeros(layout.width)
                if counts[k]:
                    row[at + k] = 1.0
                    if k == mode and i in layout.gaps:
                        row[at + len(values)] = 1.0
                rows.append(row)
        return np.vstack([*rows, np.eye(1, layout.width)])

    def fit(self, fits: Sequence[Fit], parallelism: int = 4) -> None:
        """Minimise the mean weighted logistic loss and the L2 penalty of every fit by Newton steps, the intercept free.

        A scan works out loss, slope and curvature of all fits that are not done; a step that
        does not lower its loss is halved.
        """
        medians = self._medians(list(dict.fromkeys(tuple(f.cells) for f in fits)), parallelism)
        codings = {p: self._coding(np.array(p), m) for p, m in medians.items()}
        upper = np.triu_indices(self.layout.width)
        open_, state = [], {}
        for j, f in enumerate(fits):
            code = codings[tuple(f.cells)]
            negative, positive = self.weight[f.cells].sum(axis=0)
            start = np.zeros(len(code))
            if not (negative and positive):
                # one class alone: its probability is 1
                start[-1] = 800.0 if positive else -800.0
                f.weights = code.T @ start
                continue
            start[-1] = np.log(positive / negative)
            penalty = np.full(len(code), 1.0 / (f.C * (negative + positive)))
            penalty[-1] = 0.0
            state[j] = {"code": code, "total": negative + positive, "penalty": penalty, "at": start, "value": np.inf, "step": None, "share": 1.0}
            open_.append(j)
        for _ in range(MOST_STEPS):
            if not open_:
                break
            found = self._derivatives([fits[j].cells for j in open_], np.column_stack([state[j]["code"].T @ self._trial(state[j]) for j in open_]), upper)
            for j, (loss, slope, curve) in zip(open_, found, strict=True):
                self._advance(fits[j], state[j], loss, slope, curve)
            open_ = [j for j in open_ if fits[j].weights is None]
        for j in open_:
            fits[j].weights = state[j]["code"].T @ state[j]["at"]

    @staticmethod
    def _trial(s: dict) -> np.ndarray:
        return s["at"] if s["step"] is None else s["at"] - s["share"] * s["step"]

    def _advance(self, fit: Fit, s: dict, loss: float, slope: np.ndarray, curve: np.ndarray) -> None:
        at = self._trial(s)
        value = loss / s["total"] + s["penalty"] @ at**2 / 2
        if value > s["value"] + LEAST_GAIN:
            s["share"] /= 2
            if s["share"] < 1e-9:
                fit.weights = s["code"].T @ s["at"]
            return
        slope = s["code"] @ slope / s["total"] + s["penalty"] * at
        curve = s["code"] @ curve @ s["code"].T / s["total"] + np.diag(s["penalty"])
        step = np.linalg.lstsq(curve, slope, rcond=None)[0]
        s.update(at=at, value=value, step=step, share=1.0)
        if slope @ step / 2 <= LEAST_GAIN:
            fit.weights = s["code"].T @ (at - step)

    def _derivatives(self, masks: list[np.ndarray], weights: np.ndarray, upper: tuple) -> list[tuple]:
        width, fits = self.layout.width, len(masks)
        size = 1 + width + len(upper[0])
        by_cell = [np.flatnonzero([m[c] for m in masks]) for c in range(self.cells)]
        shared = self.rows.sparkSession.sparkContext.broadcast((weights, by_cell))

        def work(total, cell, y, w, x):
            weights, by_cell = shared.value
            mine = by_cell[cell]
            if not len(mine):
                return
            out = total.reshape(fits, size)
            margin = x @ weights[:, mine]
            small = np.exp(-np.abs(margin))
            p = np.where(margin >= 0, 1.0, small) / (1.0 + small)
            loss = np.log1p(small) + np.maximum(margin, 0.0) - y[:, None] * margin
            products = x[:, upper[0]] * x[:, upper[1]]
            pull = w[:, None] * (p - y[:, None])
            out[mine] += np.hstack([(w @ loss)[:, None], pull.T @ x, (w[:, None] * p * (1.0 - p)).T @ products])

        total = self._sums(fits * size, work).reshape(fits, size)
        shared.destroy()
        found = []
        for row in total:
            curve = np.zeros((width, width))
            curve[upper] = row[1 + width :]
            found.append((row[0], row[1 : 1 + width], curve + np.triu(curve, 1).T))
        return found

    def scores(self, judged: Sequence[tuple[Fit, np.ndarray]], scoring: str) -> list[float]:
        """The score of each fit on the rows of the cells given with it."""
        if scoring == "roc_auc":
            return self._ranked(judged)
        confusion = self._confusion(judged)
        if scoring == "accuracy":
            return [float((c[0, 0] + c[1, 1]) / c.sum()) if c.sum() else float("nan") for c in confusion]
        out = []
        for c in confusion:
            seen = [k for k in (0, 1) if c[k].sum() or c[:, k].sum()]
            out.append(float(np.mean([2 * c[k, k] / (c[k].sum() + c[:, k].sum()) for k in seen])) if seen else float("nan"))
        return out

    def _judges(self, judged: Sequence[tuple[Fit, np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
        weights = np.column_stack([f.weights for f, _ in judged])
        return weights, [np.flatnonzero([cells[c] for _, cells in judged]) for c in range(self.cells)]

    def _confusion(self, judged: Sequence[tuple[Fit, np.ndarray]]) -> np.ndarray:
        """Rows by class and predicted class."""
        weights, by_cell = self._judges(judged)
        count = len(judged)

        def work(total, cell, y, w, x):
            mine = by_cell[cell]
            if len(mine):
                taken = x @ weights[:, mine] > 0
                hits, all_ = (taken * y[:, None]).sum(axis=0), taken.sum(axis=0)
                positive = y.sum()
                total.reshape(count, 4)[mine] += np.column_stack([len(y) - positive - (all_ - hits), all_ - hits, positive - hits, hits])

        return self._sums(4 * count, work).reshape(count, 2, 2)

    def _ranked(self, judged: Sequence[tuple[Fit, np.ndarray]]) -> list[float]:
        """Exact areas under the ROC curve, ties counted half.

        Scores are counted by value in each block and dealt out by ranges, whose bounds are taken from mean and
        spread of the margins; a task ranks one range, and what lies below it is one number.
        """
        weights, by_cell = self._judges(judged)
        bounds = []
        for f, cells in judged:
            gram = self.gram[cells].sum(axis=0)
            n = max(gram[0, 0], 1.0)
            mean = gram[0] @ f.weights / n
            spread = np.sqrt(max(f.weights @ gram @ f.weights / n - mean**2, 0.0))
            ranges = int(min(MOST_RANGES, max(1, -(-n // RANGE_ROWS))))
            bounds.append(_sigmoid(mean + spread * np.array([NormalDist().inv_cdf(i / ranges) for i in range(1, ranges)])))
        strips = self._reader()

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held: dict[int, list] = {}
                for cell, y, _, x in strips(batch):
                    p = _sigmoid(x @ weights[:, by_cell[cell]])
                    for k, j in enumerate(by_cell[cell]):
                        held.setdefault(int(j), []).append((p[:, k], y))
                out = []
                for j, pieces in held.items():
                    score, y = (np.concatenate(v) for v in zip(*pieces, strict=True))
                    values, place = np.unique(score, return_inverse=True)
                    positive = np.bincount(place, y, len(values)).astype(np.int32)
                    negative = np.bincount(place, 1.0 - y, len(values)).astype(np.int32)
                    cuts = [0, *np.searchsorted(values, bounds[j]), len(values)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        if b > a:
                            out.append((j, k, values[a:b].tobytes(), positive[a:b].tobytes(), negative[a:b].tobytes()))
                if out:
                    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["fit", "part", "score", "pos", "neg"])

        def won(rows: pd.DataFrame) -> pd.DataFrame:
            values, place = np.unique(np.frombuffer(b"".join(rows["score"])), return_inverse=True)
            pos = np.bincount(place, np.frombuffer(b"".join(rows["pos"]), np.int32), len(values))
            neg = np.bincount(place, np.frombuffer(b"".join(rows["neg"]), np.int32), len(values))
            below = np.cumsum(neg) - neg / 2
            return pd.DataFrame({"fit": rows["fit"].iloc[:1], "part": rows["part"].iloc[:1], "pos": pos.sum(), "neg": neg.sum(), "won": pos @ below})

        chunks = self.blocks.mapInArrow(counted, "fit int, part int, score binary, pos binary, neg binary")
        # one row for each range
        ranges = chunks.groupBy("fit", "part").applyInPandas(won, "fit int, part int, pos double, neg double, won double").collect()
        totals = np.zeros((len(judged), 3))
        for r in sorted(ranges, key=lambda r: (r["fit"], r["part"])):
            below = totals[r["fit"], 1]
            totals[r["fit"]] += r["pos"], r["neg"], r["won"] + r["pos"] * below
        # without one of the classes the curve is an edge of the square
        return [float(w / (p * n)) if p and n else 1.0 if p else 0.0 if n else 0.5 for p, n, w in totals]


def shared_rows(df: DataFrame, preprocessor, spec, cell: Column, cells: int, scoring: str) -> SharedRows | None:
    """The rows packed for fits side by side; None for other models, scores and wide tables, which are fitted one by one."""
    if spec.name != "logreg" or spec.n_classes != 2 or scoring not in SCORED:
        return None
    numeric, categorical = preprocessor.getOrDefault("numericCols"), preprocessor.getOrDefault("categoricalCols")
    known = dictionary_of(df, categorical) if categorical else None
    values: list[list[str]] = [[] for _ in categorical]
    if categorical:
        if 1 + len(numeric) + sum(dictionary_sizes(known).values()) > MOST_WIDTH:
            return None
        for r in known.orderBy("column", "slot").collect():
            values[categorical.index(r["column"])].append(r["value"])
    stats = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(numeric):
        x = present_number(df, c)
        stats += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"d{i}")]
    stats += [F.count(col(c)).alias(f"c{i}") for i, c in enumerate(categorical)]
    row = df.agg(*stats).first()
    layout = Layout(
        np.array([row[f"m{i}"] or 0.0 for i in range(len(numeric))]), np.array([row[f"d{i}"] or 1.0 for i in range(len(numeric))]),
        [i for i in range(len(numeric)) if row[f"n{i}"] < row["n"]], values, [i for i in range(len(categorical)) if row[f"c{i}"] < row["n"]],
    )
    # infinite numbers have no mean
    if layout.width > MOST_WIDTH or not (np.isfinite(layout.centre).all() and np.isfinite(layout.scale).all()):
        return None
    return SharedRows(df, layout, numeric, categorical, cell, cells)
