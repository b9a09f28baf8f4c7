"""Quality classifier: gradient-boosted trees on histograms of document statistics.

The statistics of every text are computed where the text is. The trees are fitted on a bounded
sample of labelled rows and flattened into arrays, which a batch of documents walks level by level.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.llm.common import held_out

# Labelled rows used to fit, at most; below that all of them.
FIT_ROWS = 20_000
TREES, DEPTH, BINS, RATE, SHRINK, LEAST_WEIGHT = 80, 4, 64, 0.15, 1.0, 2.0
REJECT_BELOW = 0.7
UPPER, DIGITS, SYMBOLS, STOPS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>@^~=+_{}[]\\", b".,;:?"
PIECE = 1 << 20


def statistics(text: str | None) -> list[float]:
    """Numbers that describe the whole of a text; all are 0 for null or empty ones."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * N_STATISTICS
    n, size = len(words), len(data)

    def share(chars: bytes) -> float:
        return (size - len(data.translate(None, chars))) / size

    lines = [line for line in data.split(b"\n") if line.strip()]
    held = Counter(words)
    squeeze = zlib.compressobj(1)
    packed = sum(len(squeeze.compress(data[at : at + PIECE])) for at in range(0, size, PIECE)) + len(squeeze.flush())
    following = set(zip(words, words[1:]))
    return [
        float(n), size / n, len(held) / n, max(held.values()) / n, sum(map(eq, words, words[1:])) / n,
        (len(following) + 1) / n, share(UPPER), share(DIGITS), share(SYMBOLS), share(b"|"), data.count(b"!") / n,
        share(STOPS), len(lines) / n, 1 - len(set(lines)) / len(lines), max(map(len, words)) / n, float(max(map(len, words))),
        packed / size, share(bytes(range(128, 256))), data.count(b"http") / n,
    ]


N_STATISTICS = 19


@dataclass(frozen=True)
class Trees:
    """Complete trees of equal depth: inner nodes level by level, then the values of the leaves."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        rows, total = np.arange(len(x)), np.full(len(x), self.base)
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -40, 40)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosting on binned features with Newton steps; the order of the rows does not matter."""
    inner, leaves = 2**depth - 1, 2**depth
    if not len(y):  # nothing speaks against any text
        return Trees(40.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    order = np.lexsort((*x.T, y))
    x, y = x[order], y[order].astype(float)
    p = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(p / (1 - p)))
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for column in x.T]
    bins = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T, strict=True)], axis=1)
    n, width = x.shape[1], BINS
    margin = np.full(len(y), base)
    feature, threshold, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    for t in range(trees):
        q = 1 / (1 + np.exp(-margin))
        g, h = y - q, q * (1 - q)
        node, chosen = np.zeros(len(y), np.int64), np.full(inner, width)
        for level in range(depth):
            first = 2**level - 1
            slot = ((node - first)[:, None] * n + np.arange(n)) * width + bins
            shape = (2**level, n, width)
            gs = np.bincount(slot.ravel(), np.repeat(g, n), np.prod(shape)).reshape(shape).cumsum(axis=2)
            hs = np.bincount(slot.ravel(), np.repeat(h, n), np.prod(shape)).reshape(shape).cumsum(axis=2)
            ga, ha = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + SHRINK) + (ga - gs) ** 2 / (ha - hs + SHRINK) - ga**2 / (ha + SHRINK)
            gain = np.where((hs >= LEAST_WEIGHT) & (ha - hs >= LEAST_WEIGHT), gain, 0)
            for k in range(2**level):
                f, b = divmod(int(gain[k].argmax()), width)
                if gain[k, f, b] > 1e-9 and b < len(cuts[f]):
                    feature[t, first + k], threshold[t, first + k], chosen[first + k] = f, cuts[f][b], b
            node = 2 * node + 1 + (bins[np.arange(len(y)), feature[t, node]] > chosen[node])
        place = node - inner
        leaf[t] = RATE * np.bincount(place, g, leaves) / (np.bincount(place, h, leaves) + SHRINK)
        margin += leaf[t][place]
    return Trees(base, feature, threshold, leaf)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> pd.DataFrame:
    """(label, statistics) of at most `rows` labelled rows that are not held out."""
    marked = labels.filter(labels["quality"].isNotNull() & labels["doc_id"].isNotNull() & ~held_out(labels["doc_id"]))
    marked = marked.select(marked["doc_id"].cast("long").alias("doc_id"), marked["quality"].cast("int").alias("label"))
    total = marked.count()
    if total > 0.9 * rows:  # a hash threshold takes about nine tenths of the bound
        marked = marked.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fit")), F.lit(1 << 30)) < int((1 << 30) * 0.9 * rows / total))
    chosen = F.broadcast(marked.limit(rows))  # twelve bytes a row
    joined = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).join(chosen, "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [statistics(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(numbers, pa.list_(pa.float64()))], names=["label", "x"])

    return joined.select("text", "label").mapInArrow(measure, "label int, x array<double>").limit(rows).toPandas()


def learn_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Trees:
    sample = labelled_sample(docs, labels, rows)
    x = np.stack(sample["x"].to_numpy()) if len(sample) else np.zeros((0, N_STATISTICS))
    return fit_trees(x, sample["label"].to_numpy())


def quality_score(model: Trees, text: Column) -> Column:
    """Score of a whole text from 0 to 1; null and empty texts are scored by their statistics, which are all 0."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            x = np.array([statistics(t) for t in batch]).reshape(-1, N_STATISTICS)
            yield pd.Series(model.scores(x))

    return score(text.cast("string"))


def score_documents(docs: DataFrame, model: Trees) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`; `predicted` is 1 from 0.7 on.

    The score depends on the text alone: equal texts have equal scores, null ids are kept, and
    other columns do not count. No rows give no rows; without labelled rows every score is 1.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), quality_score(model, docs["text"]).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= REJECT_BELOW).cast("int"))
