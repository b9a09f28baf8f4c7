"""Stretches of a text that repeat with a period, found with grammars instead of suffix arrays.

Recompression writes a sequence of word ids as a grammar: in turn, blocks of one symbol and pairs of
a left and a right symbol become one symbol each, level by level, until no symbol occurs twice.
Equal stretches are compressed alike but for their ends, so how far two positions agree is found by
climbing the levels, with one comparison at most on each, and coming down again.

A run of period q and at least 4 q words holds four neighbouring multiples of q, all with the
same word. Those quadruples of the grid are the candidates; the grammar says how far each reaches.
The grammar is made for many texts at once, a symbol of its own between any two of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH, LEAST_REPEATS = 6, 4
# Up to this many words the grid of a text is cut from a table; above it, it is made period by period.
TABLE_WORDS = 1 << 14
# Words that share a grammar, and candidates followed at once.
GROUP_WORDS, GROUP_CANDIDATES = 1 << 19, 1 << 18


@dataclass
class Level:
    """`up[x]`: the symbol of the level above that holds x; `low[u]` and `high[u]`: the first and last place in symbol u above."""

    ids: np.ndarray
    up: np.ndarray
    low: np.ndarray
    high: np.ndarray
    blocks: bool


def _named(keys: np.ndarray) -> tuple[np.ndarray, int]:
    found, names = np.unique(keys, return_inverse=True)
    return names, len(found)


def grammar(ids: np.ndarray) -> list[Level]:
    """Levels from the sequence itself up to one where all symbols differ."""
    levels = []
    ids, symbols = _named(ids)
    blocks = True
    while symbols < len(ids):
        n = len(ids)
        if blocks:
            begins = np.concatenate([[True], ids[1:] != ids[:-1]])
        else:
            # one bit for each symbol, another choice on every level
            bits = (np.arange(symbols, dtype=np.uint64) + np.uint64(len(levels) << 32)) * np.uint64(0x9E3779B97F4A7C15)
            bits = (bits ^ (bits >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            left = ((bits >> np.uint64(40)) & np.uint64(1)).astype(bool)[ids]
            begins = np.concatenate([[True], ~(left[:-1] & ~left[1:])])
        low = np.flatnonzero(begins)
        high = np.concatenate([low[1:], [n]]) - 1
        levels.append(Level(ids, np.cumsum(begins) - 1, low, high, blocks))
        second = high - low if blocks else np.where(high > low, ids[high] + 1, 0)
        ids, symbols = _named(ids[low] * (n + 1) + second)
        blocks = not blocks
    levels.append(Level(ids, ids[:0], ids[:0], ids[:0], blocks))
    return levels


def agreement(levels: list[Level], x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from x and y on, to the right (step 1) or left (-1).

    The places must differ and the sequence must end in a symbol of its own in that direction.
    """
    start = x
    x, y, n = x.copy(), y.copy(), len(x)
    stopped = np.full(n, len(levels) - 1)
    going = np.arange(n)
    for h, level in enumerate(levels[:-1]):
        a, b = x[going], y[going]
        up_a, up_b = level.up[a], level.up[b]
        near = level.low if step > 0 else level.high
        far = level.high if step > 0 else level.low
        inside = (near[up_a] != a) | (near[up_b] != b)  # within a block or pair: one comparison
        differ = inside & (level.ids[a] != level.ids[b])
        rest_a, rest_b = np.abs(far[up_a] - a) + 1, np.abs(far[up_b] - b) + 1
        if level.blocks:
            move = np.minimum(rest_a, rest_b)
            stop = differ | (inside & (rest_a != rest_b))
        else:
            move, stop = np.ones_like(a), differ
        moved = np.where(inside & ~differ, step * move, 0)
        a, b = a + moved, b + moved
        x[going], y[going] = a, b
        stopped[going[stop]] = h
        going, a, b = going[~stop], a[~stop], b[~stop]
        x[going], y[going] = level.up[a], level.up[b]
    for h in range(len(levels) - 2, -1, -1):
        level, down = levels[h], np.flatnonzero(stopped > h)
        near = level.low if step > 0 else level.high
        far = level.high if step > 0 else level.low
        u, v = x[down], y[down]
        a, b = near[u], near[v]
        same = level.ids[a] == level.ids[b]
        shared = np.minimum(np.abs(far[u] - a), np.abs(far[v] - b)) + 1 if level.blocks else 1
        moved = np.where(same, step * shared, 0)
        x[down], y[down] = a + moved, b + moved
    return np.abs(x - start)


def grid_table(words: int = TABLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, period, last) of all quadruples on the grids of all periods within so many words, by their last place."""
    periods = np.arange(1, max(2, (words - 1) // 3 + 1))
    each = np.maximum(0, (words - 1) // periods - 2)
    period = np.repeat(periods, each)
    start = (np.arange(len(period)) - np.repeat(np.cumsum(each) - each, each)) * period
    order = np.argsort(start + 3 * period, kind="stable")
    start, period = start[order], period[order]
    return start, period, start + 3 * period


def candidates(ids: np.ndarray, grid: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period): quadruples of equal words on the grid of a text; a bounded number at a time."""
    n = len(ids)
    if n <= TABLE_WORDS:
        few = np.searchsorted(grid[2], n)
        start, period = grid[0][:few], grid[1][:few]
        equal = np.flatnonzero(ids[start] == ids[start + period])
        for times in (2, 3):
            equal = equal[ids[start[equal]] == ids[start[equal] + times * period[equal]]]
        if len(equal):
            yield start[equal], period[equal]
        return
    held, size = [], 0
    for q in range(1, (n - 1) // 3 + 1):
        row = ids[::q]
        same = row[1:] == row[:-1]
        at = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        if len(at):
            held.append((at * q, np.full(len(at), q)))
            size += len(at)
        if size >= GROUP_CANDIDATES:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _distinct(runs: np.ndarray) -> np.ndarray:
    """Rows (start, end, period): of equal stretches the one with the smallest period, in order."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    return runs[np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1)])] if len(runs) else runs


Group = list[tuple[int, Iterator[tuple[np.ndarray, np.ndarray]]]]


def _gathered(group: Group, offsets: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place in the joint sequence, period, number in the group) of the candidates of a group, a bounded number at a time."""
    held, size = [], 0
    for k, (_, parts) in enumerate(group):
        for place, period in parts:
            held.append((place + offsets[k], period, np.full(len(place), k)))
            size += len(place)
            if size >= GROUP_CANDIDATES:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _settled(texts: list[np.ndarray], group: Group, found: list[np.ndarray]) -> None:
    """Make one grammar for the texts of a group and follow their candidates."""
    top = max(int(texts[t].max()) for t, _ in group) + 2
    ids, offsets, at = [np.array([0])], [], 1
    for k, (t, _) in enumerate(group):
        offsets.append(at)
        ids += [texts[t] + 1, np.array([top + k])]
        at += len(texts[t]) + 1
    levels = grammar(np.concatenate(ids))
    for i, p, k in _gathered(group, offsets):
        ahead = agreement(levels, i, i + p, 1)
        behind = agreement(levels, i - 1, i + p - 1, -1)
        long = ahead + behind + p >= np.maximum(LEAST_LENGTH, LEAST_REPEATS * p)
        rows = np.stack([i - behind, i + p + ahead, p], axis=1)[long]
        owners, begins = np.unique(k[long], return_index=True)  # candidates come text by text
        for one, mine in zip(owners.tolist(), np.split(rows, begins[1:]), strict=True) if len(owners) else ():
            t = group[one][0]
            found[t] = _distinct(np.concatenate([found[t], mine - np.array([offsets[one], offsets[one], 0])]))


def runs_of(texts: list[np.ndarray], grid: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """For each text of word ids an array of (start, length, period), by start and period.

    Ids need only be equal for equal words of one text. Texts without candidates are in no grammar;
    those too long for the table have one of their own.
    """
    found: list[np.ndarray] = [np.zeros((0, 3), np.int64)] * len(texts)
    group: Group = []
    words = 0
    for t, ids in enumerate(texts):
        parts = candidates(ids, grid) if len(ids) >= LEAST_LENGTH else iter(())
        some = next(parts, None)
        if some is None:
            continue
        if len(ids) > TABLE_WORDS:
            _settled(texts, [(t, chain([some], parts))], found)
            continue
        group.append((t, iter([some])))
        words += len(ids) + len(some[0])
        if words >= GROUP_WORDS:
            _settled(texts, group, found)
            group, words = [], 0
    if group:
        _settled(texts, group, found)
    out = []
    for rows in found:
        rows = np.stack([rows[:, 0], rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)
        out.append(rows[np.lexsort((rows[:, 2], rows[:, 0]))])
    return out


def word_ids(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words are in no run behind its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def _summary(words: list[bytes], runs: np.ndarray) -> tuple:
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
    kept = words if not len(runs) else [words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist()]
    best = (None, None, None, None)
    if len(runs):
        s, n, q = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
        best = (s, n, q, 1000 * n // q)
    text = b" ".join(kept)
    return len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest(), runs.ravel().tolist(), text


SCHEMA = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def periodic_runs(docs: DataFrame, period: Column | None = None, offset: Column | None = None, texts: bool = False) -> DataFrame:
    """One row for each row of `docs`: its periodic runs, the longest of them, and a digest of the text without repetitions.

    A run is a longest stretch with smallest period q of at least 6 and 4 q words; all but the first q
    words of every run are left out of the collapsed text, whose words are joined by one space. With
    `period` and `offset` (columns, null for none) the words from `offset` on are first replaced
    by repetitions of the `period` words that begin there. `texts` adds `runs` (start, length and
    period of each in a row) and `collapsed`. Null, empty and blank texts have no words and no run;
    repeated rows and null ids are kept, other columns ignored, whole texts are read; no rows give none.
    """
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_runs", pa.int64()), *[(c, pa.int64()) for c in ("start", "length", "period", "exponent_milli")]]
    fields += [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), *([("runs", pa.list_(pa.int64())), ("collapsed", pa.binary())] if texts else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, grid = pa.schema(fields), grid_table()
        for batch in batches:
            ids, data, a, p = (batch.column(c).to_pylist() for c in range(4))
            words = [text.split() for text in data]
            for t, (first, size) in enumerate(zip(a, p, strict=True)):
                if first is not None and size is not None and first < len(words[t]):
                    w = words[t]
                    again = -(-(len(w) - first) // size)
                    words[t] = w[:first] + (w[first : first + size] * again)[: len(w) - first]
            runs = runs_of([word_ids(w) for w in words], grid)
            rows = [(i, len(w), *_summary(w, r)) for i, w, r in zip(ids, words, runs, strict=True)]
            columns = list(zip(*rows, strict=True)) or [()] * (len(kinds) + 2)
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=False)], schema=kinds)

    none = F.lit(None).cast("long")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string").cast("binary"), F.lit(b"")).alias("text"), (none if offset is None else offset.cast("long")).alias("offset"), (none if period is None else period.cast("long")).alias("period"))
    found = rows.mapInArrow(run, SCHEMA + (", runs array<long>, collapsed binary" if texts else ""))
    return found.withColumn("collapsed", F.col("collapsed").cast("string")) if texts else found
