"""Exact order statistics without gathering a column in one place."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casefile.functions.values import present_number

# Values of an interval from which a rank is picked in one task.
EXACT_ROWS = 10_000
# Bytes of all sketches of a pass together, and the sizes one sketch may have.
SKETCH_BYTES, LEAST_SKETCH, MOST_SKETCH = 8 << 20, 64, 4096


@dataclass
class _Search:
    """An order statistic being looked for in the open interval (low, high)."""

    column: str
    rank: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0  # values at or under `low`
    inside: int = 0  # values strictly between
    found: float | None = None


class Summary(NamedTuple):
    """Of one column: its median, and mean and population deviation once missing values are filled with it."""

    median: float | None
    filled_mean: float | None
    filled_deviation: float | None


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], exact_rows: int = EXACT_ROWS
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of the present values of each column.

    All columns share their passes over the table. One pass makes a mergeable sketch of every
    column; it proposes two pivots around each wanted rank, and exact counts say on which side of
    them the rank lies. That is repeated inside the interval until at most `exact_rows` values are
    left, which are counted by value and ranked; no task holds more than that.
    """
    return _quantiles(df, columns, probs, exact_rows, [])[0]


def number_summaries(df: DataFrame, columns: Sequence[str], exact_rows: int = EXACT_ROWS) -> dict[str, Summary]:
    """Medians, means and deviations; they share the first pass."""
    values = {c: present_number(df, c) for c in columns}
    stats = [f(values[c]).alias(f"{t}{i}") for i, c in enumerate(columns) for t, f in (("m", F.avg), ("d", F.stddev_pop), ("n", F.count))]
    found, row = _quantiles(df, columns, [0.5], exact_rows, [F.count(F.lit(1)).alias("rows"), *stats])
    out = {}
    for i, c in enumerate(columns):
        (median,), n, rows = found[c], row[f"n{i}"], row["rows"]
        if not n:
            out[c] = Summary(None, None, None)
            continue
        mean = (n * row[f"m{i}"] + (rows - n) * median) / rows
        square = (n * (row[f"d{i}"] ** 2 + (row[f"m{i}"] - mean) ** 2) + (rows - n) * (median - mean) ** 2) / rows
        out[c] = Summary(median, mean, math.sqrt(square))
    return out


def _quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], exact_rows: int, more: list[Column]) -> tuple[dict, dict]:
    if not columns:
        return {}, {}
    values = {c: present_number(df, c) for c in columns}
    k = _sketch_size(len(columns))
    stats = [F.count(v).alias(f"_n{i}") for i, v in enumerate(values.values())]
    stats += [F.kll_sketch_agg_double(v, F.lit(k)).alias(f"_k{i}") for i, v in enumerate(values.values())]
    row = df.agg(*stats, *more).first()
    sizes = {c: row[f"_n{i}"] for i, c in enumerate(columns)}
    ranks = {c: [(sizes[c] - 1) * p for p in probs] for c in columns if sizes[c]}
    searches = [_Search(c, r, inside=sizes[c]) for c, rs in ranks.items() for r in sorted({f(x) for x in rs for f in (math.floor, math.ceil)})]
    sketches = {c: row[f"_k{i}"] for i, c in enumerate(columns)}
    _search(df, values, searches, exact_rows, [sketches[s.column] for s in searches], k)
    got = {(s.column, s.rank): s.found for s in searches}
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    for c, xs in ranks.items():
        out[c] = [got[c, math.floor(x)] + (got[c, math.ceil(x)] - got[c, math.floor(x)]) * (x - math.floor(x)) for x in xs]
    return out, row.asDict()


def _sketch_size(count: int) -> int:
    return max(LEAST_SKETCH, min(MOST_SKETCH, SKETCH_BYTES // (24 * count)))


def _search(df: DataFrame, values: dict, searches: list[_Search], bound: int, sketches: list, k: int) -> None:
    known = {id(s): b for s, b in zip(searches, sketches)}
    while open_ := [s for s in searches if s.found is None]:
        close = [s for s in open_ if s.inside <= bound]
        wide = [s for s in open_ if s.inside > bound]
        if close:
            _finish(df, values, close)
        if wide:
            if not known:
                k = _sketch_size(len(wide))
                row = df.agg(*[F.kll_sketch_agg_double(_inside(values, s), F.lit(k)).alias(str(i)) for i, s in enumerate(wide)]).first()
                known = {id(s): row[str(i)] for i, s in enumerate(wide)}
            _narrow(df, values, wide, [known[id(s)] for s in wide], k)
        known = {}


def _inside(values: dict, s: _Search) -> Column:
    v = values[s.column]
    keep = v.isNotNull()
    if s.low > -math.inf:
        keep = keep & (v > s.low)
    if s.high < math.inf:
        keep = keep & (v < s.high)
    return F.when(keep, v)


def _finish(df: DataFrame, values: dict, searches: list[_Search]) -> None:
    """Pick each rank out of the few values left inside its interval, counted by value."""
    rows = F.array_compact(F.array(*[F.when(x.isNotNull(), F.struct(F.lit(i).alias("at"), x.alias("v"))) for i, x in enumerate(_inside(values, s) for s in searches)]))
    counts = df.select(F.inline(rows)).groupBy("at", "v").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.get(F.array(*[F.lit(s.rank - s.below) for s in searches]), F.col("at"))
    upto = F.sum("n").over(Window.partitionBy("at").orderBy("v"))
    found = counts.select("at", "v", "n", upto.alias("upto")).filter((F.col("upto") > wanted) & (F.col("upto") - F.col("n") <= wanted))
    for r in found.collect():  # one row for each search
        searches[r["at"]].found = r["v"]


def _narrow(df: DataFrame, values: dict, searches: list[_Search], sketches: list, k: int) -> None:
    """Shrink every interval around its rank: its sketch proposes two pivots, exact
    counts decide on which side of them, or on which of them, the rank lies."""
    # some three times the usual rank error of a sketch of this size
    margin = 8 / k**0.94
    proposals = []
    for i, (s, sketch) in enumerate(zip(searches, sketches)):
        at = (s.rank - s.below + 0.5) / s.inside
        band = F.array(F.lit(max(0.0, at - margin)), F.lit(min(1.0, at + margin)))
        proposals.append(F.kll_sketch_get_quantile_double(F.lit(bytes(sketch)), band).alias(str(i)))
    pivots = df.sparkSession.range(1).select(*proposals).first()
    counts = []
    for i, s in enumerate(searches):
        v = values[s.column]
        for j, p in enumerate(sorted(set(pivots[str(i)]))):
            counts += [F.count_if(v < p).alias(f"u{i}_{j}"), F.count_if(v <= p).alias(f"t{i}_{j}")]
    row = df.agg(*counts).first()
    for i, s in enumerate(searches):
        top = s.below + s.inside
        for j, p in enumerate(sorted(set(pivots[str(i)]))):
            under, through = row[f"u{i}_{j}"], row[f"t{i}_{j}"]
            if s.rank < under:
                s.high, top = min(s.high, p), min(top, under)
            elif s.rank < through:
                s.found = p
            else:
                s.low, s.below = max(s.low, p), max(s.below, through)
        s.inside = top - s.below
