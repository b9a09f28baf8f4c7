"""Column profiles and associations; each one shares a single pass over the table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casefile.functions.values import as_text, col, long_form, missing, present_number, text_columns
from casefile.operators.quantiles import quantiles
from casefile.operators.schema import low_cardinality, split_by_kind
from casefile.session import broadcast_if_small, durable

HISTOGRAM_BINS = 30
# Values that the sketch of one column follows, and those of all columns together.
TRACKED_VALUES, TRACKED_TOTAL = 10_000, 200_000
# Rows looked at to choose the point from which values are measured.
SHIFT_ROWS = 1_000


def missingness(df: DataFrame) -> DataFrame:
    """(column, fraction) of missing values, highest first."""
    shares = df.agg(*[F.avg(missing(df, c).cast("double")).alias(c) for c in df.columns])
    return shares.unpivot([], [col(c) for c in df.columns], "column", "fraction").orderBy(F.desc("fraction"), "column")


def numeric_histograms(df: DataFrame, columns: Sequence[str] | None = None, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """(column, bin, low, high, count) over equal-width bins from minimum to maximum,
    the last one closed; a constant column gets a range of one around its value."""
    names = list(columns) if columns is not None else split_by_kind(df)[0]
    values = {c: present_number(df, c) for c in names}
    stats = [f(values[c]).alias(f"{t}{i}") for i, c in enumerate(names) for t, f in (("a", F.min), ("b", F.max))]
    row = df.agg(*stats).first() if names else {}
    edges: dict[str, list[float]] = {}
    for i, c in enumerate(names):
        low, high = row[f"a{i}"], row[f"b{i}"]
        if low is None:
            continue
        if low == high:
            low, high = low - 0.5, high + 0.5
        step = (high - low) / bins
        edges[c] = [low + k * step for k in range(bins)] + [high]
    spark = df.sparkSession
    frame = spark.createDataFrame(
        [(c, k, e[k], e[k + 1]) for c, e in edges.items() for k in range(bins)],
        "column string, bin int, low double, high double",
    )
    if not edges:
        return frame.withColumn("count", F.lit(0).cast("long"))

    # a first guess per row, then at most one step to the side where rounding went wrong
    order = list(edges)
    guesses = []
    for i, c in enumerate(order):
        x, e = values[c], edges[c]
        guess = F.least(F.floor((x - e[0]) * (bins / (e[-1] - e[0]))).cast("int"), F.lit(bins - 1))
        # least() passes over a null, which would land in the last bin
        guesses += [x.alias(f"x{i}"), F.when(x.isNotNull(), guess).alias(f"g{i}")]
    rough = df.select(*guesses)

    def bin_of(i: int, c: str) -> F.Column:
        x, g = F.col(f"x{i}"), F.col(f"g{i}")
        bounds = F.array(*[F.lit(v) for v in edges[c]])
        down = (x < F.get(bounds, g)).cast("int")
        up = ((x >= F.get(bounds, g + 1)) & (g < bins - 1)).cast("int")
        return g - down + up

    pairs = F.array(*[F.struct(F.lit(i).alias("at"), bin_of(i, c).alias("bin")) for i, c in enumerate(order)])
    counts = rough.select(F.inline(pairs)).filter(F.col("bin").isNotNull()).groupBy("at", "bin").count()
    names_of = F.array(*[F.lit(c) for c in order])
    counts = counts.select(F.get(names_of, F.col("at")).alias("column"), "bin", "count")
    joined = frame.join(counts, ["column", "bin"], "left")
    return joined.withColumn("count", F.coalesce("count", F.lit(0).cast("long")))


def top_categories(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """(value, count) of the most frequent values, missing counted as text."""
    found = top_categories_of(df, [column], n)
    return found.select("value", "count").orderBy(F.desc("count"), "value")


def top_categories_of(df: DataFrame, columns: Sequence[str], n: int = 20) -> DataFrame:
    """(column, value, count) for several columns; values of equal count by text.

    One pass proposes candidates with mergeable sketches, a second counts these exactly. A column is
    done if its n-th count is above all that a value outside the candidates can have, or if
    the candidates are all its rows; what is shuffled then does not grow with the distinct
    values. The values of other columns are counted in full.
    """
    names = [c for c in columns if c in df.columns]
    schema = "column string, value string, count long"
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    texts = df.select(*[as_text(col(c)).alias(f"t{i}") for i, c in enumerate(names)])
    tracked = max(2 * n, min(TRACKED_VALUES, TRACKED_TOTAL // len(names)))
    wanted = min(tracked, max(4 * n, 100))
    row = texts.agg(F.count(F.lit(1)).alias("rows"), *[F.expr(f"approx_top_k(t{i}, {wanted}, {tracked})").alias(str(i)) for i in range(len(names))]).first()
    listed = [(i, r["item"]) for i in range(len(names)) for r in row[str(i)]]
    candidates, _ = broadcast_if_small(df.sparkSession.createDataFrame(listed, "at int, value string"))
    pairs = F.array(*[F.struct(F.lit(i).alias("at"), F.col(f"t{i}").alias("value")) for i in range(len(names))])
    exact = texts.select(F.inline(pairs)).join(candidates, ["at", "value"], "left_semi").groupBy("at", "value").count()
    counted: dict[int, list[tuple[str, int]]] = {i: [] for i in range(len(names))}
    for r in exact.collect():  # the candidates, at most `wanted` of each column
        counted[r["at"]].append((r["value"], r["count"]))
    done, open_ = [], []
    for i, c in enumerate(names):
        best = sorted(counted[i], key=lambda x: (-x[1], x[0].encode()))[:n]
        # sketches err by 3.5 / slots of all rows at most; what they track but did not list is below the last listed
        slots = 1 << math.ceil(math.log2(tracked / 0.75))
        beyond = max(row["rows"] * 3.5 / slots, row[str(i)][-1]["count"] if len(row[str(i)]) == wanted else 0)
        if sum(k for _, k in counted[i]) == row["rows"] or (len(best) == n and best[-1][1] > beyond):
            done += [(c, v, k) for v, k in best]
        else:
            open_.append(c)
    known = df.sparkSession.createDataFrame(done, schema)
    return known.unionByName(_counted_in_full(df, open_, n)) if open_ else known


def _counted_in_full(df: DataFrame, names: Sequence[str], n: int) -> DataFrame:
    texts = df.select(*[as_text(col(c)).alias(c) for c in names])
    counts = long_form(texts, list(names)).groupBy("column", "value").count()
    # two steps keep the last sort small: each spread-out part is cut to its own top n
    parts = counts.withColumn("_part", F.spark_partition_id())
    order = [F.desc("count"), F.asc("value")]
    local = F.row_number().over(Window.partitionBy("column", "_part").orderBy(*order))
    kept = parts.withColumn("_n", local).filter(F.col("_n") <= n)
    place = F.row_number().over(Window.partitionBy("column").orderBy(*order))
    return kept.withColumn("_n", place).filter(F.col("_n") <= n).select("column", "value", "count")


def pair_sums(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """One matrix of sums for all pairs of columns, from one scan, and the shift of each column.

    A row becomes a vector of its values (missing as 0, less the shift), their squares and 0/1
    marks of presence. Its products with itself, added up over partitions, hold for every pair
    the sums, squares, products and rows in which both are present.
    """
    values = [present_number(df, c) for c in columns]
    # any value near the bulk of a column will do: it only keeps digits from cancelling
    *near, rows = df.limit(SHIFT_ROWS).agg(*[F.avg(v).alias(str(i)) for i, v in enumerate(values)], F.count(F.lit(1)).alias("rows")).first()
    if not rows:
        return np.zeros((3 * len(columns), 3 * len(columns))), np.zeros(len(columns))
    shift = [m if m is not None and math.isfinite(m) else 0.0 for m in near]
    moved = [v - m for v, m in zip(values, shift)]
    parts = [F.coalesce(x, F.lit(0.0)) for x in moved] + [F.coalesce(x * x, F.lit(0.0)) for x in moved] + [x.isNotNull().cast("double") for x in moved]
    vectors = MLUtils.convertVectorColumnsFromML(df.select(array_to_vector(F.array(*parts)).alias("v")), "v")
    return RowMatrix(vectors, 0, 3 * len(columns)).computeGramianMatrix().toArray(), np.array(shift)


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, measure, value): pairwise-complete Pearson correlation, full matrix, from one scan.

    A column that does not vary (but for a 10^-11 part of its mean square) over the common rows has none.
    """
    schema = "a string, b string, measure string, value double"
    if not columns:
        return df.sparkSession.createDataFrame([], schema)
    d = len(columns)
    sums, _ = pair_sums(df, columns)
    value, square, mark = slice(0, d), slice(d, 2 * d), slice(2 * d, 3 * d)
    n, products = sums[mark, mark], sums[value, value]
    with np.errstate(all="ignore"):
        of_a, squares_a = sums[value, mark], sums[square, mark]  # over the rows in which b is present
        spread_a = n * squares_a - of_a**2
        spread_a[spread_a <= 1e-11 * n * squares_a] = 0.0
        r = (n * products - of_a * of_a.T) / np.sqrt(spread_a * spread_a.T)
    rows = [(a, b, "pearson", float(r[i, j]) if math.isfinite(r[i, j]) else None) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, schema)


def mutual_information(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, measure, value): normalised mutual information (arithmetic mean of the
    entropies) of categorical pairs, full matrix. Missing is a category.

    MI = H(a) + H(b) - H(a, b), each entropy from the sum of n ln n over its cells.
    Every row meets every pair once; only cell counts are shuffled, and only one sum
    per pair comes back.
    """
    pairs = list(combinations_with_replacement(columns, 2))
    schema = "a string, b string, measure string, value double"
    if not pairs:
        return df.sparkSession.createDataFrame([], schema)
    texts = df.select(*[as_text(col(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    at = {c: i for i, c in enumerate(columns)}
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("pair"), F.col(f"c{at[a]}").alias("x"), F.col(f"c{at[b]}").alias("y"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    counts = texts.select(F.inline(cells)).groupBy("pair", "x", "y").agg(F.count(F.lit(1)).cast("double").alias("n"))
    sums = counts.groupBy("pair").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.ln("n")).alias("s"), F.count(F.lit(1)).alias("cells"))
    entropy, single = {}, {}
    for r in sums.collect():
        entropy[pairs[r["pair"]]] = math.log(r["n"]) - r["s"] / r["n"]
        single[pairs[r["pair"]]] = r["cells"] == 1
    rows = []
    for a, b in entropy:
        shared = entropy[a, a] + entropy[b, b] - entropy[a, b]
        mean = (entropy[a, a] + entropy[b, b]) / 2
        value = 1.0 if single[a, b] else 0.0 if abs(shared) < 1e-12 else shared / mean
        rows += [(a, b, "nmi", value)] if a == b else [(a, b, "nmi", value), (b, a, "nmi", value)]
    return df.sparkSession.createDataFrame(rows, schema)


def anova_f(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """(a, b, measure, value): one-way ANOVA F of numeric a by category b, missing
    numbers replaced by the median, missing category its own group."""
    if not numeric or not categorical:
        return df.sparkSession.createDataFrame([], "a string, b string, measure string, value double")
    medians = {c: q[0] for c, q in quantiles(df, list(numeric), [0.5]).items()}
    numbers = [F.coalesce(present_number(df, c), F.lit(medians[c])).alias(f"_x{i}") for i, c in enumerate(numeric)]
    groups = F.explode(F.array(*[F.struct(F.lit(c).alias("b"), as_text(col(c)).alias("g")) for c in categorical]))
    rows = df.select(groups.alias("_c"), *numbers).select("_c.*", *[f"_x{i}" for i in range(len(numeric))])
    stats = rows.groupBy("b", "g").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(
            *[
                F.struct(F.lit(c).alias("a"), F.avg(f"_x{i}").alias("m"), F.var_pop(f"_x{i}").alias("v"))
                for i, c in enumerate(numeric)
            ]
        ).alias("s"),
    )
    flat = durable(stats).select("b", "n", F.inline("s"))
    # any one category splits all rows, so its groups give the overall means
    whole = flat.filter(F.col("b") == categorical[0]).groupBy("a").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("m"))
    means = F.create_map(*[F.lit(v) for r in whole.collect() for v in (r["a"], r["m"])])
    parts = flat.groupBy("a", "b").agg(
        F.sum(F.col("n") * F.col("v")).alias("within"),
        F.sum(F.col("n") * (F.col("m") - F.element_at(means, F.col("a"))) ** 2).alias("between"),
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
    )
    f = F.try_divide(F.col("between") / F.nullif(F.col("k") - 1, F.lit(0)), F.col("within") / F.nullif(F.col("n") - F.col("k"), F.lit(0)))
    return parts.select("a", "b", F.lit("anova_f").alias("measure"), f.alias("value"))


def mixed_association(df: DataFrame, max_categories: int = 30) -> DataFrame:
    """Correlations, mutual information and ANOVA F of all numeric columns and of the
    text columns with few values, as one long table."""
    numeric = split_by_kind(df)[0]
    categorical = low_cardinality(df, text_columns(df), max_categories)
    return (
        pearson(df, numeric)
        .unionByName(mutual_information(df, categorical))
        .unionByName(anova_f(df, numeric, categorical))
    )


def hour_day_pivot(df: DataFrame, weekday_col: str = "weekday", hour_col: str = "hour") -> DataFrame:
    """Rows per weekday, one column `h0`…`h23` per hour, 0 where there are none."""
    counts = [F.count_if(col(hour_col) == h).alias(f"h{h}") for h in range(24)]
    return df.filter(col(weekday_col).isNotNull()).groupBy(col(weekday_col).alias("weekday")).agg(*counts)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """(label, count), ordered by label."""
    return df.filter(~missing(df, label)).groupBy(col(label).alias("label")).count().orderBy("label")


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct present values: duplicates are removed by hash partition
    first, so no task sees all of them."""
    values = df.filter(~missing(df, column)).select(col(column)).distinct()
    return values.agg(F.count(F.lit(1)).alias("n_distinct"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, count, weight) with the balanced weight rows / (classes x class rows)."""
    counts = class_distribution(df, label)
    # one row per class
    every = Window.partitionBy()
    weight = F.sum("count").over(every) / (F.count(F.lit(1)).over(every) * F.col("count"))
    return counts.withColumn("weight", weight)


def positive_weight(df: DataFrame, label: str) -> float | None:
    """Negatives per positive of a 0/1 label; None unless both occur."""
    pos, neg = df.agg(F.count_if(col(label) == 1), F.count_if(col(label) == 0)).first()
    return neg / pos if pos and neg else None
