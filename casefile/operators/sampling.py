"""Reproducible samples, splits and folds.

Each draw takes the first rows in md5 order of `seed:key`, so the result does not
depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casefile.functions.values import col, linspace
from casefile.operators.ranking import mark_quota, order_hash, rank_by_hash, take_quota
from casefile.session import broadcast_if_small, durable


def _counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*[col(c) for c in columns]).agg(F.count(F.lit(1)).alias("count"))


def simple_sample(df: DataFrame, n: int, key=None, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows without replacement."""
    quota = df.sparkSession.range(1).select(F.lit(n).cast("long").alias("quota"))
    return take_quota(df, [], quota, key, seed)


def approximate_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """About a fraction of the rows in one pass, where the exact size is of no matter."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_for_task(df: DataFrame, target: str, n: int, key=None, seed: int = 42) -> DataFrame:
    """The same fraction min(1, n / rows) of every target group, at least one row
    each; rows without target are left out. A missing target gives a plain sample."""
    if target not in df.columns:
        return simple_sample(df, n, key, seed)
    total = max(df.count(), 1)
    fraction = min(1.0, n / total)
    clean = df.na.drop(subset=[target])
    quotas = _counts(clean, target).withColumn("quota", F.greatest(F.lit(1), F.floor(F.col("count") * F.lit(fraction))))
    return take_quota(clean, [target], quotas, key, seed)


def sample_by_target(df: DataFrame, target: str, n: int = 5000, key=None, seed: int = 42) -> DataFrame:
    """Each class in proportion, at least one row each; everything if it fits."""
    if target not in df.columns:
        raise KeyError(f"target '{target}' not found")
    clean = df.na.drop(subset=[target])
    counts = durable(_counts(clean, target))
    total = counts.agg(F.sum("count")).first()[0] or 0
    if total <= n:
        return clean
    quotas = counts.withColumn("quota", F.greatest(F.lit(1), F.floor(F.col("count") / F.lit(float(total)) * n)))
    return take_quota(clean, [target], quotas, key, seed)


def sample_dual(
    df: DataFrame, target: str, stratum: str, n: int = 5000, equalize: bool = False, key=None, seed: int = 42
) -> DataFrame:
    """By stratum first, proportional or equal, then by target inside the stratum."""
    clean = df.na.drop(subset=[target, stratum])
    cells = durable(_counts(clean, stratum, target))
    strata = cells.groupBy(col(stratum)).agg(F.sum("count").alias("_stratum"))
    total, n_strata = strata.agg(F.coalesce(F.sum("_stratum"), F.lit(0)), F.count(F.lit(1))).first()
    if total <= n:
        return clean
    if equalize:
        share = F.lit(max(1, n // n_strata))
    else:
        share = F.greatest(F.lit(1), F.floor(F.col("_stratum") / F.lit(float(total)) * n))
    inner = F.greatest(F.lit(1), F.floor(F.col("count") / F.col("_stratum") * share))
    quota = F.when(F.col("_stratum") <= share, F.col("count")).otherwise(F.least(F.col("count"), inner))
    quotas = cells.join(strata, stratum).withColumn("quota", quota)
    return take_quota(clean, [stratum, target], quotas, key, seed)


def prepare_sample(df: DataFrame, target: str, config, key=None) -> DataFrame:
    """The sample the training settings ask for; the table itself if they ask for none."""
    if not (config.sample_first and config.sample_n):
        return df
    if config.stratify_by and config.stratify_by in df.columns:
        return sample_dual(df, target, config.stratify_by, config.sample_n, config.equalize_strata, key, config.seed)
    return sample_by_target(df, target, config.sample_n, key, config.seed)


def shuffled(df: DataFrame, key=None, seed: int = 42) -> DataFrame:
    """All rows in hash order, for writers that care about order."""
    return df.orderBy(order_hash(df, key, seed))


def mark_test_rows(
    df: DataFrame, label: str, test_size: float, key=None, seed: int = 42, name: str = "is_test"
) -> DataFrame:
    """Flag round(test_size x rows) rows of every class as test rows."""
    clean = df.na.drop(subset=[label])
    quotas = _counts(clean, label).withColumn("quota", F.round(F.col("count") * F.lit(test_size)).cast("long"))
    return mark_quota(clean, [label], quotas, key, seed, name)


def split_train_test(df: DataFrame, label: str, test_size: float, key=None, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    marked = mark_test_rows(df, label, test_size, key, seed, "_test")
    return marked.filter("not _test").drop("_test"), marked.filter("_test").drop("_test")


def assign_folds(df: DataFrame, label: str, k: int = 5, key=None, seed: int = 42, name: str = "fold") -> DataFrame:
    """Stratified folds 0..k-1: rows in (class, hash) order are dealt out in turn, so
    fold sizes and class counts differ by at most one."""
    clean = df.na.drop(subset=[label])
    ranked = rank_by_hash(clean, [label], key, seed, "_rank")
    # one row per class
    earlier = Window.orderBy(col(label)).rowsBetween(Window.unboundedPreceding, -1)
    starts = _counts(clean, label).select(col(label), F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start"))
    starts, _ = broadcast_if_small(starts)
    dealt = F.pmod(F.col("_start") + F.col("_rank") - 1, F.lit(k)).cast("int")
    return ranked.join(starts, label).withColumn(name, dealt).select(*[col(c) for c in df.columns], name)




def rolling_splits(
    series: DataFrame, keys: Sequence[str], horizon: int = 30, eval_days: int = 90, splits: int = 3
) -> DataFrame:
    """Rolling-origin split points per series: (keys..., split, start, n_splits).

    Train is positions [0, start), test [start, start + horizon). Points without a
    training day before them or a full horizon after them are left out.
    """
    eval_days = max(eval_days, horizon + 7)
    groups = [col(k) for k in keys]
    lengths = series.groupBy(*groups).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    points = linspace(F.col("_n") - eval_days, F.col("_n") - horizon, splits)
    points = F.array_sort(F.array_distinct(F.transform(points, lambda p: F.floor(p).cast("int"))))
    out = lengths.withColumn("_points", points).withColumn("n_splits", F.size("_points"))
    out = out.select(*groups, "_n", "n_splits", F.posexplode("_points").alias("_at", "start"))
    usable = (F.col("start") > 0) & (F.col("start") + horizon <= F.col("_n"))
    return out.filter(usable).select(*groups, (F.col("_at") + 1).alias("split"), "start", "n_splits")
