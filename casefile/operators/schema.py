"""Column names and kinds: everything decided from the schema or one aggregate."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefile.functions import dates
from casefile.functions.values import col, is_number, missing
from casefile.session import durable

# Column names looked for, in order of preference.
LAT_NAMES = ("lat", "latitude", "latit", "lat_num")
LON_NAMES = ("lon", "longitude", "long", "lng", "lon_num")
DATE_NAMES = (
    "DATE OCC", "Date OCC", "date_occ", "date_occurred",
    "DATE RPTD", "Date Rptd", "date_rptd",
    "DATE", "Date", "date", "date_only",
)
DATE_PART_NAMES = ("DATE OCC", "Date OCC", "date_occ")
TIME_PART_NAMES = ("TIME OCC", "Time OCC", "time_occ")
PARSED_DATE_NAMES = ("date_dt", "date")
RAW_DATE_NAMES = (
    "DATE OCC", "Date OCC", "date_occ", "Date Occurred", "Date Occured",
    "DATE RPTD", "Date Rptd", "date_rptd",
    "date_only", "Date", "DATE",
)

# Fixed value: the first day of the plausible date range.
FIRST_DAY = "2000-01-01"


def normalized_name(name: str) -> str:
    return re.sub(r"[^0-9a-zA-Z]+", "_", name.strip()).lower()


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim, turn runs of other characters into `_`, lower-case; clashes are an error."""
    names = [normalized_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns share a normalised name: {clashes}")
    return df.toDF(*names)


def first_present(df: DataFrame, names: Iterable[str]) -> str | None:
    """The first of the candidate names that the table has."""
    have = set(df.columns)
    return next((n for n in names if n in have), None)


def coordinate_columns(df: DataFrame) -> tuple[str | None, str | None]:
    return first_present(df, LAT_NAMES), first_present(df, LON_NAMES)


def split_by_kind(df: DataFrame, bool_as_numeric: bool = False) -> tuple[list[str], list[str]]:
    """Names of numeric and of all other columns, in table order."""
    numeric = [f.name for f in df.schema.fields if is_number(f.dataType, bool_as_numeric)]
    return numeric, [c for c in df.columns if c not in set(numeric)]


def constant_columns(df: DataFrame) -> list[str]:
    """Columns with at most one distinct present value, from one aggregate."""
    names = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.UserDefinedType))]
    checks = []
    for i, c in enumerate(names):
        value = F.when(~missing(df, c), col(c))
        checks.append(F.min(value).eqNullSafe(F.max(value)).alias(f"c{i}"))
    row = df.agg(*checks).first()
    return [c for i, c in enumerate(names) if row[f"c{i}"]]


def drop_constant(df: DataFrame) -> DataFrame:
    return df.drop(*constant_columns(df))


def drop_columns(df: DataFrame, names: Iterable[str] | None) -> DataFrame:
    """Drop the named columns that exist."""
    return df.drop(*(names or ()))


def features_and_target(df: DataFrame, target: str) -> list[str]:
    """Every column but the target; a missing target is an error."""
    if target not in df.columns:
        raise KeyError(f"target column '{target}' not found")
    return [c for c in df.columns if c != target]


def low_cardinality(df: DataFrame, columns: Sequence[str], limit: int = 30) -> list[str]:
    """Columns with at most `limit` distinct present values.

    A sketch sorts out the clear cases; only columns near the limit are counted
    exactly, and those hold few distinct values by then.
    """
    if not columns:
        return []
    present = {c: F.when(~missing(df, c), col(c)) for c in columns}
    rough = df.agg(*[F.approx_count_distinct(present[c], 0.02).alias(str(i)) for i, c in enumerate(columns)]).first()
    near = [c for i, c in enumerate(columns) if 0.8 * limit <= rough[str(i)] <= 1.25 * limit]
    sure = {c for i, c in enumerate(columns) if rough[str(i)] < 0.8 * limit}
    if near:
        exact = df.agg(*[F.count_distinct(present[c]).alias(str(i)) for i, c in enumerate(near)]).first()
        sure |= {c for i, c in enumerate(near) if exact[str(i)] <= limit}
    return [c for c in columns if c in sure]


def bool_to_int(df: DataFrame) -> DataFrame:
    return df.select(
        *[col(f.name).cast("int").alias(f.name) if isinstance(f.dataType, T.BooleanType) else col(f.name) for f in df.schema.fields]
    )


def downcast_stats(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[list[str], list[F.Column]]:
    """The columns that may get a narrower type, and the aggregates that tell which."""
    names = list(columns) if columns is not None else split_by_kind(df)[0]
    names = [c for c in names if not isinstance(df.schema[c].dataType, T.DecimalType)]
    stats = []
    for i, c in enumerate(names):
        x, gone = col(c), missing(df, c)
        d = x.cast("double")
        whole = gone | (d == F.floor(d))
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            # a column with gaps cannot be told apart from a double column of whole numbers
            whole = whole & ~F.isnan(F.coalesce(d, F.lit(0.0)))
        stats += [
            F.min(F.when(~gone, x)).alias(f"lo{i}"),
            F.max(F.when(~gone, x)).alias(f"hi{i}"),
            F.bool_and(whole).alias(f"whole{i}"),
            F.bool_and(gone | (x.cast("float").cast("double") == d)).alias(f"narrow{i}"),
        ]
    return names, stats


def downcast_by(df: DataFrame, names: Sequence[str], row: dict) -> DataFrame:
    """Cast to the types that the values of `downcast_stats` allow."""
    widths = (("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31), ("bigint", 2**63))
    target: dict[str, str] = {}
    for i, c in enumerate(names):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is None:
            continue
        if row[f"whole{i}"] and max(abs(lo), abs(hi)) <= 2**53:
            target[c] = next(t for t, top in widths if -top <= lo and hi < top)
        elif isinstance(df.schema[c].dataType, T.DoubleType) and row[f"narrow{i}"]:
            target[c] = "float"
    return df.select(*[col(c).cast(target[c]).alias(c) if c in target else col(c) for c in df.columns])


def downcast_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The narrowest type that keeps every value: whole numbers to the smallest
    integer type, other doubles to float only where nothing is lost."""
    names, stats = downcast_stats(df, columns)
    return downcast_by(df, names, df.agg(*stats).first().asDict()) if names else df


# ---- date columns -----------------------------------------------------------


def _candidate_columns(df: DataFrame) -> tuple[list[str], list[tuple[str, str]]]:
    """Columns to choose from: preferred names, every column only if none is present; and date + time pairs."""
    columns = [c for c in DATE_NAMES if c in df.columns] or [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))
    ]
    return columns, [(d, t) for d in DATE_PART_NAMES for t in TIME_PART_NAMES if d in df.columns and t in df.columns]


def _parsed(df: DataFrame, units: dict[str, str]) -> dict[str, F.Column]:
    columns, pairs = _candidate_columns(df)
    found = {c: dates.parse_date(df, c, units) for c in columns}
    return found | {f"{d}+{t}": dates.combine_date_time(df, d, t, units) for d, t in pairs}


def _numeric_dates(df: DataFrame) -> list[str]:
    """Number columns of which it must be found out whether they hold seconds or milliseconds."""
    columns, pairs = _candidate_columns(df)
    return [c for c in dict.fromkeys([*columns, *(d for d, _ in pairs)]) if is_number(df.schema[c].dataType)]


def date_candidates(df: DataFrame) -> dict[str, F.Column]:
    """Parsed columns to choose from: preferred names, then date + time pairs, and
    every column only if no preferred name is present."""
    return _parsed(df, dates.epoch_units(df, _numeric_dates(df)))


def _scored_readings(df: DataFrame, as_of) -> tuple[DataFrame, dict[str, F.Column]]:
    """(position, candidate, day, n, good) of every candidate, and how it is parsed, from one pass.

    Numbers are counted as seconds and as milliseconds; the counts per day then tell
    which of the two they are.
    """
    numbers = _numeric_dates(df)
    readings: list[tuple[int, str, str, F.Column]] = []
    for unit in ("s", "ms") if numbers else ("s",):
        parsed = _parsed(df, {c: unit for c in numbers})
        readings += [(i, name, unit, ts) for i, (name, ts) in enumerate(parsed.items())]
        readings += [(-1 - i, c, unit, dates.parse_date(df, c, {c: unit})) for i, c in enumerate(numbers) if c not in parsed]
    of_number = lambda name: name in numbers or name.split("+")[0] in numbers
    readings = [r for r in readings if r[2] == "s" or of_number(r[1])]
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("candidate"), F.lit(u).alias("unit"), ts.alias("ts")) for i, n, u, ts in readings])
    low, high = F.lit(FIRST_DAY).cast(dates.NTZ), dates.as_of_column(as_of)
    per_day = durable(
        df.select(F.inline(rows))
        .groupBy("position", "candidate", "unit", F.col("ts").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("ts").between(low, high)).alias("good"))
    )
    units = {c: "s" for c in numbers}
    if numbers:
        counts = per_day.filter(F.col("candidate").isin(numbers)).groupBy("candidate").pivot("unit", ["s", "ms"]).agg(
            F.sum("n").alias("n"), F.sum(F.when(F.col("day").isNotNull(), F.col("n")).otherwise(0)).alias("valid"),
            F.sum(F.when(F.year("day") <= 1971, F.col("n")).otherwise(0)).alias("early"),
        )
        units |= {r["candidate"]: dates.epoch_unit(r["s_n"], r["s_valid"], r["s_early"], r["ms_valid"]) for r in counts.collect()}
    chosen = [(n, u) for _, n, u, _ in readings if u == (units[n] if n in units else units.get(n.split("+")[0], "s"))]
    picked = F.concat_ws("\u0000", "candidate", "unit").isin(["\u0000".join(c) for c in chosen])
    return per_day.filter(picked & (F.col("position") >= 0)).drop("unit"), _parsed(df, units)


def score_date_columns(df: DataFrame, as_of=None) -> DataFrame:
    """Score of every candidate date column, one row each, in one pass.

    score = valid rate x (0.5 + 0.5 x share in the plausible range), less 0.5 when
    one day holds over 80 % of the valid dates.
    """
    return _scores(df, _scored_readings(df, as_of)[0])


def _scores(df: DataFrame, per_day: DataFrame) -> DataFrame:
    valid = F.sum(F.when(F.col("day").isNotNull(), F.col("n")))
    stats = per_day.groupBy("position", "candidate").agg(
        (F.coalesce(valid, F.lit(0)) / F.sum("n")).alias("valid_rate"),
        F.coalesce(F.sum("good") / valid, F.lit(0.0)).alias("good_share"),
        F.coalesce(F.max(F.when(F.col("day").isNotNull(), F.col("n"))) / valid, F.lit(0.0)).alias("top_share"),
    )
    if not any(c in df.columns for c in DATE_NAMES):
        stats = stats.filter(F.col("valid_rate") > 0.5)
    penalty = F.when(F.col("top_share") > 0.8, 0.5).otherwise(0.0)
    score = F.col("valid_rate") * (0.5 + 0.5 * F.col("good_share")) - penalty
    # at most one row per candidate column is left here
    best = F.row_number().over(Window.orderBy(F.desc("score"), "position"))
    return stats.withColumn("score", score).withColumn("chosen", ((best == 1) & (F.col("score") > 0)).cast("int"))


def choose_date_column(df: DataFrame, as_of=None) -> tuple[str, F.Column]:
    """Name and parsed form of the best date column; ties go to the earlier one."""
    if _candidate_columns(df)[0]:
        per_day, parsed = _scored_readings(df, as_of)
        best = _scores(df, per_day).filter("chosen = 1").select("candidate").first()
        if best is not None:
            return best["candidate"], parsed[best["candidate"]]
    raise ValueError("none of the columns can be read as a date")


def add_fixed_date(df: DataFrame, as_of=None, date_col: str | None = None) -> DataFrame:
    """Append `date_fixed` from the given or the best date column."""
    expr = dates.parse_date(df, date_col) if date_col else choose_date_column(df, as_of)[1]
    return df.withColumn("date_fixed", expr)


def infer_datetime_column(df: DataFrame) -> str:
    """First known date name, else the first column of which over 90 % parses."""
    known = first_present(df, PARSED_DATE_NAMES) or first_present(df, RAW_DATE_NAMES)
    if known:
        return known
    candidates = date_candidates(df)
    if candidates:
        rates = df.agg(*[F.avg(e.isNotNull().cast("double")).alias(str(i)) for i, e in enumerate(candidates.values())]).first()
        for i, name in enumerate(candidates):
            if rates[str(i)] is not None and rates[str(i)] > 0.9:
                return name
    raise ValueError("could not locate a datetime column")


def infer_datetime_columns(df: DataFrame) -> tuple[DataFrame, str]:
    return df, infer_datetime_column(df)
