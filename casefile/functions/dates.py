"""Date parsing, HHMM times, calendar features and the holiday calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefile.functions.values import col, is_floating, is_integral

# Text layouts tried in this order after ISO text.
TEXT_LAYOUTS = ("MM/dd/yyyy hh:mm:ss a", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy")

# Fixed value: the largest distance from 1970 (in ns) a nanosecond timestamp can hold.
_NANOSECOND_SPAN = 9_223_372_036_854_775_807
MAX_EPOCH_SECONDS = _NANOSECOND_SPAN // 10**9
MAX_EPOCH_MILLIS = _NANOSECOND_SPAN // 10**6

# The eleven US federal holidays as (name, first year, rule).
# Rules: ("day", month, day) with weekend shift; ("nth", month, weekday, n) with
# Monday = 0; ("last", month, weekday).
FEDERAL_HOLIDAYS = (
    ("New Year's Day", 1871, ("day", 1, 1)),
    ("Martin Luther King Jr. Day", 1986, ("nth", 1, 0, 3)),
    ("Washington's Birthday", 1879, ("nth", 2, 0, 3)),
    ("Memorial Day", 1868, ("last", 5, 0)),
    ("Juneteenth", 2021, ("day", 6, 19)),
    ("Independence Day", 1870, ("day", 7, 4)),
    ("Labor Day", 1894, ("nth", 9, 0, 1)),
    ("Columbus Day", 1937, ("nth", 10, 0, 2)),
    ("Veterans Day", 1938, ("day", 11, 11)),
    ("Thanksgiving Day", 1941, ("nth", 11, 3, 4)),
    ("Christmas Day", 1870, ("day", 12, 25)),
)

NTZ = T.TimestampNTZType()


def now_ntz() -> Column:
    return F.current_timestamp().cast(NTZ)


def as_of_column(as_of) -> Column:
    """The upper end of date windows: a given moment, or the current time."""
    return now_ntz() if as_of is None else F.lit(as_of).cast(NTZ)


def epoch_to_ntz(c: Column, unit: str) -> Column:
    """Epoch seconds (`s`) or milliseconds (`ms`) as a zone-free timestamp; out of range is null."""
    limit, scale = (MAX_EPOCH_SECONDS, 1) if unit == "s" else (MAX_EPOCH_MILLIS, 1000)
    number = c.cast("double")
    inside = number.isNotNull() & ~F.isnan(number) & (F.abs(number) <= limit)
    seconds = F.when(inside, number / scale).cast("decimal(18,6)")
    start = F.lit("1970-01-01 00:00:00").cast(NTZ)
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def text_to_ntz(c: Column) -> Column:
    """ISO text or one of the fixed layouts as a zone-free timestamp; bad text is null."""
    text = F.trim(c)
    parsed = [text.try_cast(NTZ)]
    parsed += [F.try_to_timestamp(text, F.lit(layout)).cast(NTZ) for layout in TEXT_LAYOUTS]
    return F.coalesce(*parsed)


def epoch_units(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Seconds or milliseconds for each numeric column, from one aggregate.

    Seconds, unless they look wrong (under half valid, or over 80 % of the valid
    ones no later than 1971) while milliseconds give strictly more valid values.
    """
    if not columns:
        return {}
    stats = []
    for i, name in enumerate(columns):
        seconds, millis = epoch_to_ntz(col(name), "s"), epoch_to_ntz(col(name), "ms")
        stats += [
            F.count(seconds).alias(f"s{i}"),
            F.count(millis).alias(f"m{i}"),
            F.count_if(F.year(seconds) <= 1971).alias(f"y{i}"),
        ]
    row = df.agg(F.count(F.lit(1)).alias("n"), *stats).first()
    return {name: epoch_unit(row["n"], row[f"s{i}"], row[f"y{i}"], row[f"m{i}"]) for i, name in enumerate(columns)}


def epoch_unit(rows: int, valid: int, early: int, valid_ms: int) -> str:
    """The unit by the rows, those valid as seconds, those of them no later than 1971, and those valid as milliseconds."""
    odd = valid < 0.5 * rows or (valid > 0 and early > 0.8 * valid)
    return "ms" if odd and valid_ms > valid else "s"


def parse_date(df: DataFrame, name: str, units: dict[str, str] | None = None) -> Column:
    """Any column as a zone-free timestamp, by its type.

    `units` (see `epoch_units`) saves the extra aggregate for numeric columns.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return col(name).cast(NTZ)
    if is_integral(dtype) or is_floating(dtype) or isinstance(dtype, T.DecimalType):
        unit = (units or epoch_units(df, [name]))[name]
        return epoch_to_ntz(col(name), unit)
    if isinstance(dtype, T.StringType):
        return text_to_ntz(col(name))
    return F.lit(None).cast(NTZ)


def hhmm_text(df: DataFrame, name: str) -> Column:
    """A time-of-day column as four digits HHMM; a missing time is `0000`."""
    dtype, c = df.schema[name].dataType, col(name)
    if isinstance(dtype, T.StringType):
        digits = F.regexp_replace(F.regexp_replace(F.trim(c), r"\.0$", ""), r"[^0-9]", "")
    else:
        number = F.coalesce(F.nanvl(c.cast("double"), F.lit(None)), F.lit(0.0))
        digits = number.cast("long").cast("string")
    digits = F.coalesce(digits, F.lit(""))
    # lpad would cut longer texts; only the first four characters are read
    return F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(F.substring(digits, 1, 4))


def combine_date_time(
    df: DataFrame, date_col: str, time_col: str, units: dict[str, str] | None = None
) -> Column:
    """A date column plus an HHMM column as one timestamp."""
    text = hhmm_text(df, time_col)

    def part(start: int, top: int) -> Column:
        number = F.coalesce(F.substring(text, start, 2).try_cast("int"), F.lit(0))
        return F.greatest(F.least(number, F.lit(top)), F.lit(0))

    return parse_date(df, date_col, units) + F.make_dt_interval(F.lit(0), part(1, 23), part(3, 59))


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Year, month, weekday (Monday = 0), hour and weekend flag of a timestamp."""
    weekday = F.weekday(ts)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "weekday": weekday,
        "hour": F.hour(ts),
        "is_weekend": (weekday >= 5).cast("int"),
    }


def midnight(ts: Column) -> Column:
    """The day of a timestamp, as a zone-free timestamp at midnight."""
    return ts.cast("date").cast(NTZ)


def holiday_calendar(
    spark: SparkSession, first_year: int, last_year: int, observed: str = "nearest"
) -> DataFrame:
    """Federal holidays of a range of years as (day date, holiday string).

    Holidays on a fixed day that fall on a weekend move to the nearest weekday
    (`nearest`), stay (`actual`), or appear on both days (`both`).
    """
    if observed not in ("nearest", "actual", "both"):
        raise ValueError("observed must be 'nearest', 'actual' or 'both'")
    rules = []
    for name, since, rule in FEDERAL_HOLIDAYS:
        if rule[0] == "day":
            day = F.make_date("year", F.lit(rule[1]), F.lit(rule[2]))
            weekday = F.weekday(day)
            moved = F.when(weekday == 5, F.date_sub(day, 1)).when(weekday == 6, F.date_add(day, 1))
            nearest = F.coalesce(moved, day)
            days = {"actual": F.array(day), "nearest": F.array(nearest), "both": F.array_distinct(F.array(day, nearest))}
            dates = days[observed]
        elif rule[0] == "nth":
            first = F.make_date("year", F.lit(rule[1]), F.lit(1))
            gap = F.pmod(F.lit(rule[2]) - F.weekday(first), F.lit(7))
            dates = F.array(F.date_add(first, gap + 7 * (rule[3] - 1)))
        else:
            last = F.last_day(F.make_date("year", F.lit(rule[1]), F.lit(1)))
            dates = F.array(F.date_sub(last, F.pmod(F.weekday(last) - rule[2], F.lit(7))))
        rules.append(F.when(F.col("year") >= since, F.transform(dates, lambda d, n=name: F.struct(d.alias("day"), F.lit(n).alias("holiday")))))
    # a New Year's Day on a Saturday is observed in the year before, hence the extra year
    years = spark.range(first_year, last_year + 2).select(F.col("id").cast("int").alias("year"))
    empty = F.array().cast("array<struct<day:date,holiday:string>>")
    table = years.select(F.inline(F.flatten(F.array(*[F.coalesce(r, empty) for r in rules]))))
    return table.filter(F.year("day").between(first_year, last_year))


def add_holiday_flag(df: DataFrame, ts_col: str, observed: str = "nearest", name: str = "is_holiday") -> DataFrame:
    """1 on federal holidays, else 0; the calendar is a few thousand rows at most."""
    calendar = holiday_calendar(df.sparkSession, 1868, 2262, observed).select(F.col("day").alias("_day")).distinct()
    out = df.join(F.broadcast(calendar), col(ts_col).cast("date") == F.col("_day"), "left")
    return out.withColumn(name, F.col("_day").isNotNull().cast("int")).drop("_day")


def add_time_features(
    df: DataFrame, dt_col: str, use_us_holidays: bool = True, observed: str = "nearest"
) -> DataFrame:
    """Calendar columns of a date column, parsed if needed, and a holiday flag."""
    out = df.withColumn("_ts", parse_date(df, dt_col))
    for name, expr in calendar_columns(F.col("_ts")).items():
        out = out.withColumn(name, expr)
    # a missing date is on no weekend
    out = out.withColumn("is_weekend", F.coalesce("is_weekend", F.lit(0)))
    if use_us_holidays:
        out = add_holiday_flag(out, "_ts", observed)
    else:
        out = out.withColumn("is_holiday", F.lit(0))
    return out.drop("_ts")


def add_series_features(series: DataFrame, day_col: str = "ds", observed: str = "nearest") -> DataFrame:
    """Day of week, month, weekend and holiday flag of a daily series."""
    day = col(day_col)
    out = (
        series.withColumn("dow", F.weekday(day))
        .withColumn("month", F.month(day))
        .withColumn("is_weekend", (F.weekday(day) >= 5).cast("int"))
    )
    return add_holiday_flag(out, day_col, observed)
