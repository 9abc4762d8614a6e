"""Date and time expressions; every parse of dirty text is a ``try_`` form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed formats of the source system. Single letters accept padded and unpadded digits.
DATE_FORMAT = "M/d/yyyy"
TIMESTAMP_FORMAT = "M/d/yyyy, h:mm a"


def parse_date(col: Column, fmt: str = DATE_FORMAT) -> Column:
    """Text to DATE, null where the text does not match."""
    return F.try_to_date(col, fmt)


def parse_date_lenient(col: Column) -> Column:
    """Text to DATE, trying the source format first and ISO second."""
    return F.coalesce(F.try_to_date(col, DATE_FORMAT), F.try_to_date(col, "yyyy-M-d"))


def parse_ts(col: Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Text to TIMESTAMP without zone, null where the text does not match."""
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def epoch_ms_to_ts(col: Column) -> Column:
    """Milliseconds since 1970 to TIMESTAMP without zone."""
    return F.timestamp_millis(col.cast("bigint")).cast("timestamp_ntz")


def month_start(ts: Column) -> Column:
    """First instant of the month; ``date_trunc`` adds a zone, so it is cast back."""
    return F.date_trunc("month", ts).cast("timestamp_ntz")


DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def day_name(ts: Column) -> Column:
    """Full English day name, by index instead of a formatter call per row."""
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.dayofweek(ts))


def day_index(ts: Column) -> Column:
    """Sunday = 0 … Saturday = 6."""
    return (F.dayofweek(ts) - 1).cast("bigint")


def days_between(start: Column, end: Column) -> Column:
    """Whole days from start to end; negative when end is earlier."""
    return F.datediff(end.cast("date"), start.cast("date")).cast("bigint")


def days_between_nonneg(start: Column, end: Column) -> Column:
    """Whole days from start to end, null when negative (a data error)."""
    gap = days_between(start, end)
    return F.when(gap >= 0, gap)


def age_days(start: Column, as_of: Column) -> Column:
    """Days elapsed since ``start`` at the given date."""
    return days_between(start, as_of)


def dates_in_range(start: Column, end: Column, inclusive: bool = True) -> Column:
    """Array of dates. ``sequence`` counts down when end < start, so that case is guarded."""
    last = end if inclusive else F.date_sub(end, 1)
    return F.when(start <= last, F.sequence(start, last)).otherwise(F.array().cast("array<date>"))


def date_list(spark: SparkSession, start: str, end: str, inclusive: bool = True) -> DataFrame:
    """One row per date between two ISO dates."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("a"), F.lit(end).cast("date").alias("b"))
    return bounds.select(F.explode(dates_in_range(F.col("a"), F.col("b"), inclusive)).alias("date"))


def date_path(date: Column, prefix: str = "output/", suffix: str = ".jsonl") -> Column:
    """``output/YYYY/MM/DD.jsonl`` for a date."""
    return F.concat(F.lit(prefix), F.date_format(date, "yyyy/MM/dd"), F.lit(suffix))
