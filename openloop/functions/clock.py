"""Time arithmetic on whole microseconds since the epoch.

Every report works on a BIGINT instant. Hours, days and months then follow from integer
arithmetic in UTC and never depend on the session time zone, whether a table stores
``timestamp`` or ``timestamp_ntz`` (read as UTC).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECOND_US = 1_000_000
MINUTE_US = 60 * SECOND_US
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Instant of a timestamp column as exact microseconds since 1970-01-01 UTC."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        origin = "timestamp_ntz'1970-01-01 00:00:00'"
        return F.expr(f"(`{name}` - {origin}) div interval '0.000001' second")
    return F.unix_micros(df[name])


def whole_div(value: Column, by: Column | int) -> Column:
    """BIGINT division, truncating toward zero."""
    divisor = by if isinstance(by, Column) else F.lit(by).cast("bigint")
    return F.call_function("div", value, divisor)


def slot_of(us: Column, width_us: int) -> Column:
    """Index of the fixed-width time slot holding an instant; floors before 1970 as well."""
    width = F.lit(width_us).cast("bigint")
    return whole_div(us - F.pmod(us, width), width)


def utc_day(us: Column) -> Column:
    return F.date_from_unix_date(slot_of(us, DAY_US).cast("int"))


def day_of(df: DataFrame, name: str) -> Column:
    """UTC day of a timestamp column."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return df[name].cast("date")
    return utc_day(epoch_micros(df, name))


def month_of(df: DataFrame, name: str) -> Column:
    """First day of the UTC month of a timestamp column."""
    return F.trunc(day_of(df, name), "month")


def within_days(df: DataFrame, name: str, first: dt.date, last: dt.date) -> Column:
    """Whether a timestamp column falls on the UTC days ``first`` to ``last``. A plain range of
    the stored column, so that a Parquet scan can skip row groups outside it."""
    after = last + dt.timedelta(days=1)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        low, high = (F.expr(f"timestamp_ntz'{day} 00:00:00'") for day in (first, after))
    else:
        epoch = dt.date(1970, 1, 1)
        low, high = (F.timestamp_micros(F.lit((day - epoch).days * DAY_US)) for day in (first, after))
    return (df[name] >= low) & (df[name] < high)


def utc_hour(us: Column) -> Column:
    """Hour of the day in UTC, 0..23."""
    return whole_div(F.pmod(us, F.lit(DAY_US).cast("bigint")), HOUR_US).cast("int")


def day_start_micros(day: Column) -> Column:
    return F.unix_date(day).cast("bigint") * F.lit(DAY_US)


def as_interval(us: Column) -> Column:
    """Microseconds as a day-time interval."""
    return F.expr("interval '0.000001' second") * us


def iso_utc(us: Column) -> Column:
    """ISO-8601 text with milliseconds and ``Z``."""
    of_day = F.pmod(us, F.lit(DAY_US).cast("bigint"))

    def two(value: Column) -> Column:
        return F.lpad(value.cast("string"), 2, "0")

    clock = F.concat_ws(
        ":",
        two(whole_div(of_day, HOUR_US)),
        two(whole_div(F.pmod(of_day, F.lit(HOUR_US)), MINUTE_US)),
        two(whole_div(F.pmod(of_day, F.lit(MINUTE_US)), SECOND_US)),
    )
    millis = F.lpad(whole_div(F.pmod(of_day, F.lit(SECOND_US)), 1000).cast("string"), 3, "0")
    return F.concat(utc_day(us).cast("string"), F.lit("T"), clock, F.lit("."), millis, F.lit("Z"))
