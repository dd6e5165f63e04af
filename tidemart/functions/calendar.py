"""Date keys, calendar parts and date arithmetic by part."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.functions.scalar import ColumnOrName, column

DATE_PARTS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


def clock_time(value) -> Column:
    """A literal timestamp without a zone; a plain literal would be read in the
    time zone of the session."""
    return F.lit(str(value)).cast("timestamp_ntz")


def date_id_text(c: ColumnOrName) -> Column:
    """``yyyymmdd`` as text."""
    return F.date_format(column(c).cast("date"), "yyyyMMdd")


def date_id(c: ColumnOrName, default: int | None = None) -> Column:
    """``yyyymmdd`` as integer, with an optional value for NULL."""
    out = date_id_text(c).cast("int")
    return out if default is None else F.coalesce(out, F.lit(default))


def hours_between_dates(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Hours between the two calendar dates; the times of day are ignored."""
    return F.date_diff(column(end).cast("date"), column(start).cast("date")) * 24


def _checked_part(part: str) -> str:
    part = part.lower()
    if part not in DATE_PARTS:
        raise ValueError(f"date part must be one of {DATE_PARTS}, got {part!r}")
    return part


def date_add(part: str, amount: ColumnOrName | int, c: ColumnOrName) -> Column:
    """Timestamp ``c`` moved by ``amount`` whole parts."""
    amount = F.lit(amount) if isinstance(amount, int) else column(amount)
    return F.timestamp_add(
        _checked_part(part).upper(), amount.cast("int"), column(c).cast("timestamp_ntz")
    )


def _units_since_epoch(part: str, c: Column) -> Column:
    """Whole parts elapsed since 1970-01-01, rounded down; free of time zones."""
    day = c.cast("date")
    if part == "day":
        return F.unix_date(day)
    if part == "week":
        # 1970-01-05 was a Monday.
        return F.floor((F.unix_date(day) - 4) / 7)
    if part == "month":
        return F.year(day) * 12 + F.month(day)
    if part == "quarter":
        return F.year(day) * 4 + F.quarter(day)
    if part == "year":
        return F.year(day)
    micros = F.timestamp_diff(
        "MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c
    )
    seconds = {"second": 1, "minute": 60, "hour": 3600}[part]
    # Integer arithmetic: a double cannot hold every microsecond count.
    unit = F.lit(seconds * 1_000_000)
    return (micros - F.pmod(micros, unit)).cast("decimal(20,0)") / unit


def date_diff(part: str, start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of part boundaries crossed from ``start`` to ``end``."""
    part = _checked_part(part)
    first, last = (
        _units_since_epoch(part, column(c).cast("timestamp_ntz")) for c in (start, end)
    )
    return (last - first).cast("bigint")


def calendar_columns(day: ColumnOrName) -> list[Column]:
    """The columns of the date dimension for a date column."""
    d = column(day)
    year, quarter = F.year(d), F.quarter(d)
    day_of_week = F.dayofweek(d) - 1
    return [
        d.alias("date_actual"),
        date_id(d).alias("date_id"),
        year.alias("year_number"),
        F.concat(F.lit("CY "), year).alias("year_code"),
        quarter.alias("quarter_number"),
        F.concat(F.lit("Q"), quarter).alias("quarter_code"),
        F.concat(year, F.lit("-Q"), quarter).alias("year_quarter_code"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_short"),
        F.date_format(d, "yyyy-MM").alias("year_month_code"),
        F.weekofyear(d).alias("week_of_year"),
        F.trunc(d, "week").alias("week_start_date"),
        F.dayofmonth(d).alias("day_of_month"),
        day_of_week.alias("day_of_week_number"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "E").alias("day_name_short"),
        day_of_week.isin(0, 6).alias("is_weekend"),
    ]
