"""Rows made from bounds: numbers, date spines, the calendar."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.calendar import calendar_columns, clock_time, date_add, date_diff

# First day and length of the calendar.
CALENDAR_START = date(2015, 1, 1)
CALENDAR_DAYS = 7305


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """The integers 1 .. ``upper_bound``."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def date_spine(
    spark: SparkSession,
    part: str,
    start: date | datetime | str,
    end: date | datetime | str,
) -> DataFrame:
    """One row per date part from ``start``; ``end`` itself is left out.

    The number of rows is the number of part boundaries between the bounds. The
    rows come from a range, so a long spine is made by many tasks.
    """
    first, last = clock_time(start), clock_time(end)
    periods = spark.range(1).select(date_diff(part, first, last)).first()[0]
    if periods <= 0:
        raise ValueError("the end must lie after the start")
    name = f"date_{part}"
    spine = spark.range(periods).select(date_add(part, "id", first).alias(name))
    return spine.filter(F.col(name) <= last)


def calendar(
    spark: SparkSession, start: date = CALENDAR_START, days: int = CALENDAR_DAYS
) -> DataFrame:
    """The date dimension: one row per day with its calendar parts."""
    day = F.date_add(F.lit(start.isoformat()).cast("date"), F.col("id").cast("int"))
    return spark.range(days).select(day.alias("d")).select(*calendar_columns("d"))


def calendar_end(start: date = CALENDAR_START, days: int = CALENDAR_DAYS) -> date:
    """Last day of the calendar."""
    return start + timedelta(days=days - 1)
