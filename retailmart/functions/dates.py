"""Dates kept as text, integer date keys and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: format of the source dates and span of the calendar
SOURCE_FORMAT = "M/d/yyyy"
CALENDAR_FIRST_DAY = "2010-01-01"
CALENDAR_LAST_DAY = "2030-12-31"


def parse_date(name: str) -> Column:
    """Date from ``M/d/yyyy`` text; text that is no such date gives NULL, never an error."""
    return F.try_to_date(F.col(name), SOURCE_FORMAT)


def date_key(day: Column) -> Column:
    """``yyyymmdd`` as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar_parts(name: str) -> list[Column]:
    """The calendar attributes of a date column; the week starts on Monday = 1."""
    day = F.col(name)
    return [
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    ]


def calendar(spark: SparkSession, first: str = CALENDAR_FIRST_DAY, last: str = CALENDAR_LAST_DAY) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("full_date")
    )
    return days.select(date_key(F.col("full_date")).alias("date_key"), "full_date", *calendar_parts("full_date"))
