"""Generated calendars."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The calendar every date dimension covers.
CALENDAR_START = date(2010, 1, 1)
CALENDAR_END = date(2035, 12, 31)


def date_range(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    """Every day from ``start`` to ``end`` inclusive, as ``full_date``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("full_date")
    )


def date_attributes(df: DataFrame, column: str = "full_date") -> DataFrame:
    """Calendar attributes of one row per day."""
    day = F.col(column)
    return df.withColumns(
        {
            "date_key": F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day),
            "year": F.year(day),
            "quarter": F.quarter(day),
            "month": F.month(day),
            "month_name": F.date_format(day, "MMMM"),
            "day": F.dayofmonth(day),
            "week_of_year": F.weekofyear(day),
            "day_of_week": F.dayofweek(day),
            "day_name": F.date_format(day, "EEEE"),
            "is_weekend": F.dayofweek(day).isin(1, 7),
        }
    )


def date_dimension(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    """The date dimension, one row per day."""
    return date_attributes(date_range(spark, start, end))
