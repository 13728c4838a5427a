"""Days picked by a calendar table instead of a date range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from teletally.functions.dates import days_between, parse_day


def calendar(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """``log_date``, ``weekday`` (1 is Monday), ``month``, ``day`` for every day of a period."""
    days = days_between(start, end)
    day = F.date_add(F.lit(parse_day(start)), F.col("id").cast("int"))
    found = spark.range(days).select(day.alias("log_date"))
    return found.select(
        "log_date",
        (F.weekday("log_date") + 1).alias("weekday"),
        F.month("log_date").alias("month"),
        F.dayofmonth("log_date").alias("day"),
    )


def on_days(log: DataFrame, days: DataFrame, wanted: Column) -> DataFrame:
    """Rows of a log on the days of a calendar table that meet a condition.

    ``days`` has one row per ``log_date``: a few thousand for a decade, so it is sent to all tasks. On a log stored by
    day Spark prunes its folders by them before it opens a file. Days listed twice change nothing.
    """
    return log.join(F.broadcast(days.where(wanted).select("log_date")), "log_date", "left_semi")
