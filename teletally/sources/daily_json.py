"""The raw log: line-delimited JSON, one file or folder per calendar day."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from teletally.functions.dates import SEPARATORS, day_text, days_between, file_date, listed_date, parse_day
from teletally.schema import raw_log_schema

# Names of data files; others, hidden files and tables stored next to the log are not listed.
FILE_NAMES = "[^._]*.json*"


def log_paths(root: str, layout: str = "file", days: list[dt.date] | None = None) -> str:
    """Path pattern of the names that may hold a day, of all days or of the months of the listed ones.

    A superset of what the date rule accepts, for any number of days: months only keep a long
    history from being listed for a short range. Which file belongs to which day is decided by
    the date rule alone (``day_text``); file names must match ``FILE_NAMES`` besides.
    """
    name = "[^._]*"
    if days:
        months = ",".join(sorted({f"{day:%Y%m}" for day in days}))
        name = f"{{,[^._]*[{''.join(SEPARATORS[layout])}]}}{{{months}}}*"
    return f"{root.rstrip('/')}/{name}" + ("/*" if layout == "folder" else "")


def _read(
    spark: SparkSession,
    root: str,
    layout: str,
    duration: T.DataType | None,
    days: list[dt.date] | None,
    fail_on_broken: bool,
) -> DataFrame:
    reader = spark.read.schema(raw_log_schema()).option("mode", "FAILFAST" if fail_on_broken else "PERMISSIVE")
    try:
        raw = reader.option("pathGlobFilter", FILE_NAMES).json(log_paths(root, layout, days))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # No name of these months: an empty frame if there is a log at all, else the same error.
        raw = reader.option("pathGlobFilter", "/").json(root)
    path = F.col("_metadata.file_path")
    if days is None:
        day = file_date(path, layout)
        wanted = day.isNotNull()
    else:
        wanted, day = listed_date(day_text(path, layout), days)
    return raw.where(wanted).select(
        F.col("_source.Contract").alias("contract"),
        F.col("_source.AppName").alias("app_name"),
        _duration(F.col("_source.TotalDuration"), duration or T.LongType()).alias("duration"),
        day.alias("log_date"),
    )


def _duration(text: Column, kind: T.DataType) -> Column:
    """The duration in its declared type; a text that does not fit fails the job and is named."""
    value = text.try_cast(kind)
    message = F.concat(F.lit(f"duration is no {kind.simpleString()}: "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(message).cast(kind)).otherwise(value)


def read_log(
    spark: SparkSession,
    root: str,
    start: str | dt.date,
    end: str | dt.date,
    *,
    layout: str = "file",
    duration: T.DataType | None = None,
    fail_on_broken: bool = False,
) -> DataFrame:
    """Flattened log rows of an inclusive date range, in one scan over all its files.

    The schema is declared, so no job infers it, and the date comes from the file path: only
    files of the range are opened, and files whose name holds no date are left out. A range
    without files, or an empty log folder, gives an empty frame with the full schema.

    Durations are read in the type ``duration`` (bigint by default), whether the log holds
    numbers or texts; one that does not fit fails the job. A line that is no JSON gives a row
    of NULLs, or fails the job with ``fail_on_broken``.
    """
    first, last = parse_day(start), parse_day(end)
    days = [first + dt.timedelta(days=i) for i in range(days_between(first, last))]
    return _read(spark, root, layout, duration, days, fail_on_broken)


def read_log_days(
    spark: SparkSession,
    root: str,
    days: list[dt.date],
    *,
    layout: str = "file",
    duration: T.DataType | None = None,
    fail_on_broken: bool = False,
) -> DataFrame:
    """Flattened log rows of the listed days; other days' files are not opened."""
    return _read(spark, root, layout, duration, days, fail_on_broken)


def read_whole_log(
    spark: SparkSession,
    root: str,
    *,
    layout: str = "file",
    duration: T.DataType | None = None,
    fail_on_broken: bool = False,
) -> DataFrame:
    """Flattened log rows of all days that the folder holds."""
    return _read(spark, root, layout, duration, None, fail_on_broken)
