"""Reading a log whose lines may be broken, and saying how many were.

A line is broken if it is no JSON object of the log's form, or if its duration does not fit the type. Broken lines are
set aside with their file instead of failing the job or passing as rows of NULLs. Good and broken rows are written
by one job into one Parquet table with a sub-folder for each kind, so that the log is scanned once; counts are
gathered while that job writes.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from teletally.functions.categories import has_category
from teletally.functions.dates import day_text, days_between, listed_date, parse_day
from teletally.schema import APP_CODES, CategoryCodes, log_schema, raw_log_schema
from teletally.sources.daily_json import FILE_NAMES, log_paths
from teletally.storage import delete, file_names

NO_JSON, NO_NUMBER = "no JSON", "duration"
ROWS, BROKEN = "rows", "broken"
_LINE = "_line"


@dataclass(frozen=True)
class LogCounts:
    """What one job read: lines, broken ones by reason, and good rows of unmapped apps or without a contract."""

    lines: int
    no_json: int
    bad_duration: int
    unmapped: int
    without_contract: int

    @property
    def broken(self) -> int:
        return self.no_json + self.bad_duration


def read_marked(
    spark: SparkSession,
    root: str,
    start: str | dt.date,
    end: str | dt.date,
    *,
    layout: str = "file",
    duration: T.DataType | None = None,
    names: str = FILE_NAMES,
) -> DataFrame:
    """All lines of a date range: the log columns, and for broken ones ``reason``, ``line`` and ``file``.

    A broken line has no contract, app or duration. Empty lines are none. A line that is JSON but lacks a field is
    a good row with a NULL there. A range without files gives an empty frame.
    """
    days = [parse_day(start) + dt.timedelta(days=i) for i in range(days_between(start, end))]
    schema = T.StructType([*raw_log_schema().fields, T.StructField(_LINE, T.StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", _LINE)
    try:
        raw = reader.option("pathGlobFilter", names).json(log_paths(root, layout, days))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = reader.option("pathGlobFilter", "/").json(root)
    wanted, day = listed_date(day_text(F.col("_metadata.file_path"), layout), days)
    kind = duration or T.LongType()
    text = F.col("_source.TotalDuration")
    value = text.try_cast(kind)
    reason = F.when(F.col(_LINE).isNotNull(), NO_JSON).when(text.isNotNull() & value.isNull(), NO_NUMBER)
    # A line with a bad duration is JSON, so it can be written out again.
    line = F.coalesce(F.col(_LINE), F.when(reason == NO_NUMBER, F.to_json(F.struct("_source"))))
    marked = raw.where(wanted).select(
        F.col("_source.Contract").alias("contract"),
        F.col("_source.AppName").alias("app_name"),
        value.alias("duration"),
        day.alias("log_date"),
        reason.alias("reason"),
        line.alias("line"),
        F.when(reason.isNotNull(), F.col("_metadata.file_path")).alias("file"),
    )
    whole = F.col("reason").isNull()
    return marked.withColumns({c: F.when(whole, F.col(c)) for c in ("contract", "app_name", "duration")})


def consolidate_checked(
    spark: SparkSession,
    root: str,
    out: str,
    start: str | dt.date,
    end: str | dt.date,
    *,
    layout: str = "file",
    duration: T.DataType | None = None,
    codes: CategoryCodes = APP_CODES,
    names: str = FILE_NAMES,
) -> LogCounts:
    """The days of a period to one table, good rows and broken lines apart, replacing what it had of these days.

    Counts are observed by the writing job itself: no second pass. They are of this run alone, also where Spark had to
    run a task twice. Days that have no row of a kind any more lose their folder of that kind after the job.
    """
    marked = read_marked(spark, root, start, end, layout=layout, duration=duration, names=names)
    good = F.col("reason").isNull()
    seen = Observation()
    observed = marked.observe(
        seen,
        F.count("*").alias("lines"),
        F.count_if(F.col("reason") == NO_JSON).alias("no_json"),
        F.count_if(F.col("reason") == NO_NUMBER).alias("bad_duration"),
        F.count_if(good & ~F.coalesce(has_category(F.col("app_name"), codes), F.lit(False))).alias("unmapped"),
        F.count_if(good & F.col("contract").isNull()).alias("without_contract"),
    )
    days = [parse_day(start) + dt.timedelta(days=i) for i in range(days_between(start, end))]
    folders = [f"{out.rstrip('/')}/kind={kind}" for kind in (ROWS, BROKEN)]
    # One listing per kind tells which days have a folder; only those of the period are looked into.
    held = [f"{f}/{name}" for f in folders for name in file_names(spark, f) & {f"log_date={d.isoformat()}" for d in days}]
    before = {folder: file_names(spark, folder) for folder in held}
    rows = observed.withColumn("kind", F.when(good, ROWS).otherwise(BROKEN))
    writer = rows.write.mode("overwrite").partitionBy("kind", "log_date")
    writer.option("partitionOverwriteMode", "dynamic").parquet(out)
    for folder, files in before.items():
        if file_names(spark, folder) == files:
            delete(spark, folder)
    return LogCounts(**seen.get)


def good_rows(spark: SparkSession, out: str, duration: T.DataType | None = None) -> DataFrame:
    """Log rows of a checked table; none if no day had any."""
    return _of_kind(spark, out, ROWS, log_schema(duration))


def broken_lines(spark: SparkSession, out: str) -> DataFrame:
    """``log_date``, ``reason``, ``line`` and ``file`` of the lines set aside."""
    schema = T.StructType.fromDDL("reason string, line string, file string, log_date date")
    return _of_kind(spark, out, BROKEN, schema)


def _of_kind(spark: SparkSession, out: str, kind: str, schema: T.StructType) -> DataFrame:
    folder = f"{out.rstrip('/')}/kind={kind}"
    if not file_names(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)
