"""Daily totals kept up to date as log files arrive.

The stream carries file names only. A micro-batch says which days received files; those days
are then read whole from the log and their partitions replaced. So a day spread over several
batches, a replayed batch and a lost checkpoint all end in the same table.

Log files are written once: a file changed under its old name is not announced again, and neither
is one that is deleted. ``refresh_days`` does such days over. Files without content are never
announced by Spark; a run does the days over that have one and rows in the table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from teletally.functions.dates import file_date
from teletally.operators.aggregates import daily_totals
from teletally.plans.sessions import sessions
from teletally.schema import APP_CODES, CategoryCodes
from teletally.sinks.writers import write_parquet
from teletally.sources.daily_json import FILE_NAMES, log_paths, read_log_days
from teletally.storage import empty_files, file_names

# The file source's own columns; only the path is selected, so no content is read.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def run_daily_totals(
    spark: SparkSession,
    root: str,
    out: str,
    checkpoint: str,
    *,
    layout: str = "file",
    duration: T.DataType | None = None,
    codes: CategoryCodes = APP_CODES,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Process every file not seen before, then stop.

    By default a run takes its whole backlog as one batch, so that each day is read once.
    ``files_per_batch`` cuts a long backlog into batches; a day whose files fall into several
    of them is read again for each. The driver only sees the dates of a batch.
    """

    def replace_days(batch: DataFrame, _: int) -> None:
        named = batch.select(file_date(F.col("path"), layout).alias("day")).distinct()
        days = [row.day for row in named.collect() if row.day is not None]
        refresh_days(spark, root, out, days, layout=layout, duration=duration, codes=codes)

    empty = empty_files(spark, log_paths(root, layout))
    if empty:
        named = spark.createDataFrame([(path,) for path in empty], "path string")
        days = {row.day for row in named.select(file_date(F.col("path"), layout).alias("day")).collect()} - {None}
        stored = [day for day in sorted(days) if file_names(spark, f"{out.rstrip('/')}/log_date={day.isoformat()}")]
        refresh_days(spark, root, out, stored, layout=layout, duration=duration, codes=codes)

    source = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", FILE_NAMES)
    if files_per_batch is not None:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    paths = source.load(log_paths(root, layout)).select("path")
    return (
        paths.writeStream.foreachBatch(replace_days)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_days(
    spark: SparkSession,
    root: str,
    out: str,
    days: list[dt.date],
    *,
    layout: str = "file",
    duration: T.DataType | None = None,
    codes: CategoryCodes = APP_CODES,
) -> None:
    """Totals of the named days from the log as it is now; days without rows are emptied."""
    if days:
        log = read_log_days(spark, root, days, layout=layout, duration=duration)
        totals = daily_totals(sessions(log, codes))
        write_parquet(totals, out, rebalance=True, replace_days=True, days=days)


def stored_daily_totals(spark: SparkSession, out: str, duration: T.DataType | None = None) -> DataFrame:
    """The table the runs maintain, grain (contract, category, day)."""
    schema = T.StructType(
        [
            T.StructField("contract", T.StringType()),
            T.StructField("category", T.StringType()),
            T.StructField("total", duration or T.LongType()),
            T.StructField("log_date", T.DateType()),
        ]
    )
    return spark.read.schema(schema).parquet(out)
