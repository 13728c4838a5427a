"""Small files of a table by day packed into larger ones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from teletally.storage import store

TARGET_BYTES = 128 * 2**20
# Share of the files that could be saved from which on a day is packed anew.
WASTE = 0.5


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``length``, ``log_date`` of the data files of a Parquet table by day; no content is read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    day = F.regexp_extract("path", "/log_date=([0-9-]{10})/", 1).try_cast("date")
    return found.select(F.col("path").alias("file"), "length", day.alias("log_date")).where("log_date IS NOT NULL")


def packed_bins(files: DataFrame, target: int = TARGET_BYTES, waste: float = WASTE) -> DataFrame:
    """``file``, ``log_date``, ``bin`` for the files of the days that are worth packing.

    Files of a day are put side by side, largest first, and cut into bins of about ``target`` bytes. A day is left
    alone while packing would save less than the share ``waste`` of its files.
    """
    by_size = Window.partitionBy("log_date").orderBy(F.desc("length"), "file")
    day = Window.partitionBy("log_date")
    before = F.sum("length").over(by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("length")
    placed = files.withColumn("bin", F.floor(before / F.lit(target)).cast("int"))
    placed = placed.withColumns({"files": F.count("*").over(day), "bins": F.max("bin").over(day) + 1})
    return placed.where(F.col("bins") <= F.col("files") * (1 - waste)).select("file", "log_date", "bin")


def compact(spark: SparkSession, path: str, *, target: int = TARGET_BYTES, waste: float = WASTE) -> list[dt.date]:
    """Pack the small files of a Parquet table by day; returns the days that were packed.

    Only those days are read and replaced; rows stay the same. They are written to the shared folder first, so a run that
    fails leaves the table as it was. Rows of a bin are sorted by contract where there is one, as ``consolidate``
    leaves them. One writer at a time: a day that changes meanwhile would lose the change.
    """
    bins = store(packed_bins(table_files(spark, path), target, waste), "file-bins")
    days = sorted(row.log_date for row in bins.select("log_date").distinct().collect())
    if not days:
        return []
    # Bins are numbered day by day, so that each is one task and one file, however small or many they are.
    tasks = bins.groupBy("log_date").agg((F.max("bin") + 1).alias("bins"))
    before = F.sum("bins").over(Window.orderBy("log_date").rowsBetween(Window.unboundedPreceding, -1))
    tasks = store(tasks.select("log_date", "bins", F.coalesce(before, F.lit(0)).alias("first")), "bin-tasks")
    bins = bins.join(tasks, "log_date").withColumn("task", (F.col("first") + F.col("bin")).cast("int"))
    count = tasks.agg(F.sum("bins")).first()[0]
    table = spark.read.parquet(path)
    rows = table.where(F.col("log_date").isin(days)).withColumn("_file", F.col("_metadata.file_path"))
    binned = rows.join(bins.select(F.col("file").alias("_file"), F.col("task").alias("_task")), "_file").drop("_file")
    copy = store(binned, "compaction")
    order = [c for c in ("contract",) if c in table.columns]
    ordered = copy.repartitionById(count, F.col("_task")).sortWithinPartitions("log_date", *order)
    writer = ordered.select(*table.columns).write.mode("overwrite").partitionBy("log_date")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return days
