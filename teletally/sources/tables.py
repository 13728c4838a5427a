"""Stored tables: CSV, Parquet and JDBC."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from teletally.functions.dates import parse_day


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *, line_breaks: bool = False) -> DataFrame:
    """CSV with a header row and a declared schema; the header is checked against it.

    An unquoted empty field is NULL and a quoted one an empty string, as the writer puts them;
    the null marker only keeps Spark from reading both as NULL. Blanks around a value belong to
    it. ``line_breaks``: values may hold line breaks; a file is then read by one task.
    """
    return spark.read.schema(schema).csv(
        path,
        header=True,
        enforceSchema=False,
        nullValue="\0",
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        multiLine=line_breaks,
    )


def read_parquet_log(
    spark: SparkSession, path: str, start: str | dt.date | None = None, end: str | dt.date | None = None
) -> DataFrame:
    """Consolidated log, whole or of an inclusive date range; other ``log_date`` partitions are pruned."""
    log = spark.read.parquet(path)
    if start is None and end is None:
        return log
    if start is None or end is None:
        raise ValueError("a period has a start and an end")
    return log.where(F.col("log_date").between(F.lit(parse_day(start)), F.lit(parse_day(end))))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Database table, read in parallel.

    Give either a numeric, date or timestamp ``column`` with ``bounds`` and ``partitions``,
    or ``predicates``: one disjoint condition per task, for a text key. With neither, one
    task reads the whole table, which suits small tables only.
    """
    properties = dict(properties)
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    if column is None:
        return spark.read.jdbc(url, table, properties=properties)
    if bounds is None or partitions is None:
        raise ValueError("a partition column needs bounds and a number of partitions")
    low, high = bounds
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=low,
        upperBound=high,
        numPartitions=partitions,
        properties=properties,
    )
