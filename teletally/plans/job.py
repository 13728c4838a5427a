"""The batch job: read a date range, build a profile, write it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from teletally.functions.dates import days_between, parse_day
from teletally.operators.filters import session_columns
from teletally.plans import profiles
from teletally.plans.sessions import sessions
from teletally.schema import APP_CODES, CategoryCodes
from teletally.sinks.writers import write_parquet
from teletally.sources.daily_json import read_log
from teletally.storage import store


def build_profile(
    log: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    *,
    grain: str = "customer",
    codes: CategoryCodes = APP_CODES,
    drop_unknown_contract: bool = False,
    drop_null_contract: bool = True,
    dedup: bool = False,
    non_negative: bool = False,
) -> DataFrame:
    """Profile of a log at ``customer``, ``day`` or ``session`` grain.

    Rows without a contract are left out unless ``drop_null_contract`` is off; then they
    appear with their totals but without metrics. The session grain writes the contract
    metrics to the shared folder first, because its plan reads them three times.
    ``non_negative`` is passed to ``customer_profile``; the day grain has no use for it.
    """
    rows = sessions(log, codes, drop_unknown_contract=drop_unknown_contract, dedup=dedup)
    if grain == "customer":
        return profiles.customer_profile(
            rows, start, end, drop_null_contract=drop_null_contract, non_negative=non_negative
        )
    if grain == "day":
        return profiles.daily_profile(rows, start, end, drop_null_contract=drop_null_contract)
    if grain == "session":
        sized = profiles.customer_profile(rows, start, end, with_size=True, non_negative=non_negative)
        sized = store(sized, "contract-metrics")
        rows = session_columns(rows)
        if drop_null_contract:
            rows = rows.where(F.col("contract").isNotNull())
        return profiles.session_profile(rows, sized)
    raise ValueError(f"unknown grain: {grain}")


def run(
    spark: SparkSession,
    root: str,
    start: str | dt.date,
    end: str | dt.date,
    *,
    layout: str = "file",
    duration: T.DataType | None = None,
    fail_on_broken: bool = False,
    **options,
) -> DataFrame:
    """``build_profile`` over the daily JSON log in ``root``, with durations of a chosen type."""
    log = read_log(spark, root, start, end, layout=layout, duration=duration, fail_on_broken=fail_on_broken)
    return build_profile(log, start, end, **options)


def consolidate(
    spark: SparkSession,
    root: str,
    out: str,
    start: str | dt.date,
    end: str | dt.date,
    *,
    layout: str = "file",
    duration: T.DataType | None = None,
    fail_on_broken: bool = False,
) -> None:
    """Daily JSON files to one Parquet table by day, replacing the days of the period.

    Later runs read the columns they need of the days they need. Rows are written where they
    are read, without a shuffle, and sorted by contract within each file, with a bloom filter on it; a task that read
    small files of several days writes one file for each. A day without rows is emptied.
    """
    log = read_log(spark, root, start, end, layout=layout, duration=duration, fail_on_broken=fail_on_broken)
    first = parse_day(start)
    days = [first + dt.timedelta(days=i) for i in range(days_between(start, end))]
    write_parquet(log, out, replace_days=True, days=days, sort=True, bloom=["contract"])
