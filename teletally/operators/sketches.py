"""Distinct customers and quantiles of any period, out of small sketches stored per day.

A theta sketch keeps the lowest hashes of the contracts it has seen. Sketches are united, intersected and subtracted
without the log, so a stored sketch per category and day answers for every period. Up to ``2**lg`` customers
the counts are exact; beyond, one standard error is about ``2 ** (-lg / 2)`` of the united set (0.8 % for 14).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teletally.functions.dates import parse_day

# Hashes in a theta sketch, as a power of two, and the size parameter of a KLL sketch.
LG = 14
K = 400


def relative_error(lg: int = LG) -> float:
    """One standard error of a count, as a share of the united set's size."""
    return 2 ** (-lg / 2)


def rank_error(k: int = K) -> float:
    """How far the rank of an estimated quantile may be off, as a share of the values (99 % confidence)."""
    return 2.296 / k**0.9723


def daily_customers(sessions: DataFrame, *, lg: int = LG) -> DataFrame:
    """Grain (category, day): ``customers`` (theta sketch of the contracts) and ``total``.

    One pass; a sketch is filled on the map side, so a shuffle moves one per task and group, however many rows there
    are. Rows without a contract add to the total only.
    """
    return sessions.groupBy("category", "log_date").agg(
        F.theta_sketch_agg("contract", lg).alias("customers"), F.sum("duration").alias("total")
    )


def _within(daily: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    return daily.where(F.col("log_date").between(F.lit(parse_day(start)), F.lit(parse_day(end))))


def customers_by_category(daily: DataFrame, start: str | dt.date, end: str | dt.date, *, lg: int = LG) -> DataFrame:
    """``category``, ``contracts`` (estimate), ``total`` of an inclusive period, from stored daily sketches."""
    united = _within(daily, start, end).groupBy("category").agg(
        F.theta_union_agg("customers", lg).alias("customers"), F.sum("total").alias("total")
    )
    return united.select("category", F.theta_sketch_estimate("customers").alias("contracts"), "total")


def customers_per_window(daily: DataFrame, start: str | dt.date, end: str | dt.date, days: int, *, lg: int = LG) -> DataFrame:
    """``category``, ``end_date``, ``contracts``: customers of every window of ``days`` days that lies in the period.

    A day's sketch goes to the windows that hold it, so a window costs its days' sketches, not their rows. Windows
    without any row are left out.
    """
    first, last = F.lit(parse_day(start)), F.lit(parse_day(end))
    # A day lies in the windows that end on it or up to days - 1 days later.
    low = F.greatest(F.col("log_date"), F.date_add(first, days - 1))
    high = F.least(F.date_add("log_date", days - 1), last)
    placed = _within(daily, start, end).where(low <= high)
    placed = placed.withColumn("end_date", F.explode(F.sequence(low, high)))
    united = placed.groupBy("category", "end_date").agg(F.theta_union_agg("customers", lg).alias("customers"))
    return united.select("category", "end_date", F.theta_sketch_estimate("customers").alias("contracts"))


def retention(
    daily: DataFrame,
    first: tuple[str | dt.date, str | dt.date],
    second: tuple[str | dt.date, str | dt.date],
    *,
    lg: int = LG,
) -> DataFrame:
    """``category``, ``before``, ``after``, ``stayed``, ``gone``, ``joined``: customers of two periods and their overlap.

    All five from set operations on stored sketches. A category without rows in a period counts 0 there.
    """

    def united(period: tuple, name: str) -> DataFrame:
        return _within(daily, *period).groupBy("category").agg(F.theta_union_agg("customers", lg).alias(name))

    def count(sketch: Column) -> Column:
        return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0).cast("bigint"))

    both = united(first, "a").join(united(second, "b"), "category", "full_outer")
    # Set operations with a missing period: all are gone, or all have joined.
    gone = F.when(F.col("b").isNull(), F.col("a")).otherwise(F.theta_difference("a", "b"))
    joined = F.when(F.col("a").isNull(), F.col("b")).otherwise(F.theta_difference("b", "a"))
    return both.select(
        "category",
        count(F.col("a")).alias("before"),
        count(F.col("b")).alias("after"),
        count(F.theta_intersection("a", "b")).alias("stayed"),
        count(gone).alias("gone"),
        count(joined).alias("joined"),
    )


def daily_quantiles(totals: DataFrame, *, k: int = K) -> DataFrame:
    """Grain (day): ``totals`` (KLL sketch of the day's totals per contract) from (contract, day) totals."""
    return totals.where("total IS NOT NULL").groupBy("log_date").agg(
        F.kll_sketch_agg_bigint(F.col("total").cast("bigint"), k).alias("totals")
    )


def quantiles_of_period(
    daily: DataFrame, start: str | dt.date, end: str | dt.date, fractions: tuple[float, ...], *, k: int = K
) -> DataFrame:
    """``fraction``, ``value``, ``n``, ``rank_error``: quantiles of the daily totals of a period, merged from stored sketches.

    The rank of ``value`` among the ``n`` values is off by at most ``rank_error`` of them, with 99 % confidence.
    """
    merged = _within(daily, start, end).agg(F.kll_merge_agg_bigint("totals", k).alias("totals"))
    wanted = F.array(*[F.lit(float(f)) for f in fractions])
    both = F.arrays_zip(wanted.alias("fraction"), F.kll_sketch_get_quantile_bigint("totals", wanted).alias("value"))
    found = merged.select(F.explode(both).alias("one"), F.kll_sketch_get_n_bigint("totals").alias("n"))
    return found.select("one.fraction", "one.value", "n", F.lit(rank_error(k)).alias("rank_error"))
