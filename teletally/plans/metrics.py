"""The customer metrics, one row per contract each."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from teletally.functions.dates import days_between
from teletally.functions.scores import (
    active_any,
    active_percent,
    active_rate,
    active_total,
    activity_level,
    engagement_type,
    presence_label,
    seen_categories,
    taste,
    top_category,
)
from teletally.operators import aggregates
from teletally.operators.active_days import DayMarks
from teletally.operators.filters import in_period
from teletally.operators.pivots import pivot_by_day
from teletally.operators.quantiles import exact_quantiles
from teletally.schema import CATEGORIES, duration_column


def category_rank() -> Column:
    """Position of a category in the fixed order, for breaking ties."""
    return F.array_position(F.lit(list(CATEGORIES)), F.col("category"))


def most_watched_ranked(rows: DataFrame, value: str) -> DataFrame:
    """Category of the contract's top row, by a window over ``value``.

    Ties go to the earlier category; a NULL value ranks last. Spark keeps only the first row
    per contract in each map task before the shuffle, so a large contract stays harmless.
    """
    order = Window.partitionBy("contract").orderBy(F.desc_nulls_last(value), category_rank())
    top = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == 1)
    return top.select("contract", F.col("category").alias("most_watch"))


def most_watched(sessions: DataFrame, grain: str = "total") -> DataFrame:
    """Most-watched category by hash aggregation only.

    ``grain`` is what is compared: a category's ``total``, its best ``day`` or its longest
    single ``session``. Equal to ``most_watched_ranked`` over the same rows.
    """
    if grain == "day":
        rows, value, best = aggregates.daily_totals(sessions), "total", "max"
    elif grain in ("total", "session"):
        rows, value, best = sessions, "duration", "sum" if grain == "total" else "max"
    else:
        raise ValueError(f"unknown grain: {grain}")
    tops = [F.expr(f"{best}(CASE WHEN category = '{c}' THEN {value} END) AS {duration_column(c)}") for c in CATEGORIES]
    per_contract = rows.groupBy("contract").agg(*tops, seen_categories())
    return per_contract.select("contract", top_category().alias("most_watch"))


def presence_labels(pivot: DataFrame) -> DataFrame:
    """The pivot with each duration replaced by its category's label, NULL staying NULL."""
    labels = [presence_label(c).alias(c.lower()) for c in CATEGORIES]
    return pivot.select("contract", *labels)


def customer_taste(pivot: DataFrame, *, nonzero: bool = False) -> DataFrame:
    """Watched categories of a contract-grain pivot; ``nonzero`` leaves out zero totals."""
    return pivot.select("contract", taste(nonzero).alias("customer_taste"))


def _activeness(days: DataFrame, period: int) -> DataFrame:
    return _with_rates(days.groupBy("contract").agg(F.sum("is_active").alias("active_days")), period)


def _with_rates(active: DataFrame, period: int) -> DataFrame:
    return active.select(
        "contract",
        "active_days",
        active_rate(F.col("active_days"), period).alias("active_rate"),
        active_percent(F.col("active_days"), period).alias("active_percent"),
    )


def activeness(sessions: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Active days and their share of the calendar days of the period, by daily total."""
    days = aggregates.day_totals(sessions)
    flagged = days.select("contract", active_total(F.col("total")).alias("is_active"))
    return _activeness(flagged, days_between(start, end))


def activeness_by_marks(sessions: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """The same with a single shuffle, for logs without negative durations (else it fails)."""
    marks = DayMarks(start, end)
    counted = sessions.groupBy("contract").agg(*marks.aggregates()).withColumn("active_days", marks.count())
    return _with_rates(counted, days_between(start, end))


def rolling_activeness(sessions: DataFrame, start: str | dt.date, end: str | dt.date, days: int) -> DataFrame:
    """``contract``, ``end_date``, ``active_days``, ``active_rate`` for every window of ``days`` days in the period.

    One aggregate: a bit set of active days per contract, out of which every window is a shift and a count. A contract
    has a row for every window, with 0 days where it was not active. For logs without negative durations (else it
    fails); a period shorter than a window gives no rows.
    """
    marks = DayMarks(start, end)
    marked = sessions.groupBy("contract").agg(*marks.aggregates())
    if marks.days < days:
        marked = marked.limit(0)
    offsets = F.sequence(F.lit(days - 1), F.lit(max(marks.days, days) - 1))
    windows = marked.withColumn("last", F.explode(offsets))
    counted = marks.count_in(F.col("last") - (days - 1), F.col("last"))
    windows = windows.select("contract", F.date_add(F.lit(marks.start), F.col("last")).alias("end_date"), counted.alias("active_days"))
    return windows.withColumn("active_rate", active_rate(F.col("active_days"), days))


def activeness_from_pivot(sessions: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """The same by "any category positive"; equal as long as no duration is negative."""
    days = in_period(pivot_by_day(sessions), start, end)
    flagged = days.select("contract", active_any().alias("is_active"))
    return _activeness(flagged, days_between(start, end))


def active_levels(activeness: DataFrame, threshold: float) -> DataFrame:
    """Activity level per contract."""
    return activeness.select(
        "contract", "active_rate", activity_level(F.col("active_rate"), threshold).alias("active_level")
    )


def engagement_levels(totals: DataFrame, low_max: float, high_min: float) -> DataFrame:
    """Engagement per contract, from its total and the caller's cut-offs."""
    level = engagement_type(F.col("total"), F.lit(low_max), F.lit(high_min))
    return totals.select("contract", "total", level.alias("engagement_type"))


def engagement_by_quantile(
    totals: DataFrame, fractions: tuple[float, float] = (1 / 3, 2 / 3)
) -> DataFrame:
    """Engagement per contract, with cut-offs at exact quantiles of the totals.

    ``totals`` is read several times; hand in a stored table. The cut-offs enter as a
    scalar, so the totals are not shuffled again.
    """
    cuts = exact_quantiles(totals, "total", fractions).select(F.struct("q0", "q1")).scalar()
    level = engagement_type(F.col("total").cast("double"), cuts["q0"], cuts["q1"])
    return totals.select("contract", "total", level.alias("engagement_type"))
