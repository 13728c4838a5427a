"""Profiles: viewing totals and metrics together, at contract, day and session grain."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teletally.functions.dates import days_between
from teletally.functions.scores import active_rate, active_sum, seen_categories, taste, top_category
from teletally.operators.active_days import DayMarks
from teletally.operators.joins import MAX_HOT_CONTRACTS, SPLIT_ROWS, attach, attach_to_sessions
from teletally.operators.pivots import category_sums, pivot, pivot_by_day
from teletally.plans import metrics
from teletally.schema import DURATION_COLUMNS

METRICS = ("most_watch", "customer_taste", "active_days", "active_rate")


def day_facts(sessions: DataFrame) -> DataFrame:
    """Grain (contract, day): duration per category, the categories seen, the day's activity."""
    facts = sessions.groupBy("contract", "log_date").agg(
        *category_sums(), seen_categories(), F.count("*").alias("n_sessions")
    )
    return facts.withColumn("is_active", active_sum())


def _profile_columns(days: int) -> dict[str, Column]:
    """Metrics over contract-level columns of the same names as the day facts'."""
    return {
        "most_watch": top_category(),
        "customer_taste": taste(),
        "active_rate": active_rate(F.col("active_days"), days),
    }


def _without_metrics_for_null_contract(df: DataFrame) -> DataFrame:
    """Metrics joined on contract never reach a row without one; the same by expression."""
    return df.withColumns({c: F.when(F.col("contract").isNotNull(), F.col(c)) for c in METRICS})


def customer_profile(
    sessions: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    *,
    drop_null_contract: bool = True,
    with_size: bool = False,
    non_negative: bool = False,
) -> DataFrame:
    """One row per contract: category totals, most-watched, taste and activeness.

    One scan and two aggregates, (contract, day) and then contract, both partial before
    their shuffle; no join, window or sort. ``with_size`` adds the number of sessions.

    ``non_negative`` promises durations of zero or more. A day is then active as soon as one
    session is positive, so active days fit in a bit set and a single aggregate by contract
    remains: one shuffle, of one row per contract and map task. A negative duration or a day
    outside the period fails the job rather than giving another result. For periods up to
    about a year, at 63 days per extra column.
    """
    if drop_null_contract:
        sessions = sessions.where(F.col("contract").isNotNull())
    if non_negative:
        marks = DayMarks(start, end)
        marked = sessions.groupBy("contract").agg(
            *category_sums(), seen_categories(), F.count("*").alias("n_sessions"), *marks.aggregates()
        )
        per_contract = marked.withColumn("active_days", marks.count())
    else:
        per_contract = (
            day_facts(sessions)
            .groupBy("contract")
            .agg(
                *[F.sum(c).alias(c) for c in DURATION_COLUMNS],
                F.bit_or("seen").alias("seen"),
                F.sum("is_active").alias("active_days"),
                F.sum("n_sessions").alias("n_sessions"),
            )
        )
    profile = per_contract.withColumns(_profile_columns(days_between(start, end)))
    if not drop_null_contract:
        profile = _without_metrics_for_null_contract(profile)
    return profile.select("contract", *DURATION_COLUMNS, *METRICS, *(["n_sessions"] if with_size else []))


def customer_profile_joined(
    sessions: DataFrame, start: str | dt.date, end: str | dt.date, *, drop_null_contract: bool = True
) -> DataFrame:
    """The same rows composed from the separate metrics by left joins.

    ``sessions`` is read once per metric: hand in stored daily totals, whose sums are the
    log's (``as_sessions``).
    """
    known = sessions.where(F.col("contract").isNotNull())
    wide = pivot(known if drop_null_contract else sessions)
    joined = attach(
        wide,
        metrics.most_watched(known),
        metrics.customer_taste(wide),
        metrics.activeness(known, start, end),
    )
    return joined.select("contract", *DURATION_COLUMNS, *METRICS)


def daily_profile(
    sessions: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    *,
    drop_null_contract: bool = True,
) -> DataFrame:
    """One row per contract and day: the day's totals plus the contract's metrics.

    The metrics come from a window over the contract's days instead of a join, so the log is
    scanned once. A window group holds at most one row per day of the period.
    """
    if drop_null_contract:
        sessions = sessions.where(F.col("contract").isNotNull())
    over = "OVER (PARTITION BY contract)"
    contract_level = day_facts(sessions).select(
        "contract",
        "log_date",
        F.struct(*DURATION_COLUMNS).alias("day"),
        *[F.expr(f"sum({c}) {over} AS {c}") for c in DURATION_COLUMNS],
        F.expr(f"bit_or(seen) {over} AS seen"),
        F.expr(f"sum(is_active) {over} AS active_days"),
    )
    profile = contract_level.withColumns(_profile_columns(days_between(start, end)))
    if not drop_null_contract:
        profile = _without_metrics_for_null_contract(profile)
    return profile.select("contract", "log_date", "day.*", *METRICS)


def daily_profile_joined(
    sessions: DataFrame, contract_metrics: DataFrame, *, drop_null_contract: bool = True
) -> DataFrame:
    """The same rows by left joins of the metrics to the daily pivot.

    ``contract_metrics`` has one row per contract, so no day is repeated.
    """
    if drop_null_contract:
        sessions = sessions.where(F.col("contract").isNotNull())
    most_watch = contract_metrics.select("contract", "most_watch")
    tastes = contract_metrics.select("contract", "customer_taste")
    active = contract_metrics.select("contract", "active_days", "active_rate")
    joined = attach(pivot_by_day(sessions), most_watch, tastes, active)
    return joined.select("contract", "log_date", *DURATION_COLUMNS, *METRICS)


def session_profile(
    sessions: DataFrame,
    contract_metrics: DataFrame,
    *,
    split_rows: int = SPLIT_ROWS,
    max_hot: int = MAX_HOT_CONTRACTS,
) -> DataFrame:
    """Every session with its contract's metrics; the row count is that of ``sessions``.

    ``contract_metrics`` is ``customer_profile(..., with_size=True)``, read three times here:
    hand in a stored table. Its sizes decide which contracts are split over reducers.
    """
    wanted = contract_metrics.select("contract", *METRICS, "n_sessions")
    return attach_to_sessions(sessions, wanted, split_rows=split_rows, max_hot=max_hot)
