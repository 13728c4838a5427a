"""Sums, counts and distinct rows.

Sums run as partial hash aggregates before the shuffle, so a contract that holds a large
share of the rows reaches the reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from teletally.functions.scores import active_total


def totals(sessions: DataFrame, *keys: str) -> DataFrame:
    """Total duration per key tuple, as ``total``."""
    return sessions.groupBy(*keys).agg(F.sum("duration").alias("total"))


def category_totals(sessions: DataFrame) -> DataFrame:
    """Grain (contract, category)."""
    return totals(sessions, "contract", "category")


def daily_totals(sessions: DataFrame) -> DataFrame:
    """Grain (contract, category, day): the stored fact an incremental run merges."""
    return totals(sessions, "contract", "category", "log_date")


def day_totals(sessions: DataFrame) -> DataFrame:
    """Grain (contract, day)."""
    return totals(sessions, "contract", "log_date")


def as_sessions(stored_totals: DataFrame) -> DataFrame:
    """Stored totals presented as sessions: every sum over them equals the sum over the log."""
    return stored_totals.withColumnRenamed("total", "duration")


def category_summary(sessions: DataFrame, *, approximate: bool = False) -> DataFrame:
    """Distinct contracts and total duration per category.

    The exact count first reduces to (category, contract), spread over all reducers;
    ``approximate`` replaces that shuffle by a fixed-size sketch per category.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    return sessions.groupBy("category").agg(
        count(F.col("contract")).alias("contracts"), F.sum("duration").alias("total")
    )


def sum_numeric(df: DataFrame, *keys: str) -> DataFrame:
    """Sum of every numeric column that is not a key, under its own name."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in keys]
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in numeric])


def active_days(sessions: DataFrame) -> DataFrame:
    """Days with a positive total, per contract: daily sums, then a sum of daily flags."""
    flagged = day_totals(sessions).select("contract", active_total(F.col("total")).alias("is_active"))
    return flagged.groupBy("contract").agg(F.sum("is_active").alias("active_days"))


def repeated(df: DataFrame, keys: Sequence[str] = ("contract",)) -> DataFrame:
    """Keys on more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def mapping_audit(sessions: DataFrame) -> DataFrame:
    """Distinct (app code, category) pairs."""
    return sessions.select("app_name", "category").distinct()
