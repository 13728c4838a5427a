"""Row filters and projections; none changes the grain."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teletally.functions.categories import has_category
from teletally.functions.dates import parse_day
from teletally.schema import ERROR, UNKNOWN_CONTRACT, CategoryCodes


def known_contracts(df: DataFrame) -> DataFrame:
    """Without the catch-all contract; a NULL contract is dropped as well."""
    return df.where(F.col("contract") != UNKNOWN_CONTRACT)


def mapped(df: DataFrame, codes: CategoryCodes | None = None) -> DataFrame:
    """Rows whose app code has a category.

    With ``codes`` the test is made on the stored app code, so that the scan can skip row groups.
    """
    if codes is not None:
        return df.where(has_category(F.col("app_name"), codes))
    return df.where(F.col("category") != ERROR)


def category_slice(df: DataFrame, category: str, codes: CategoryCodes | None = None) -> DataFrame:
    """Rows of one category; with ``codes`` tested on the stored app code as well, as in ``mapped``."""
    if codes is not None:
        df = df.where(F.col("app_name").isin(*codes.get(category, ())))
    return df.where(F.col("category") == category)


def in_period(df: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Rows of an inclusive date range."""
    return df.where(F.col("log_date").between(F.lit(parse_day(start)), F.lit(parse_day(end))))


def of_contract(df: DataFrame, contract: str) -> DataFrame:
    """Rows of one customer."""
    return df.where(F.col("contract") == contract)


def session_columns(df: DataFrame) -> DataFrame:
    """Only the columns the metrics need."""
    return df.select("contract", "category", "duration", "log_date")


def stamp_day(df: DataFrame, day: str | dt.date) -> DataFrame:
    """One date on every row of a result."""
    return df.withColumn("log_date", F.lit(parse_day(day)))


def union_days(*days: DataFrame) -> DataFrame:
    """Row sets of several days on top of each other, matched by column name."""
    return reduce(DataFrame.unionByName, days)


def without_repeats(sessions: DataFrame) -> DataFrame:
    """One row per (contract, category, duration, day). Merges genuine equal sessions too."""
    return session_columns(sessions).dropDuplicates()


def by_contract(df: DataFrame) -> DataFrame:
    """Globally sorted by contract.

    The remaining columns follow as minor keys: the order is then total, and the range
    partitioner can cut inside a contract that holds a large share of the rows.
    """
    return df.orderBy("contract", *[c for c in df.columns if c != "contract"])


def top_contracts(totals: DataFrame, n: int) -> DataFrame:
    """The ``n`` contracts with the largest total; ties by contract."""
    return totals.orderBy(F.desc("total"), "contract").limit(n)
