"""Categories as columns.

The category list is fixed, so a category without rows still has its column and frames of
different days always match.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teletally.operators.aggregates import sum_numeric
from teletally.operators.filters import category_slice
from teletally.schema import CATEGORIES, DURATION_COLUMNS, ERROR, duration_column


def category_sums(*, with_unmapped: bool = False) -> list[Column]:
    """One conditional sum per category, NULL where the category has no rows."""
    categories = (*CATEGORIES, ERROR) if with_unmapped else CATEGORIES
    return [
        F.expr(f"sum(CASE WHEN category = '{c}' THEN duration END) AS {duration_column(c)}") for c in categories
    ]


def pivot_totals(sessions: DataFrame, *keys: str, with_unmapped: bool = False) -> DataFrame:
    """One total per key and category; NULL where the category has no rows.

    Conditional sums: one shuffle on the keys, and no job to discover the categories.
    ``with_unmapped`` adds a column for the rows of unmapped apps.
    """
    return sessions.groupBy(*keys).agg(*category_sums(with_unmapped=with_unmapped))


def pivot(sessions: DataFrame, *, with_unmapped: bool = False) -> DataFrame:
    """Contract grain."""
    return pivot_totals(sessions, "contract", with_unmapped=with_unmapped)


def pivot_by_day(sessions: DataFrame, *, with_unmapped: bool = False) -> DataFrame:
    """Grain (contract, day)."""
    return pivot_totals(sessions, "contract", "log_date", with_unmapped=with_unmapped)


def merge_partials(*partials: DataFrame) -> DataFrame:
    """Contract-grain pivot out of pivots of parts of the log (days, or stored earlier runs).

    Matched by name and summed; columns a part does not have count as NULL.
    """
    wanted = [part.select("contract", *[c for c in DURATION_COLUMNS if c in part.columns]) for part in partials]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), wanted)
    missing = [c for c in DURATION_COLUMNS if c not in merged.columns]
    if missing:
        raise ValueError(f"no part has {missing}")
    return sum_numeric(merged, "contract").select("contract", *DURATION_COLUMNS)


def pivot_by_join(category_totals: DataFrame) -> DataFrame:
    """The contract-grain pivot as a chain of joins over category slices.

    ``category_totals`` is already one row per (contract, category), so a join never meets
    two rows of one contract and nothing is counted twice. Every slice is joined to the list
    of all contracts, not to the slices before it: a left join keeps the partitioning that a
    full outer one loses, so a table stored by contract is never shuffled. A join does not
    match rows without a contract; they are one row, summed by itself. ``pivot`` gives the
    same result with a single shuffle; this form is for slices that already exist as tables.
    """
    known = category_totals.where(F.col("contract").isNotNull())
    slices = [
        category_slice(known, c).select("contract", F.col("total").alias(duration_column(c))) for c in CATEGORIES
    ]
    joined = reduce(lambda a, b: a.join(b, "contract", "left"), slices, known.select("contract").distinct())
    unknown = category_totals.where(F.col("contract").isNull()).withColumnRenamed("total", "duration")
    return joined.unionByName(pivot(unknown))
