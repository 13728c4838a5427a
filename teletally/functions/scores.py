"""Metric formulas over the fixed category columns.

Written as SQL expressions: a formula over five categories is one call into Spark's parser
instead of some dozens of column calls.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from teletally.schema import CATEGORIES, duration_column


def _bit(category: str) -> int:
    return 1 << CATEGORIES.index(category)


def seen_categories() -> Column:
    """Aggregate: bit set of the categories that occur, as ``seen``.

    It tells a category without rows from one whose durations are all NULL, at the price of
    one small column in the shuffle instead of five.
    """
    bits = " ".join(f"WHEN '{c}' THEN {_bit(c)}" for c in CATEGORIES)
    return F.expr(f"bit_or(CASE category {bits} END) AS seen")


def top_category(value: Callable[[str], str] = duration_column) -> Column:
    """Category with the largest value, as one expression without sort or window.

    ``value`` names the column of a category; ``seen`` says which categories occur. A tie goes
    to the earlier category in the fixed order. A category that occurs with a NULL value ranks
    last but still counts; one that does not occur never does.
    """
    ranked = [
        f"CASE WHEN seen & {_bit(c)} <> 0 THEN named_struct('v', {value(c)}, 'o', {-order}, 'c', '{c}') END"
        for order, c in enumerate(CATEGORIES)
    ]
    return F.expr(f"greatest({', '.join(ranked)}).c")


def _presence(category: str, nonzero: bool) -> str:
    test = "<> 0" if nonzero else "IS NOT NULL"
    return f"CASE WHEN {duration_column(category)} {test} THEN '{category}' END"


def presence_label(category: str, nonzero: bool = False) -> Column:
    """The category's label where its duration is there (or is not zero), else NULL."""
    return F.expr(_presence(category, nonzero))


def taste(nonzero: bool = False) -> Column:
    """Labels of the watched categories in fixed order, joined with ``-``."""
    return F.expr(f"concat_ws('-', {', '.join(_presence(c, nonzero) for c in CATEGORIES)})")


def active_any() -> Column:
    """1 when any category has a positive duration, else 0."""
    tests = " OR ".join(f"{duration_column(c)} > 0" for c in CATEGORIES)
    return F.expr(f"CASE WHEN {tests} THEN 1 ELSE 0 END")


def active_sum() -> Column:
    """1 when the categories sum up to a positive duration, else 0."""
    total = " + ".join(f"coalesce({duration_column(c)}, 0)" for c in CATEGORIES)
    return F.expr(f"CASE WHEN {total} > 0 THEN 1 ELSE 0 END")


def active_total(total: Column) -> Column:
    """1 when the day's total is positive, else 0."""
    return F.when(total > 0, 1).otherwise(0)


def active_rate(active_days: Column, days: int) -> Column:
    """Share of the requested period on which the customer was active."""
    return active_days.cast("double") / F.lit(days)


def active_percent(active_days: Column, days: int) -> Column:
    """The same share in percent."""
    return F.round(F.lit(100) * active_days.cast("double") / F.lit(days), 2)


def activity_level(rate: Column, threshold: float) -> Column:
    """``High`` from ``threshold`` on, else ``Low``."""
    return F.when(rate >= threshold, "High").otherwise("Low")


def engagement_type(total: Column, low_max: Column, high_min: Column) -> Column:
    """``low`` below ``low_max``, ``high`` from ``high_min`` on, else ``normal``."""
    return F.when(total >= high_min, "high").when(total >= low_max, "normal").when(total.isNotNull(), "low")
