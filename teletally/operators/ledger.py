"""Contract totals from which days can be taken out again.

Per contract and category the ledger holds how many rows there were, how many of them had a duration, and its sum;
beside them the number of active days. All are plain sums over days, so a day is added or retracted by adding or
subtracting its own part, in any order and without reading another day. Bit sets of categories seen could
not be undone; counts can, and the rules for NULL follow from them: a category is there while it has rows,
and its total is NULL while none of them has a duration.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teletally.functions.dates import days_between
from teletally.plans.profiles import METRICS, _profile_columns
from teletally.schema import CATEGORIES, DURATION_COLUMNS, duration_column


def _columns(category: str) -> tuple[str, str, str]:
    """Ledger columns of a category: rows, rows with a duration, sum of the durations."""
    name = category.lower()
    return f"{name}_rows", f"{name}_known", f"{name}_sum"


COUNTED = (*[c for category in CATEGORIES for c in _columns(category)], "active_days")


def day_parts(sessions: DataFrame) -> DataFrame:
    """Grain (contract, day): what each day adds to the ledger.

    Rows without a contract are left out. Only mapped categories count.
    """
    sums: list[Column] = []
    for category in CATEGORIES:
        rows, known, total = _columns(category)
        of = F.col("category") == category
        sums += [
            F.count_if(of).alias(rows),
            F.count_if(of & F.col("duration").isNotNull()).alias(known),
            F.coalesce(F.sum(F.when(of, F.col("duration"))), F.lit(0)).alias(total),
        ]
    known = sessions.where(F.col("contract").isNotNull() & F.col("category").isin(*CATEGORIES))
    parts = known.groupBy("contract", "log_date").agg(*sums)
    total = reduce(lambda a, b: a + b, [F.col(_columns(c)[2]) for c in CATEGORIES])
    return parts.withColumn("active_days", F.when(total > 0, F.lit(1)).otherwise(0).cast("bigint"))


def ledger(parts: DataFrame) -> DataFrame:
    """Grain (contract): the sums of day parts. One aggregate, partial before its shuffle."""
    return parts.groupBy("contract").agg(*[F.sum(c).alias(c) for c in COUNTED])


def merged(*ledgers: DataFrame) -> DataFrame:
    """The ledger of all days of several ledgers; contracts without a row left are gone."""
    wanted = [part.select("contract", *COUNTED) for part in ledgers]
    found = ledger(reduce(lambda a, b: a.unionByName(b), wanted))
    return found.where(" + ".join(_columns(c)[0] for c in CATEGORIES) + " <> 0")


def negated(of: DataFrame) -> DataFrame:
    """What retracts a ledger or day parts when it is merged."""
    return of.select("contract", *[(-F.col(c)).alias(c) for c in COUNTED])


def retracted(whole: DataFrame, gone: DataFrame) -> DataFrame:
    """A ledger without the days of another one.

    Days that were never added make counts negative, which ``profile_of`` refuses.
    """
    return merged(whole, negated(gone))


def profile_of(whole: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """The customer profile of a ledger, as ``customer_profile`` gives it for the sessions of its days."""
    fewest = F.least(*[F.col(_columns(c)[k]) for c in CATEGORIES for k in (0, 1)], F.col("active_days"))
    refused = F.raise_error(F.lit("the ledger has lost more than was added to it")).cast("int")
    whole = whole.where(F.when(fewest < 0, refused).otherwise(1) == 1)
    seen = reduce(
        lambda a, b: a.bitwiseOR(b),
        [F.when(F.col(_columns(c)[0]) > 0, F.lit(1 << k)).otherwise(0) for k, c in enumerate(CATEGORIES)],
    )
    durations = {duration_column(c): F.when(F.col(_columns(c)[1]) > 0, F.col(_columns(c)[2])) for c in CATEGORIES}
    wide = whole.select("contract", "active_days", seen.alias("seen"), *[v.alias(k) for k, v in durations.items()])
    return wide.withColumns(_profile_columns(days_between(start, end))).select("contract", *DURATION_COLUMNS, *METRICS)
