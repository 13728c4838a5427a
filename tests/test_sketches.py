"""Distinct customers and quantiles from stored sketches, against exact counts."""

import random
from bisect import bisect_left, bisect_right

import pytest
from pyspark.sql import functions as F

from teletally.operators import sketches
from teletally.operators.aggregates import category_summary, day_totals
from teletally.plans.sessions import sessions
from teletally.storage import store
from tests.logs import log_frame


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    apps = ["VOD", "KPLUS", "RELAX", "CHILD"]
    days = {
        f"202204{d:02d}": [(f"c{rng.randrange(300) + 20 * d}", rng.choice(apps), rng.randrange(-5, 90)) for _ in range(400)]
        + [(None, "VOD", 5), ("x", "VOD", None)]
        for d in range(1, 11)
    }
    return store(sessions(log_frame(spark, days)), "rows")


@pytest.fixture(scope="module")
def daily(rows):
    return store(sketches.daily_customers(rows), "daily-customers")


def by_category(df):
    return {r.category: (r.contracts, r.total) for r in df.collect()}


@pytest.mark.parametrize("period", [(1, 10), (1, 1), (3, 7), (9, 10), (11, 12)])
def test_every_period_is_exact_below_the_size(rows, daily, period):
    start, end = (f"202204{d:02d}" for d in period)
    within = rows.where(F.date_format("log_date", "yyyyMMdd").between(start, end))
    assert by_category(sketches.customers_by_category(daily, start, end)) == by_category(category_summary(within))


def test_windows(rows, daily):
    found = {(r.category, r.end_date): r.contracts for r in sketches.customers_per_window(daily, "20220402", "20220409", 3).collect()}
    held = [(r.category, r.log_date, r.contract) for r in rows.select("category", "log_date", "contract").collect()]
    ends = sorted({d for _, d, _ in held})[3:9]
    wanted = {}
    for end in ends:
        for category in {c for c, _, _ in held}:
            some = {k for c, d, k in held if c == category and 0 <= (end - d).days < 3 and k is not None}
            wanted[category, end] = len(some)
    assert found == wanted


def test_retention(rows, daily):
    first, second = ("20220401", "20220403"), ("20220408", "20220410")
    held = {}
    for r in rows.collect():
        for name, days in (("a", (1, 3)), ("b", (8, 10))):
            if r.contract is not None and days[0] <= r.log_date.day <= days[1]:
                held.setdefault(r.category, {"a": set(), "b": set()})[name].add(r.contract)
    found = {r.category: tuple(r)[1:] for r in sketches.retention(daily, first, second).collect()}
    assert found == {
        c: (len(s["a"]), len(s["b"]), len(s["a"] & s["b"]), len(s["a"] - s["b"]), len(s["b"] - s["a"]))
        for c, s in held.items()
    }
    # A period without rows.
    gone = {r.category: tuple(r)[1:] for r in sketches.retention(daily, first, ("20230101", "20230102")).collect()}
    assert gone == {c: (len(s["a"]), 0, 0, len(s["a"]), 0) for c, s in held.items()}
    new = {r.category: tuple(r)[1:] for r in sketches.retention(daily, ("20230101", "20230102"), first).collect()}
    assert new == {c: (0, len(s["a"]), 0, 0, len(s["a"])) for c, s in held.items()}


def test_estimates_stay_within_their_error(spark):
    # Ten days of 60,000 customers each, 20,000 new ones a day; sketches of 2**10 hashes.
    days = spark.range(600_000).select(
        F.concat(F.lit("k"), F.col("id") % 60_000 + F.floor(F.col("id") / 60_000) * 20_000).alias("contract"),
        F.lit("TV").alias("category"),
        F.date_add(F.lit("2022-04-01").cast("date"), F.floor(F.col("id") / 60_000).cast("int")).alias("log_date"),
        F.lit(1).cast("bigint").alias("duration"),
    )
    lg = 10
    daily = store(sketches.daily_customers(days, lg=lg), "daily-customers")
    for low, high in ((1, 1), (2, 5), (1, 10)):
        ((_, contracts, total),) = sketches.customers_by_category(daily, f"202204{low:02d}", f"202204{high:02d}", lg=lg).collect()
        exact = 60_000 + (high - low) * 20_000
        assert total == 60_000 * (high - low + 1)
        assert abs(contracts - exact) <= 4 * sketches.relative_error(lg) * exact
    # The approximate form of the category summary has the same kind of error.
    ((_, contracts, _),) = category_summary(days, approximate=True).collect()
    assert abs(contracts - 240_000) <= 4 * 0.05 * 240_000


def test_the_log_is_read_once(rows):
    plan = sketches.daily_customers(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_quantiles_of_periods(rows):
    totals = store(day_totals(rows), "day-totals")
    daily = store(sketches.daily_quantiles(totals), "daily-quantiles")
    fractions = 0.0, 0.1, 1 / 3, 0.5, 2 / 3, 0.99, 1.0
    for low, high in ((1, 10), (4, 6)):
        found = sketches.quantiles_of_period(daily, f"202204{low:02d}", f"202204{high:02d}", fractions).collect()
        values = sorted(r.total for r in totals.collect() if low <= r.log_date.day <= high and r.total is not None)
        assert [r.fraction for r in found] == list(fractions)
        for r in found:
            assert r.n == len(values)
            ranks = bisect_left(values, r.value) / len(values), bisect_right(values, r.value) / len(values)
            assert ranks[0] - r.rank_error <= r.fraction <= ranks[1] + r.rank_error
