"""Rolling activeness and the segment cube."""

import random

import pytest
from pyspark.sql import functions as F

from teletally.plans import metrics, profiles, segments
from teletally.plans.sessions import sessions
from tests.logs import day, log_frame


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    days = {}
    for m, count in ((4, 30), (5, 31), (6, 30)):
        for d in range(1, count + 1):
            days[f"2022{m:02d}{d:02d}"] = [
                (f"c{rng.randrange(8)}", rng.choice(["VOD", "RELAX"]), rng.choice([None, 0, 0, 5])) for _ in range(4)
            ]
    return sessions(log_frame(spark, days))


@pytest.mark.parametrize("days", [1, 7, 63, 64, 91])
def test_every_window_equals_activeness(rows, days):
    # 91 days are two bit sets, and windows lie across their border.
    found = metrics.rolling_activeness(rows, "20220401", "20220630", days).collect()
    held = {}
    for r in rows.collect():
        if r.duration:
            held.setdefault(r.contract, set()).add(r.log_date)
    contracts = {r.contract for r in rows.collect()}
    assert len(found) == len(contracts) * (92 - days)
    for r in found:
        active = sum(0 <= (r.end_date - d).days < days for d in held.get(r.contract, ()))
        assert (r.active_days, r.active_rate) == (active, active / days)
    # One window by the plain operator.
    first, last = day("20220630").toordinal() - days + 1, day("20220630")
    within = rows.where(F.col("log_date") >= F.lit(type(last).fromordinal(first)))
    plain = {r.contract: r.active_days for r in metrics.activeness(within, type(last).fromordinal(first), last).collect()}
    assert {r.contract: r.active_days for r in found if r.end_date == last and r.contract in plain} == plain


def test_rolling_edges(spark, rows):
    assert metrics.rolling_activeness(rows, "20220401", "20220630", 92).count() == 0
    plan = metrics.rolling_activeness(rows, "20220401", "20220630", 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    negative = sessions(log_frame(spark, {"20220401": [("a", "VOD", -1)]}))
    with pytest.raises(Exception, match="negative duration"):
        metrics.rolling_activeness(negative, "20220401", "20220407", 2).collect()


def test_totals_of_every_face_agree(rows):
    groups = segments.customer_group(profiles.customer_profile(rows, "20220401", "20220630"), 0.3)
    cube = {tuple(r)[:3]: r.customers for r in segments.segment_cube(groups).collect()}
    assert len(cube) == 6 * 33 * 3
    every = groups.count()
    assert cube["All", "All", "All"] == every > 0
    for at in range(3):
        for cell, total in cube.items():
            if cell[at] == "All":
                inside = [n for c, n in cube.items() if c[at] != "All" and c[:at] + c[at + 1 :] == cell[:at] + cell[at + 1 :]]
                assert sum(inside) == total
    held = {tuple(r)[:3]: r.customers for r in segments.segment_counts(groups).collect()}
    assert {c: n for c, n in cube.items() if n and "All" not in c} == held
    plan = segments.segment_cube(groups)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_customers(spark):
    groups = spark.createDataFrame([], "contract string, most_watch string, customer_taste string, active_level string")
    found = segments.segment_cube(groups).collect()
    assert len(found) == 6 * 33 * 3 and all(r.customers == 0 for r in found)
