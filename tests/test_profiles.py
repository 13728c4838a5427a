import datetime as dt

import pytest

from teletally.operators import aggregates, joins, pivots
from teletally.plans import metrics, profiles, segments
from teletally.plans.job import build_profile, run
from teletally.plans.sessions import sessions
from teletally.schema import DURATION_COLUMNS, profile_schema
from teletally.storage import store_by_contract
from tests.logs import as_dict, log_frame, rows_set, write_day
from tests.test_metrics import END, START, edge_log


@pytest.fixture
def rows(spark):
    return sessions(edge_log(spark))


def test_profile_equals_the_composition(rows):
    single = profiles.customer_profile(rows, START, END)
    assert rows_set(single) == rows_set(profiles.customer_profile_joined(rows, START, END))
    days = aggregates.as_sessions(aggregates.daily_totals(rows))
    assert rows_set(single) == rows_set(profiles.customer_profile_joined(days, START, END))
    assert rows_set(single) == rows_set(profiles.customer_profile(days, START, END))
    assert single.schema == profile_schema() or single.columns == profile_schema().fieldNames()


def test_one_row_per_contract_and_totals_match(rows):
    profile = profiles.customer_profile(rows, START, END)
    assert aggregates.repeated(profile).count() == 0
    listed = as_dict(profile)
    total = sum(row[c] or 0 for row in listed.values() for c in DURATION_COLUMNS)
    assert total == rows.where("contract IS NOT NULL").agg({"duration": "sum"}).first()[0]


def test_daily_profile_does_not_fan_out(spark):
    log = log_frame(spark, {f"2022040{d}": [("A", "VOD", d), ("A", "KPLUS", 1)] for d in (1, 2, 3)})
    rows = sessions(log)
    daily = profiles.daily_profile(rows, START, END)
    assert daily.count() == 3
    assert {r.movie_duration for r in daily.collect()} == {1, 2, 3}
    assert {(r.most_watch, r.customer_taste, r.active_days, r.active_rate) for r in daily.collect()} == {
        ("Movie", "Movie-TV", 3, 1.0)
    }


def test_daily_profile_forms_agree(rows):
    known = rows.where("contract IS NOT NULL")
    contract_metrics = profiles.customer_profile(known, START, END)
    daily = profiles.daily_profile(rows, START, END)
    assert rows_set(daily) == rows_set(profiles.daily_profile_joined(known, contract_metrics))
    assert daily.count() == pivots.pivot_by_day(known).count()


def test_null_contract(rows):
    assert None not in as_dict(profiles.customer_profile(rows, START, END))
    kept = as_dict(profiles.customer_profile(rows, START, END, drop_null_contract=False))[None]
    assert kept.child_duration == 2
    assert [kept[c] for c in profiles.METRICS] == [None] * 4
    metrics = profiles.customer_profile(rows, START, END)
    for drop, without in ((False, 1), (True, 0)):
        daily = profiles.daily_profile(rows, START, END, drop_null_contract=drop)
        assert rows_set(daily) == rows_set(profiles.daily_profile_joined(rows, metrics, drop_null_contract=drop))
        assert daily.where("contract IS NULL").count() == without


def test_session_profile_keeps_every_row(rows):
    sized = profiles.customer_profile(rows, START, END, with_size=True)
    found = profiles.session_profile(rows, sized)
    assert found.count() == rows.count()
    assert rows_set(found, *rows.columns) == rows_set(rows)
    plain = joins.attach(rows, sized.select("contract", *profiles.METRICS))
    assert rows_set(found, *plain.columns) == rows_set(plain)
    assert found.where("contract IS NULL AND most_watch IS NULL").count() == 1


def skewed(spark):
    """A third of the rows is one contract, most of them equal; some have no contract."""
    listed = [("hot", "VOD", 5)] * 900 + [("hot", "KPLUS", n) for n in range(100)]
    listed += [(None, "VOD", 1)] * 300
    listed += [(f"c{i % 400}", "SPORT", i) for i in range(1700)]
    return sessions(log_frame(spark, {"20220401": listed})).repartition(16)


def test_large_contracts_are_split(spark):
    rows = skewed(spark)
    sized = profiles.customer_profile(rows, START, START, with_size=True)
    plain = joins.attach(rows, sized.select("contract", *profiles.METRICS))
    split = profiles.session_profile(rows, sized, split_rows=50)
    assert rows_set(split, *plain.columns) == rows_set(plain)


def test_a_hot_contract_reaches_many_reducers(spark):
    rows = skewed(spark).select("contract", "category", "duration", "log_date")
    sized = profiles.customer_profile(rows, START, START, with_size=True).checkpoint()
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        split = profiles.session_profile(rows, sized, split_rows=50)
        where = split.selectExpr("contract", "spark_partition_id() AS p").groupBy("contract", "p").count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    hot = [r["count"] for r in where if r.contract == "hot"]
    none = [r["count"] for r in where if r.contract is None]
    assert sum(hot) == 1000 and len(hot) >= 6 and max(hot) < 500
    assert sum(none) == 300 and len(none) >= 4


def test_the_number_of_split_contracts_is_bounded(spark):
    """With at most four large contracts allowed, those above a quarter of the rows are split."""
    rows = skewed(spark)
    sized = profiles.customer_profile(rows, START, START, with_size=True)
    split = profiles.session_profile(rows, sized, split_rows=1, max_hot=4)
    plain = joins.attach(rows, sized.select("contract", *profiles.METRICS))
    assert rows_set(split, *plain.columns) == rows_set(plain)


def test_groups_and_segments(spark):
    log = log_frame(
        spark,
        {
            "20220401": [("A", "VOD", 9), ("A", "KPLUS", 1), ("B", "VOD", 9), ("B", "KPLUS", 2), ("C", "SPORT", 1)],
            "20220402": [("A", "VOD", 9), ("B", "VOD", 9)],
        },
    )
    profile = profiles.customer_profile(sessions(log), "20220401", "20220402")
    groups = segments.customer_group(profile, 0.8)
    assert as_dict(groups, value="customer_group") == {
        "A": "Movie , Movie-TV , High",
        "B": "Movie , Movie-TV , High",
        "C": "Sport , Sport , Low",
    }
    assert rows_set(segments.segment_counts(groups)) == [("Movie", "Movie-TV", "High", 2), ("Sport", "Sport", "Low", 1)]
    assert rows_set(segments.segment_dimensions(groups)) == [(2, 2, 2, 3)]


def test_engagement(spark):
    totals = spark.createDataFrame([(str(i), i) for i in range(1, 10)], "contract string, total long")
    levels = as_dict(metrics.engagement_levels(totals, 3, 7), value="engagement_type")
    assert [levels[str(i)] for i in range(1, 10)] == ["low"] * 2 + ["normal"] * 4 + ["high"] * 3
    by_quantile = as_dict(metrics.engagement_by_quantile(totals), value="engagement_type")
    assert sorted(by_quantile.values()) == ["high"] * 3 + ["low"] * 3 + ["normal"] * 3


def test_job_over_files(spark, tmp_path):
    write_day(tmp_path, "20220401.json", [("A", "VOD", 5), ("A", "VOD", 5), ("0", "VOD", 1), (None, "VOD", 2)])
    write_day(tmp_path, "20220403.json", [("A", "KPLUS", 1)])
    profile = as_dict(run(spark, str(tmp_path), START, END))
    assert profile["A"].movie_duration == 10 and profile["A"].active_rate == 2 / 3
    assert set(profile) == {"A", "0"}
    assert as_dict(run(spark, str(tmp_path), START, END, dedup=True))["A"].movie_duration == 5
    assert set(as_dict(run(spark, str(tmp_path), START, END, drop_unknown_contract=True))) == {"A"}
    daily = run(spark, str(tmp_path), START, END, grain="day")
    assert {r.log_date for r in daily.collect()} == {dt.date(2022, 4, 1), dt.date(2022, 4, 3)}
    assert run(spark, str(tmp_path), START, END, grain="session").count() == 4
    assert run(spark, str(tmp_path), START, END, grain="session", drop_null_contract=False).count() == 5
    with pytest.raises(ValueError):
        run(spark, str(tmp_path), START, END, grain="week")


@pytest.mark.parametrize("grain", ["customer", "day", "session"])
def test_empty_range(spark, tmp_path, grain):
    write_day(tmp_path, "20220401.json", [("A", "VOD", 5)])
    empty = run(spark, str(tmp_path), "20230101", "20230102", grain=grain)
    assert empty.count() == 0 and "most_watch" in empty.columns


def test_build_profile_accepts_any_log(spark):
    log = log_frame(spark, {"20220401": [("A", "x", 5)]})
    profile = build_profile(log, START, END, codes={"TV": ["x"]})
    assert as_dict(profile)["A"].tv_duration == 5


def test_one_shuffle_forms_agree(spark):
    listed = {
        day: [(f"c{i % 17}", app, (i * k) % 5) for i, app in enumerate(["VOD", "KPLUS", "CHILD", "XX"] * 30)]
        for k, day in enumerate(["20220101", "20220304", "20220305", "20220306", "20220601"])
    }
    listed["20220304"] += [("c1", "VOD", None), ("n", "SPORT", None)]
    rows, period = sessions(log_frame(spark, listed)), ("20220101", "20220601")
    assert rows_set(profiles.customer_profile(rows, *period, non_negative=True)) == rows_set(
        profiles.customer_profile(rows, *period)
    )
    assert rows_set(metrics.activeness_by_marks(rows, *period)) == rows_set(metrics.activeness(rows, *period))


def test_one_shuffle_form_refuses_what_it_cannot_count(spark):
    rows = sessions(log_frame(spark, {"20220401": [("A", "VOD", 5), ("A", "VOD", -1)]}))
    with pytest.raises(Exception, match="negative duration"):
        profiles.customer_profile(rows, START, END, non_negative=True).collect()
    with pytest.raises(Exception, match="outside the period"):
        metrics.activeness_by_marks(rows.where("duration > 0"), "20220402", "20220403").collect()


def test_totals_stored_by_contract(spark, rows):
    known = rows.where("contract IS NOT NULL")
    stored = aggregates.as_sessions(store_by_contract(aggregates.daily_totals(known), "totals", 3))
    joined = profiles.customer_profile_joined(stored, START, END)
    assert rows_set(joined) == rows_set(profiles.customer_profile(rows, START, END))
    daily = profiles.daily_profile(stored, START, END)
    assert "Exchange" not in daily._jdf.queryExecution().executedPlan().toString()
    assert rows_set(daily) == rows_set(profiles.daily_profile(rows, START, END))
