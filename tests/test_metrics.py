import datetime as dt
import random
from collections import defaultdict

import pytest

from teletally.operators import aggregates, filters, pivots
from teletally.plans import metrics
from teletally.plans.sessions import sessions
from teletally.schema import CATEGORIES, DURATION_COLUMNS, duration_column
from tests.logs import as_dict, log_frame, rows_set

START, END = "20220401", "20220403"


def edge_log(spark):
    """The edge cases of one to three days."""
    return log_frame(
        spark,
        {
            "20220401": [
                ("A", "KPLUS", 10),
                ("A", "KPLUS", 10),
                ("A", "VOD", 5),
                ("A", "VOD", 6),
                ("T", "KPLUS", 5),
                ("T", "VOD", 5),
                ("C", "RELAX", None),
                ("D", "KPLUS", None),
                ("D", "CHILD", None),
                ("E", "DANET", 0),
                ("B", "XX", 8),
                ("B", None, 4),
                ("0", "RELAX", 9),
                (None, "CHILD", 2),
                ("N", "VOD", -5),
                ("N", "RELAX", -7),
                ("N", "KPLUS", 3),
            ],
            "20220402": [("A", "KPlus", 1), ("A", "kplus", 100)],
            "20220403": [("A", "CHANNEL", 0)],
        },
    )


@pytest.fixture
def rows(spark):
    return sessions(edge_log(spark)).where("contract IS NOT NULL")


def test_unmapped_rows_go_and_case_matters(rows):
    assert rows.where("contract = 'B'").count() == 0
    assert rows.where("app_name = 'kplus'").count() == 0


def test_filter_options(spark):
    log = edge_log(spark)
    assert sessions(log).where("contract = '0'").count() == 1
    assert sessions(log, drop_unknown_contract=True).where("contract = '0' OR contract IS NULL").count() == 0
    assert sessions(log, keep_unmapped=True).where("category = 'Error'").count() == 3


def test_pivot_sums_are_not_inflated(rows):
    wide = as_dict(pivots.pivot(rows))
    assert (wide["A"].tv_duration, wide["A"].movie_duration) == (21, 11)
    assert wide["A"].sport_duration is None and "sport_duration" in wide["A"].asDict()
    assert wide["E"].movie_duration == 0
    assert wide["C"].relax_duration is None


def test_pivot_forms_agree(rows):
    wide = rows_set(pivots.pivot(rows))
    by_join = rows_set(pivots.pivot_by_join(aggregates.category_totals(rows)), "contract", *DURATION_COLUMNS)
    merged = rows_set(pivots.merge_partials(pivots.pivot_by_day(rows)))
    assert by_join == wide == merged


def test_partials_are_matched_by_name(spark):
    first = sessions(log_frame(spark, {"20220401": [("A", "VOD", 1), ("A", "KPLUS", 2)]}))
    second = sessions(log_frame(spark, {"20220402": [("A", "RELAX", 10), ("A", "KPLUS", 20)]}))
    merged = pivots.merge_partials(pivots.pivot(first), pivots.pivot(second))
    assert rows_set(merged) == [("A", 10, 1, None, None, 22)]
    short = pivots.pivot(second).select("contract", "tv_duration", "relax_duration")
    assert rows_set(pivots.merge_partials(pivots.pivot(first), short)) == [("A", 10, 1, None, None, 22)]
    with pytest.raises(ValueError, match="sport_duration"):
        pivots.merge_partials(short)


def test_unmapped_column_of_the_one_day_form(spark):
    rows = sessions(edge_log(spark), keep_unmapped=True, drop_unknown_contract=True)
    wide = as_dict(pivots.pivot(rows, with_unmapped=True))
    assert wide["B"].error_duration == 12 and wide["A"].error_duration == 100
    assert "0" not in wide and None not in wide


def test_most_watched_ties_and_nulls(rows):
    found = as_dict(metrics.most_watched(rows), value="most_watch")
    assert found == {"A": "TV", "T": "Movie", "C": "Relax", "D": "Child", "E": "Movie", "0": "Relax", "N": "TV"}


def test_most_watched_grains_differ(spark):
    log = log_frame(
        spark,
        {
            "20220401": [("A", "VOD", 7), ("A", "KPLUS", 4), ("A", "KPLUS", 4), ("A", "RELAX", 5)],
            "20220402": [("A", "RELAX", 5), ("A", "VOD", 1)],
            "20220403": [("A", "RELAX", 5)],
        },
    )
    rows = sessions(log)
    assert as_dict(metrics.most_watched(rows, "total"), value="most_watch") == {"A": "Relax"}
    assert as_dict(metrics.most_watched(rows, "day"), value="most_watch") == {"A": "TV"}
    assert as_dict(metrics.most_watched(rows, "session"), value="most_watch") == {"A": "Movie"}
    with pytest.raises(ValueError):
        metrics.most_watched(rows, "week")


def test_ranked_and_aggregated_most_watched_agree(rows):
    ranked = {
        "total": metrics.most_watched_ranked(aggregates.category_totals(rows), "total"),
        "day": metrics.most_watched_ranked(aggregates.daily_totals(rows), "total"),
        "session": metrics.most_watched_ranked(rows, "duration"),
    }
    for grain, expected in ranked.items():
        assert rows_set(metrics.most_watched(rows, grain)) == rows_set(expected)


def test_taste(rows):
    wide = pivots.pivot(rows)
    found = as_dict(metrics.customer_taste(wide), value="customer_taste")
    assert found["A"] == "Movie-TV" and found["E"] == "Movie" and found["C"] == "" and found["D"] == ""
    spec = as_dict(metrics.customer_taste(wide, nonzero=True), value="customer_taste")
    assert spec["E"] == "" and spec["A"] == "Movie-TV" and spec["N"] == "Relax-Movie-TV"
    labels = as_dict(metrics.presence_labels(wide))
    assert (labels["A"].movie, labels["A"].tv, labels["A"].child) == ("Movie", "TV", None)


def test_activeness(rows):
    found = as_dict(metrics.activeness(rows, START, END))
    assert (found["A"].active_days, found["A"].active_rate) == (2, 2 / 3)
    assert found["A"].active_percent == 66.67
    for idle in "CDEN":
        assert found[idle].active_days == 0
    long_period = as_dict(metrics.activeness(rows, "20220401", "20220430"))
    assert long_period["A"].active_rate == 2 / 30


def test_activeness_forms_differ_only_on_negative_durations(rows):
    by_total = as_dict(metrics.activeness(rows, START, END), value="active_days")
    by_any = as_dict(metrics.activeness_from_pivot(rows, START, END), value="active_days")
    assert by_any.pop("N") == 1 and by_total.pop("N") == 0
    assert by_any == by_total


def test_dedup_and_duplicates(rows):
    once = filters.without_repeats(rows)
    assert as_dict(pivots.pivot(once))["A"].tv_duration == 11
    assert as_dict(aggregates.repeated(rows), value="n_rows") == {"A": 6, "T": 2, "D": 2, "N": 3}


def test_category_summary(spark, rows):
    exact = as_dict(aggregates.category_summary(rows), "category")
    assert (exact["TV"].contracts, exact["TV"].total) == (4, 29)
    about = as_dict(aggregates.category_summary(rows, approximate=True), "category")
    assert {c: about[c].contracts for c in about} == {c: exact[c].contracts for c in exact}


def test_sort_is_global_and_total(spark, rows):
    ordered = filters.by_contract(rows.repartition(5).select("contract", "category", "duration"))
    found = [tuple(r) for r in ordered.collect()]
    assert found == sorted(found, key=lambda r: (r[0], r[1], (r[2] is not None, r[2] or 0)))


def test_top_contracts_breaks_ties_by_contract(spark):
    totals = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "contract string, total long")
    assert [r.contract for r in filters.top_contracts(totals, 3).collect()] == ["c", "a", "b"]


def test_small_filters(spark, rows):
    assert filters.category_slice(rows, "Child").count() == 1
    assert filters.of_contract(rows, "A").count() == 6
    assert filters.in_period(rows, "20220402", "20220403").count() == 2
    stamped = filters.stamp_day(pivots.pivot(rows), "20220401")
    assert stamped.select("log_date").distinct().collect() == [(dt.date(2022, 4, 1),)]


def test_against_plain_python(spark):
    """Random log, metrics recomputed row by row."""
    rng = random.Random(7)
    codes = ["KPLUS", "VOD", "RELAX", "CHILD", "SPORT", "XX", None]
    names = dict(zip(codes, ["TV", "Movie", "Relax", "Child", "Sport"], strict=False))
    days = [f"2022040{d}" for d in range(1, 6)]
    log = {
        d: [
            (f"c{min(rng.randrange(30), rng.randrange(30))}", rng.choice(codes), rng.choice([None, 0, 0, 1, 2, 3, 60]))
            for _ in range(120)
        ]
        for d in days
    }
    rows = sessions(log_frame(spark, log))

    totals, seen, by_day = defaultdict(dict), defaultdict(set), defaultdict(lambda: defaultdict(int))
    for d, listed in log.items():
        for contract, app, n in listed:
            if app not in names:
                continue
            seen[contract].add(names[app])
            by_day[contract][d] += n or 0
            if n is not None:
                totals[contract][names[app]] = totals[contract].get(names[app], 0) + n

    wide = as_dict(pivots.pivot(rows))
    top = as_dict(metrics.most_watched(rows), value="most_watch")
    taste = as_dict(metrics.customer_taste(pivots.pivot(rows)), value="customer_taste")
    active = as_dict(metrics.activeness(rows, days[0], days[-1]), value="active_days")
    assert set(wide) == set(seen)
    for contract, categories in seen.items():
        found = totals[contract]
        assert [wide[contract][duration_column(c)] for c in CATEGORIES] == [found.get(c) for c in CATEGORIES]
        best = max(
            (c for c in CATEGORIES if c in categories),
            key=lambda c: (c in found, found.get(c, 0), -CATEGORIES.index(c)),
        )
        assert top[contract] == best
        assert taste[contract] == "-".join(c for c in CATEGORIES if c in found)
        assert active[contract] == sum(v > 0 for v in by_day[contract].values())
