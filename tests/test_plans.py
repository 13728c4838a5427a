"""Shape of the physical plans: what is scanned, and how often rows are shuffled."""

import re

import pytest

from teletally import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.all_queries()


def plan(spark, key):
    return QUERIES[key](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single)", text))


@pytest.mark.parametrize(
    ("key", "expected"),
    [
        ("categorize_isin", 0),
        ("categorize_dim", 0),
        ("pivot_category", 1),
        ("most_watch_max_by", 1),
        ("most_watch_session", 1),
        ("customer_profile_one_shuffle", 1),
        ("activeness_one_shuffle", 1),
        ("customer_profile", 2),
        ("customer_group", 2),
        ("daily_profile", 2),
        ("activeness", 2),
        ("incremental_profile", 2),
        ("customer_profile_join", 0),
        ("daily_profile_join", 0),
        ("merge_partials", 1),
        ("merge_partials_orders", 1),
        ("pivot_by_join", 0),
        ("pivot_by_join_orders", 0),
    ],
)
def test_number_of_shuffles(spark, key, expected):
    assert shuffles(plan(spark, key)) == expected


@pytest.mark.parametrize("key", ["pivot_category", "customer_profile", "daily_profile", "customer_group", "activeness"])
def test_one_scan(spark, key):
    assert plan(spark, key).count("FileScan") == 1


def test_only_needed_columns_and_rows_are_read(spark):
    text = plan(spark, "pivot_category")
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in text
    assert "PushedFilters: [In(event_type" in text
    assert "GreaterThanOrEqual(ts" in plan(spark, "date_range")


def pushed(spark, key):
    return re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan(spark, key))[1]


def test_small_filters_reach_the_scan(spark):
    assert "EqualTo(user_id,7)" in pushed(spark, "contract_lookup")
    assert "EqualTo(event_type,view)" in pushed(spark, "category_slice")
    assert "click" not in pushed(spark, "category_slice")
    assert "In(event_type" in pushed(spark, "filter_mapped")


# A sketch is no fixed-width buffer: these unite the few stored sketches of a period, and nothing else may.
SKETCHES = {"retention", "rolling_customers", "sketched_summary", "sketched_summary_orders", "total_quantiles"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_join_and_no_sort_based_aggregate(spark, key):
    text = plan(spark, key)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate", "Python"):
        assert unwanted not in text
    assert ("ObjectHashAggregate" in text) == (key in SKETCHES)
