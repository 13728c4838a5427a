"""Logs stored by day: calendars that prune, bloom filters that skip, files that are packed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from teletally.plans.calendar import calendar, on_days
from teletally.plans.job import consolidate
from teletally.sinks import write_parquet
from teletally.sinks.compaction import compact, packed_bins, table_files
from teletally.sources import read_parquet_log
from teletally.storage import store
from tests.logs import log_frame, rows_set, write_day

COLUMNS = ("contract", "app_name", "duration", "log_date")


def month(spark, contracts=20):
    days = {f"202204{d:02d}": [(f"c{k}", "VOD", d) for k in range(contracts)] for d in range(1, 31)}
    return log_frame(spark, days)


def scanned(df):
    """Rows that the scans of a plan gave, after it has run."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        counts = [leaves.apply(k).metrics().get("numOutputRows") for k in range(leaves.size())]
        return sum(n.get().value() for n in counts if n.isDefined())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_calendar(spark):
    found = calendar(spark, "20220401", "20220503").collect()
    assert len(found) == 33
    for r in found:
        assert (r.weekday, r.month, r.day) == (r.log_date.isoweekday(), r.log_date.month, r.log_date.day)


def test_only_listed_days_are_read(spark, tmp_path):
    out = str(tmp_path / "log")
    write_parquet(month(spark), out, rebalance=True)
    log = read_parquet_log(spark, out)
    days = store(calendar(spark, "20220401", "20220430"), "calendar")
    found = on_days(log, days.union(days), F.col("weekday") == 7)
    sundays = [dt.date(2022, 4, d) for d in (3, 10, 17, 24)]
    assert rows_set(found, *COLUMNS) == rows_set(log.where(F.col("log_date").isin(sundays)), *COLUMNS)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    # The sessions of four days and the calendar's own rows, not those of thirty days.
    assert scanned(found) <= 4 * 20 + 2 * 30
    assert on_days(log, days, F.lit(False)).count() == 0


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    # Even numbers only, so that the range of every row group holds the odd ones.
    rows = spark.range(20_000).select(
        F.format_string("%07d", F.col("id") * 2).alias("contract"), F.lit("VOD").alias("app_name"),
        F.lit(1).cast("bigint").alias("duration"), F.lit("2022-04-01").cast("date").alias("log_date"),
    )
    counts = {}
    for name, bloom in (("plain", []), ("bloom", ["contract"])):
        out = str(tmp_path / name)
        write_parquet(rows.coalesce(1), out, sort=True, bloom=bloom)
        log = read_parquet_log(spark, out)
        counts[name] = scanned(log.where(F.col("contract") == "0020001"))
        assert log.where(F.col("contract") == "0020002").count() == 1
    assert counts["bloom"] == 0 < counts["plain"]


def test_consolidated_logs_have_them(spark, tmp_path):
    write_day(tmp_path / "log", "20220401.json", [("a", "VOD", 1), ("z", "VOD", 2)])
    out = str(tmp_path / "out")
    consolidate(spark, str(tmp_path / "log"), out, "20220401", "20220401")
    assert scanned(read_parquet_log(spark, out).where(F.col("contract") == "m")) == 0
    assert read_parquet_log(spark, out).count() == 2


def files_by_day(spark, path):
    return {r.log_date.day: r.n for r in table_files(spark, path).groupBy("log_date").agg(F.count("*").alias("n")).collect()}


def test_compaction_packs_days_below_the_fill(spark, tmp_path):
    out = str(tmp_path / "log")
    write_parquet(month(spark, 50).repartition(6), out)
    # One more day that is a single file already.
    single = log_frame(spark, {"20220501": [("only", "VOD", 1)]}).coalesce(1)
    write_parquet(single, out, replace_days=True)
    before, rows = files_by_day(spark, out), rows_set(read_parquet_log(spark, out), *COLUMNS)
    assert min(n for day, n in before.items()) >= 1 and sum(before.values()) > 150
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "log" / "log_date=2022-05-01").iterdir()}
    days = compact(spark, out)
    assert len(days) == 30 and dt.date(2022, 5, 1) not in days
    assert all(r.n == 1 for r in table_files(spark, out).groupBy("log_date").agg(F.count("*").alias("n")).collect())
    assert rows_set(read_parquet_log(spark, out), *COLUMNS) == rows
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "log" / "log_date=2022-05-01").iterdir()} == kept
    assert compact(spark, out) == []


@pytest.mark.parametrize("target", [100, 250, 1000])
def test_bins_hold_about_the_target(spark, target):
    lengths = {1: [10] * 40, 2: [90, 80, 70, 60, 50, 40, 30, 20, 10] * 3, 3: [5000, 10, 10], 4: [300]}
    rows = [(f"f{day}-{k}", n, dt.date(2022, 4, day)) for day, held in lengths.items() for k, n in enumerate(held)]
    files = spark.createDataFrame(rows, "file string, length long, log_date date")
    size = {r[0]: r[1] for r in rows}
    bins, days = {}, {}
    for r in packed_bins(files, target, 0.5).collect():
        bins.setdefault((r.log_date.day, r.bin), []).append(size[r.file])
        days.setdefault(r.log_date.day, set()).add(r.file)
    for day, held in days.items():
        # Whole days, at most half as many bins as files, none far beyond the target.
        assert len(held) == len(lengths[day]) and sum(d == day for d, _ in bins) <= len(held) / 2
    assert all(sum(held) <= target + max(held) for held in bins.values())
    assert 4 not in days


def test_tables_split_a_large_day(spark, tmp_path):
    out = str(tmp_path / "log")
    rows = log_frame(spark, {"20220401": [(f"c{k}", "VOD", k) for k in range(4000)]})
    write_parquet(rows.repartition(12), out)
    total = table_files(spark, out).agg(F.sum("length")).first()[0]
    assert compact(spark, out, target=total // 3) == [dt.date(2022, 4, 1)]
    assert 3 <= files_by_day(spark, out)[1] <= 4
    assert rows_set(read_parquet_log(spark, out), *COLUMNS) == rows_set(rows, *COLUMNS)
