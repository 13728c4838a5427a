"""Broken lines set aside, and counts gathered while the job writes."""

import pytest
from pyspark.sql import types as T

from teletally.sources import quarantine
from teletally.sources.quarantine import LogCounts, broken_lines, consolidate_checked, good_rows
from tests.logs import line, rows_set, write_day

PERIOD = "20220401", "20220430"


def fill(folder):
    write_day(
        folder,
        "20220401.json",
        [("A", "VOD", 1), ("B", "XX", 2), (None, "KPLUS", 3), ("C", None, None)],
        extra='{"_source":{"Contract":"D"\nnot json at all\n\n[1, 2]\n',
    )
    write_day(folder, "20220402.json", [("A", "VOD", "12"), ("A", "VOD", "x1"), ("E", "VOD", 1.5)], extra="{}\n")
    write_day(folder, "20220403.json", [("A", "SPORT", 7)])
    write_day(folder, "20220501.json", [("A", "SPORT", 7)], extra="broken\n")


def test_rows_and_broken_lines_are_all_lines(spark, tmp_path):
    fill(tmp_path / "log")
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    counts = consolidate_checked(spark, log, out, *PERIOD)
    rows, broken = good_rows(spark, out), broken_lines(spark, out)
    assert counts.lines == rows.count() + broken.count() == 12
    assert (counts.broken, counts.no_json, counts.bad_duration) == (broken.count(), 3, 2)
    # "{}" is a row without anything; so is its app, which makes it unmapped.
    assert counts == LogCounts(lines=12, no_json=3, bad_duration=2, unmapped=3, without_contract=2)
    assert rows_set(rows, "contract", "app_name", "duration", "log_date") == sorted(
        (
            ("A", "VOD", 1, rows_day(1)),
            ("B", "XX", 2, rows_day(1)),
            (None, "KPLUS", 3, rows_day(1)),
            ("C", None, None, rows_day(1)),
            ("A", "VOD", 12, rows_day(2)),
            (None, None, None, rows_day(2)),
            ("A", "SPORT", 7, rows_day(3)),
        ),
        key=str,
    )
    found = {(str(r.log_date), r.reason, r.file.rsplit("/", 1)[1]): r.line for r in broken.collect() if r.reason == "duration"}
    assert set(found) == {("2022-04-02", "duration", "20220402.json")}
    lines = sorted(r.line for r in broken.collect() if r.reason == quarantine.NO_JSON)
    assert lines == sorted(['{"_source":{"Contract":"D"', "not json at all", "[1, 2]"])


def rows_day(number):
    import datetime as dt

    return dt.date(2022, 4, number)


def test_days_read_again_replace_both_kinds(spark, tmp_path):
    fill(tmp_path / "log")
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    consolidate_checked(spark, log, out, *PERIOD)
    write_day(tmp_path / "log", "20220401.json", [("A", "VOD", 1)])
    (tmp_path / "log" / "20220403.json").write_text("nothing good\n")
    counts = consolidate_checked(spark, log, out, "20220401", "20220401")
    assert (counts.lines, counts.broken) == (1, 0)
    assert {str(r.log_date) for r in broken_lines(spark, out).collect()} == {"2022-04-02"}
    consolidate_checked(spark, log, out, "20220403", "20220403")
    assert {str(r.log_date) for r in good_rows(spark, out).collect()} == {"2022-04-01", "2022-04-02"}
    assert [r.line for r in broken_lines(spark, out).collect() if str(r.log_date) == "2022-04-03"] == ["nothing good"]


def test_one_scan_and_no_second_pass(spark, tmp_path):
    fill(tmp_path / "log")
    marked = quarantine.read_marked(spark, str(tmp_path / "log"), *PERIOD)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1 and "Exchange" not in plan
    assert "Contract" in plan and "PartitionFilters" in plan


def test_other_types_and_empty_periods(spark, tmp_path):
    fill(tmp_path / "log")
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    counts = consolidate_checked(spark, log, out, "20220402", "20220402", duration=T.DecimalType(18, 2))
    assert (counts.lines, counts.bad_duration) == (4, 1)
    none = str(tmp_path / "none")
    assert consolidate_checked(spark, log, none, "20210101", "20210102").lines == 0
    assert good_rows(spark, none).count() == broken_lines(spark, none).count() == 0
    (tmp_path / "log" / "20220410.json").write_text(line("A", "VOD", 1))
    assert consolidate_checked(spark, log, none, "20220410", "20220410") == LogCounts(1, 0, 0, 0, 0)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        consolidate_checked(spark, str(tmp_path / "nowhere"), none, *PERIOD)
