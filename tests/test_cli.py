import pytest

from teletally.__main__ import main
from tests.logs import rows_set, write_day


@pytest.fixture
def log(tmp_path):
    write_day(tmp_path / "log", "20220401.json", [("A", "VOD", 5), ("A", "KPLUS", 1), ("0", "SPORT", 2)])
    write_day(tmp_path / "log", "20220402.json", [("A", "VOD", 5)])
    return tmp_path


def test_csv_profile(spark, log):
    out = str(log / "csv")
    main([str(log / "log"), "20220401", "20220402", out, "--files", "1", "--local-labels", "--non-negative"])
    found = spark.read.csv(out, header=True)
    assert found.columns == [
        "Contract",
        "RelaxDuration",
        "MovieDuration",
        "ChildDuration",
        "SportDuration",
        "TVDuration",
        "MostWatch",
        "CustomerTaste",
        "ActiveDays",
        "ActiveRate",
    ]
    assert rows_set(found) == [
        ("0", None, None, None, "2", None, "Thể Thao", "Sport", "1", "0.5"),
        ("A", None, "10", None, None, "1", "Phim Truyện", "Movie-TV", "2", "1.0"),
    ]


@pytest.mark.parametrize(("grain", "rows"), [("customer", 1), ("day", 2), ("session", 3)])
def test_parquet_grains(spark, log, grain, rows):
    out = str(log / "out")
    args = [str(log / "log"), "20220401", "20220402", out, "--format", "parquet", "--grain", grain]
    main([*args, "--drop-unknown-contract"])
    assert spark.read.parquet(out).count() == rows


def test_consolidated_log_gives_the_same_profile(spark, log):
    table, first, second = (str(log / n) for n in ("table", "first", "second"))
    period = ["20220401", "20220402"]
    main([str(log / "log"), *period, table, "--consolidate"])
    main([str(log / "log"), *period, first, "--format", "parquet"])
    main([table, *period, second, "--format", "parquet", "--consolidated"])
    assert rows_set(spark.read.parquet(first)) == rows_set(spark.read.parquet(second))
    assert spark.read.parquet(first).count() == 2


def test_jdbc_needs_its_connection(log):
    with pytest.raises(SystemExit):
        main([str(log), "20220401", "20220402", "profiles", "--format", "jdbc"])
