import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import types as T

from teletally import storage
from teletally.plans.job import consolidate, run
from teletally.plans.sessions import sessions
from teletally.schema import log_schema, profile_schema
from teletally.sinks import export_names, write_csv, write_daily_log, write_jdbc, write_parquet
from teletally.sources import read_csv, read_jdbc, read_log, read_parquet_log, read_whole_log
from teletally.sources.daily_json import read_log_days
from teletally.storage import drop_stored, shared_path, store, store_by_contract
from teletally.streaming import run_daily_totals, stored_daily_totals
from tests.logs import day, line, log_frame, rows_set, write_day


def files_read(df) -> int:
    """Number of files the executed scan opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if node.metrics().contains("numFiles"):
            found.append(node.metrics().apply("numFiles").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return sum(found)


@pytest.fixture
def folder(tmp_path):
    for d in range(1, 7):
        write_day(tmp_path, f"2022040{d}.json", [("A", "VOD", d), ("B", "KPLUS", 10 * d)])
    write_day(tmp_path, "clean/20220403.json", [("Z", "VOD", 999)])
    write_day(tmp_path, "combined_log_data.json", [("Z", "VOD", 999)])
    (tmp_path / ".DS_Store").write_bytes(b"\0\1")
    return tmp_path


def test_range_is_inclusive_and_prunes_files(spark, folder):
    log = read_log(spark, str(folder), "20220402", "20220403")
    assert rows_set(log) == sorted(
        [(c, a, n, dt.date(2022, 4, d)) for d in (2, 3) for c, a, n in (("A", "VOD", d), ("B", "KPLUS", 10 * d))],
        key=str,
    )
    assert files_read(read_log(spark, str(folder), "20220402", "20220403")) == 2


@pytest.mark.parametrize("layout", ["file", "folder"])
def test_only_the_range_is_listed(spark, tmp_path, layout):
    names = {
        "file": ["20220401.json", "log_x_20220402.json.1", "20220403.json", "120220402.json", ".20220402.json"],
        "folder": ["20220401/a.json", "day=20220402/b.json", "l_20220402.json/c.json", "20220403/d.json", "x/e.json"],
    }[layout]
    for name in names:
        write_day(tmp_path, name, [(name, "VOD", 1)])
    log = read_log(spark, str(tmp_path), "20220401", "20220402", layout=layout)
    expected = names[:2] if layout == "file" else names[:3]
    assert sorted(r.contract for r in log.collect()) == sorted(expected)
    assert files_read(read_log(spark, str(tmp_path), "20220401", "20220402", layout=layout)) == len(expected)
    long_range = read_log(spark, str(tmp_path), "20200101", "20220402", layout=layout)
    assert sorted(r.contract for r in long_range.collect()) == sorted(expected)


def test_a_missing_log_is_an_error_and_an_empty_one_is_empty(spark, tmp_path):
    for read in (
        lambda root: read_log(spark, root, "20220401", "20220402"),
        lambda root: read_log_days(spark, root, [day("20220401")]),
        lambda root: read_whole_log(spark, root),
    ):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            read(str(tmp_path / "none"))
        (tmp_path / "empty").mkdir(exist_ok=True)
        found = read(str(tmp_path / "empty"))
        assert found.count() == 0 and found.schema == log_schema()


@pytest.mark.parametrize("names", [["20220401.json", "20220401.part2.json"], ["20220401.part2.json"]])
def test_the_same_files_for_every_period(spark, tmp_path, names):
    log, out = tmp_path / "log", str(tmp_path / "out")
    for k, name in enumerate(names):
        write_day(log, name, [(f"c{k}", "VOD", 1)])
    for name in ("20220401x.json", "notes.json", "20220401.txt", "a_20220401_b.json"):
        write_day(log, name, [("Z", "VOD", 1)])
    expected = sorted(f"c{k}" for k in range(len(names)))
    first = dt.date(2022, 3, 20)
    for length in (30, 400, 401):
        period = first, first + dt.timedelta(days=length - 1)
        assert sorted(r.contract for r in read_log(spark, str(log), *period).collect()) == expected
        assert files_read(read_log(spark, str(log), *period)) == len(names)
    assert sorted(r.contract for r in read_log_days(spark, str(log), [day("20220401")]).collect()) == expected
    assert sorted(r.contract for r in read_whole_log(spark, str(log)).collect()) == expected
    run_daily_totals(spark, str(log), out, str(tmp_path / "progress")).awaitTermination()
    assert sorted(r.contract for r in stored_daily_totals(spark, out).collect()) == expected


def test_durations_of_another_type(spark, tmp_path):
    write_day(tmp_path, "20220401.json", [("A", "VOD", 10.5), ("A", "VOD", "12"), ("A", "VOD", None)])
    with pytest.raises(Exception, match="duration is no bigint: 10.5"):
        run(spark, str(tmp_path), "20220401", "20220401").collect()
    profile = run(spark, str(tmp_path), "20220401", "20220401", duration=T.DecimalType(18, 2)).first()
    assert profile.movie_duration == Decimal("22.50") and profile.active_days == 1
    texts = tmp_path / "texts"
    write_day(texts, "20220401.json", [("A", "VOD", "12")])
    assert run(spark, str(texts), "20220401", "20220401").first().movie_duration == 12


def test_broken_lines_can_fail_the_job(spark, tmp_path):
    write_day(tmp_path, "20220401.json", [("A", "VOD", 1)], "no json\n")
    assert run(spark, str(tmp_path), "20220401", "20220401").count() == 1
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        run(spark, str(tmp_path), "20220401", "20220401", fail_on_broken=True).collect()


def test_foreign_names_are_not_read(spark, folder):
    log = read_log(spark, str(folder), "20000101", "20991231")
    assert log.where("contract = 'Z'").count() == 0
    assert log.count() == 12
    assert files_read(read_log(spark, str(folder), "20000101", "20991231")) == 6


def test_many_listed_days_are_pruned_too(spark, tmp_path):
    days = [f"202204{d:02d}" for d in range(1, 31)]
    for name in days:
        write_day(tmp_path, f"{name}.json", [("A", "VOD", 1)])
    log = read_log_days(spark, str(tmp_path), [day(name) for name in days[:15]])
    assert files_read(log) == 15 and log.count() == 15


def test_empty_range_has_the_full_schema(spark, folder):
    log = read_log(spark, str(folder), "20230101", "20230131")
    assert log.count() == 0
    assert [(f.name, f.dataType) for f in log.schema] == [(f.name, f.dataType) for f in log_schema()]


def test_broken_lines_and_foreign_fields(spark, tmp_path):
    extra = '{"_source": {"Contract": "A", \n{"other": 1}\n{"_source": {"Contract": 7, "Mac": "x", "AppName": "VOD"}}\n'
    write_day(tmp_path, "log_20220401.json", [("A", "VOD", 5)], extra)
    log = read_log(spark, str(tmp_path), "20220401", "20220401")
    assert rows_set(sessions(log), "contract", "category", "duration") == [("7", "Movie", None), ("A", "Movie", 5)]


def test_prefixed_and_compressed_names(spark, tmp_path):
    import gzip

    write_day(tmp_path, "log_content_20220401.json", [("A", "VOD", 5)])
    (tmp_path / "20220402.json.gz").write_bytes(gzip.compress(line("B", "VOD", 6).encode()))
    log = read_log(spark, str(tmp_path), "20220401", "20220402")
    assert rows_set(log, "contract", "duration") == [("A", 5), ("B", 6)]


def test_folder_layout_round_trip(spark, tmp_path):
    log = log_frame(spark, {"20220401": [("A", "VOD", 1), ("A", "XX", 2)], "20220402": [(None, "KPlus", None)]})
    write_daily_log(log, str(tmp_path / "log"))
    back = read_log(spark, str(tmp_path / "log"), "20220401", "20220402", layout="folder")
    assert rows_set(back) == rows_set(log)
    assert files_read(read_log(spark, str(tmp_path / "log"), "20220402", "20220402", layout="folder")) == 1


def test_decimal_durations(spark, tmp_path):
    write_day(tmp_path, "20220401.json", [("A", "VOD", 1.25), ("A", "VOD", 2)])
    log = read_log(spark, str(tmp_path), "20220401", "20220401", duration=T.DecimalType(18, 2))
    assert sessions(log).groupBy().sum("duration").first()[0] == Decimal("3.25")


def test_consolidate_replaces_only_its_days(spark, folder, tmp_path):
    out = str(tmp_path / "all.parquet")
    consolidate(spark, str(folder), out, "20220401", "20220406")
    write_day(folder, "20220402.json", [("C", "SPORT", 77)])
    consolidate(spark, str(folder), out, "20220402", "20220402")
    stored = read_parquet_log(spark, out, "20220401", "20220406")
    assert stored.count() == 11
    assert rows_set(read_parquet_log(spark, out, "20220402", "20220402"), "contract", "duration") == [("C", 77)]
    assert files_read(read_parquet_log(spark, out, "20220402", "20220403")) == 2


def test_consolidate_empties_days_without_rows(spark, folder, tmp_path):
    out = str(tmp_path / "all.parquet")
    consolidate(spark, str(folder), out, "20220401", "20220406")
    (folder / "20220402.json").write_text("")
    (folder / "20220403.json").unlink()
    consolidate(spark, str(folder), out, "20220401", "20220403")
    stored = read_parquet_log(spark, out)
    assert stored.count() == read_log(spark, str(folder), "20220401", "20220406").count() == 8
    with pytest.raises(ValueError):
        read_parquet_log(spark, out, start="20220401")


def test_sorted_days(spark, tmp_path):
    days = {f"202204{d:02d}": [(f"c{i * 7 % 100:02d}", "VOD", i) for i in range(100)] for d in (1, 2)}
    out = tmp_path / "sorted"
    write_parquet(log_frame(spark, days), str(out), rebalance=True, sort=True)
    for file in out.glob("log_date=*/*.parquet"):
        stored = [r.contract for r in spark.read.parquet(str(file)).select("contract").coalesce(1).collect()]
        assert stored == sorted(stored) and len(stored) == 100


def test_rebalanced_days_get_few_files(spark, tmp_path):
    days = {f"202204{d:02d}": [(str(i), "VOD", i) for i in range(50)] for d in range(1, 6)}
    out = tmp_path / "balanced"
    write_parquet(log_frame(spark, days).repartition(8), str(out), rebalance=True)
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in out.glob("log_date=*"))
    assert spark.read.parquet(str(out)).count() == 250


def test_csv_keeps_nulls_and_empty_tastes(spark, tmp_path):
    rows = [("A", 1, None, 0, None, 5, "TV", "", 0, 0.0), ("B", None, 2, None, None, None, None, "a,\"b", 1, 0.5)]
    df = spark.createDataFrame(rows, profile_schema())
    path = str(tmp_path / "csv")
    write_csv(df, path)
    write_csv(df, path, files=1)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1
    back = read_csv(spark, path, profile_schema())
    assert back.schema == profile_schema()
    assert rows_set(back) == rows_set(df)


def test_csv_keeps_blanks_quotes_and_line_breaks(spark, tmp_path):
    rows = [(" A ", 1), ('q"u,o\\"te', 2), ("\ttab", 3), ("", 4), (None, 5), ("#x", 6), ("\\", 7)]
    df = spark.createDataFrame(rows, "contract string, n int")
    path = str(tmp_path / "csv")
    write_csv(df, path)
    assert rows_set(read_csv(spark, path, df.schema)) == rows_set(df)
    broken = spark.createDataFrame([("a\nb", 1), ("c\r", 2)], "contract string, n int")
    with pytest.raises(Exception, match="line break in column contract"):
        write_csv(broken, path)
    write_csv(broken, path, line_breaks=True)
    assert rows_set(read_csv(spark, path, broken.schema, line_breaks=True)) == rows_set(broken)


def test_csv_header_is_checked(spark, tmp_path):
    write_csv(spark.createDataFrame([(1, 2)], "b int, a int"), str(tmp_path / "csv"))
    wrong = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, str(tmp_path / "csv"), wrong).collect()


def test_save_modes(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    path = str(tmp_path / "csv")
    write_csv(df, path)
    write_csv(df, path, mode="append")
    assert spark.read.csv(path, header=True).count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_csv(df, path, mode="errorifexists")


def test_export_names(spark):
    df = spark.createDataFrame([("A", "TV", 1)], "contract string, most_watch string, tv_duration int")
    out = export_names(df, local_labels=True)
    assert out.columns == ["Contract", "MostWatch", "TVDuration"]
    assert out.first().MostWatch == "Truyền Hình"


class Recorder:
    """Stands in for Spark's reader or writer, keeping the arguments it is called with."""

    def jdbc(self, *args, **kwargs):
        self.args, self.kwargs = args, kwargs


class Holder:
    def __init__(self):
        self.read = self.write = Recorder()

    def repartition(self, partitions):
        self.partitions = partitions
        return self


def test_jdbc_writer_options():
    df = Holder()
    write_jdbc(df, "jdbc:x://h/db", "profiles", {"user": "u", "driver": "d"}, connections=4)
    assert df.write.args == ("jdbc:x://h/db", "profiles") and df.partitions == 4
    assert df.write.kwargs["mode"] == "overwrite"
    assert df.write.kwargs["properties"] == {
        "numPartitions": "4",
        "batchsize": "10000",
        "truncate": "true",
        "user": "u",
        "driver": "d",
    }


def test_jdbc_reader_options():
    spark = Holder()
    read_jdbc(spark, "jdbc:x", "t", {"user": "u"})
    assert spark.read.kwargs == {"properties": {"user": "u"}}
    read_jdbc(spark, "jdbc:x", "t", {}, column="log_date", bounds=("2022-04-01", "2022-04-30"), partitions=30)
    assert spark.read.kwargs["numPartitions"] == 30
    assert (spark.read.kwargs["lowerBound"], spark.read.kwargs["upperBound"]) == ("2022-04-01", "2022-04-30")
    read_jdbc(spark, "jdbc:x", "t", {}, predicates=["a < 1", "a >= 1"])
    assert spark.read.kwargs["predicates"] == ["a < 1", "a >= 1"]
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x", "t", {}, column="a")


def test_shared_path_uses_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_path(spark, "x"), shared_path(spark, "x")
    assert first.startswith(f"{base}/x-") and first != second


def test_store_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([("A", "TV", 1), ("B", "Movie", None)], "contract string, category string, total long")
    back = store(df, "t", ["category"])
    assert sorted(back.columns) == sorted(df.columns)
    assert rows_set(back.select(*df.columns)) == rows_set(df)


def test_without_a_setting_the_warehouse_is_used(monkeypatch):
    monkeypatch.setattr(storage, "_stored", {})

    class Conf:
        def get(self, key, default=None):
            return {"spark.sql.warehouse.dir": "hdfs://h/warehouse"}.get(key, default)

    class Cluster:
        conf = Conf()

    assert shared_path(Cluster(), "x").startswith("hdfs://h/warehouse/_intermediates/x-")


def test_what_was_stored_can_be_dropped(spark):
    days = log_frame(spark, {"20220401": [("A", "VOD", 1)]})
    path = Path(store(days, "t").inputFiles()[0].removeprefix("file:")).parent
    for _ in range(2):
        assert store_by_contract(days, "daily-totals", 2).count() == 1
    assert path.exists() and [t for t in spark.catalog.listTables() if t.name.startswith("daily_totals")]
    drop_stored(spark)
    assert not path.exists()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("daily_totals")]
