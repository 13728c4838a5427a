"""Stored intermediates: tables written to the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# What this process stored and has not dropped: path to table name, if it is a table.
_stored: dict[str, str | None] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``.

    Where that is not set, a folder in the session's warehouse, which executors share as well:
    a machine-local folder would be lost together with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediates"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _stored[path] = None
    return path


def store(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    For a result that a later plan reads more than once: the expensive scan and shuffle
    behind it run a single time, and a lost executor costs a re-read, not a recompute.
    """
    path = shared_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_by_contract(df: DataFrame, name: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` once, bucketed and sorted by contract, and read it back as a table.

    Whatever is then grouped, joined or windowed by contract needs no further shuffle. Only
    for frames with a bounded number of rows per contract, such as daily totals: a contract
    lies in one bucket, so raw sessions of a dominant one would end up in a single task.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    bucketed = df.repartition(count, "contract").write.bucketBy(count, "contract").sortBy("contract")
    bucketed.option("path", path).saveAsTable(table)
    _stored[path] = table
    return spark.table(table)


def drop_stored(spark: SparkSession) -> None:
    """Drop all that this process stored, tables included; results that read it must be done with."""
    for path, table in list(_stored.items()):
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        delete(spark, path)
        del _stored[path]


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def file_names(spark: SparkSession, folder: str) -> set[str]:
    """Names of the files in a folder of any file system; none if there is no such folder."""
    files, place = _file_system(spark, folder)
    return {found.getPath().getName() for found in files.listStatus(place)} if files.exists(place) else set()


def empty_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the files without content that a path pattern finds; Spark's readers pass over them."""
    files, place = _file_system(spark, pattern)
    found = files.globStatus(place) or []
    return [f.getPath().toString() for f in found if f.isFile() and f.getLen() == 0]


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system, if it is there."""
    files, place = _file_system(spark, path)
    files.delete(place, True)
