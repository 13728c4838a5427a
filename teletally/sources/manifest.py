"""What files a log consists of, and what has changed since they were last listed.

A manifest is a stored table of path, length and modification time. Comparing a new listing with it by a full
outer join finds files that are new, rewritten under their old name, or gone; a file that was emptied is not
listed by Spark and counts as gone. A file rewritten to the same length within the clock's resolution of
the file system cannot be told apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from teletally.functions.dates import file_date
from teletally.sources.daily_json import FILE_NAMES, log_paths
from teletally.storage import delete, file_names

SCHEMA = "path string, length bigint, modified timestamp, log_date date"
ADDED, REWRITTEN, DELETED = "added", "rewritten", "deleted"


def list_log(spark: SparkSession, root: str, *, layout: str = "file") -> DataFrame:
    """``path``, ``length``, ``modified``, ``log_date`` of the log's files; no content is read.

    Files whose name holds no date are left out, and so are empty ones. An empty folder has no files, a missing
    one raises.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", FILE_NAMES)
    try:
        found = reader.load(log_paths(root, layout))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.read.format("binaryFile").option("pathGlobFilter", "/").load(root)
    day = file_date(F.col("path"), layout)
    listed = found.select("path", "length", F.col("modificationTime").alias("modified"), day.alias("log_date"))
    return listed.where("length > 0 AND log_date IS NOT NULL")


@dataclass(frozen=True)
class Manifest:
    """Versions of a stored listing under one folder; the last complete one counts."""

    path: str
    kept: int = 2

    def _versions(self, spark: SparkSession) -> list[int]:
        """Numbers of the complete versions, oldest first."""
        names = [n for n in file_names(spark, self.path) if n.startswith("version-")]
        done = [n for n in names if "_SUCCESS" in file_names(spark, f"{self.path}/{n}")]
        return sorted(int(n.removeprefix("version-")) for n in done)

    def read(self, spark: SparkSession) -> DataFrame:
        """The last listing; empty before the first one."""
        versions = self._versions(spark)
        if not versions:
            return spark.createDataFrame([], SCHEMA)
        return spark.read.schema(SCHEMA).parquet(f"{self.path}/version-{versions[-1]}")

    def write(self, listing: DataFrame) -> None:
        """Store a listing as the next version and drop all but the last ``kept`` ones.

        A version becomes visible as a whole, when its job has committed. One writer at a time.
        """
        spark = listing.sparkSession
        versions = self._versions(spark)
        number = versions[-1] + 1 if versions else 1
        listing.select("path", "length", "modified", "log_date").write.mode("overwrite").parquet(f"{self.path}/version-{number}")
        for old in [*versions, number][: -self.kept]:
            delete(spark, f"{self.path}/version-{old}")


def changes(listing: DataFrame, before: DataFrame) -> DataFrame:
    """``path``, ``log_date``, ``change`` of the files that differ between two listings."""
    old = before.select("path", *[F.col(c).alias(f"old_{c}") for c in ("length", "modified", "log_date")])
    change = (
        F.when(F.col("old_length").isNull(), ADDED)
        .when(F.col("length").isNull(), DELETED)
        .when((F.col("length") != F.col("old_length")) | (F.col("modified") != F.col("old_modified")), REWRITTEN)
    )
    joined = listing.join(old, "path", "full_outer").withColumn("change", change).where("change IS NOT NULL")
    return joined.select("path", F.coalesce("log_date", "old_log_date").alias("log_date"), "change")
