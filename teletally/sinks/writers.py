"""Writers. Every one takes its save mode; none falls back to Spark's error-if-exists."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from teletally.functions.categories import export_label
from teletally.schema import EXPORT_NAMES
from teletally.storage import delete, file_names


def export_names(df: DataFrame, *, local_labels: bool = False) -> DataFrame:
    """Columns under their exported names, optionally with category labels translated."""
    if local_labels:
        labelled = [c for c in ("category", "most_watch") if c in df.columns]
        df = df.withColumns({c: export_label(F.col(c)) for c in labelled})
    return df.withColumnsRenamed({old: new for old, new in EXPORT_NAMES.items() if old in df.columns})


def write_csv(
    df: DataFrame, path: str, *, mode: str = "overwrite", files: int | None = None, line_breaks: bool = False
) -> None:
    """CSV with a header row; blanks around a value are kept.

    ``files=1`` gives a single file, but then one task writes the whole result; leave it out
    for anything that is not known to be small. A line break in a value fails the job, since
    readers that split files would cut the row there; ``line_breaks`` lets it through, for
    readers told of it (``read_csv``).
    """
    if not line_breaks:
        texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
        df = df.withColumns({c: _one_line(F.col(f"`{c}`"), c) for c in texts})
    if files is not None:
        df = df.repartition(files)
    df.write.mode(mode).csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def _one_line(text: Column, name: str) -> Column:
    broken = text.contains("\n") | text.contains("\r")
    return F.when(broken, F.raise_error(F.lit(f"line break in column {name}")).cast("string")).otherwise(text)


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    by_day: bool = True,
    rebalance: bool = False,
    replace_days: bool = False,
    days: Sequence[dt.date] = (),
    sort: bool = False,
    bloom: Sequence[str] = (),
) -> None:
    """Parquet, by default in one folder per ``log_date``.

    ``rebalance`` brings a day's rows together first, so that tasks holding many days do not
    each write a small file into every folder; AQE then splits a day that is too large for
    one task and merges small ones. Rows scanned from one file per day need no such shuffle.
    ``replace_days`` swaps only the days present in ``df`` and leaves the others alone; of
    ``days``, the days that ``df`` was read from, those without rows are emptied too, after the others are
    replaced: a reader in between still finds their old rows.
    ``sort`` orders each task's rows by contract, so that a look-up of one contract skips most
    row groups by their statistics. ``bloom`` names columns that get a bloom filter per row group, by
    which a look-up skips even the groups whose range holds a value that they do not have.
    """
    if rebalance:
        df = df.hint("rebalance", F.col("log_date"))
    if sort:
        df = df.sortWithinPartitions(*(["log_date"] if by_day else []), "contract")
    writer = df.write.mode(mode)
    if by_day:
        writer = writer.partitionBy("log_date")
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if replace_days:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    spark = df.sparkSession
    before = {}
    if replace_days and by_day and days:
        # One listing of the table says which of the days it has; only those are looked into.
        held = file_names(spark, path) & {f"log_date={day.isoformat()}" for day in days}
        before = {folder: file_names(spark, folder) for folder in (f"{path.rstrip('/')}/{name}" for name in held)}
    writer.parquet(path)
    for folder, names in before.items():
        # Rows of a day come in new files; a day that kept its old ones got none.
        if names and file_names(spark, folder) == names:
            delete(spark, folder)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    mode: str = "overwrite",
    connections: int = 8,
    batch_size: int = 10_000,
    truncate: bool = True,
) -> None:
    """Database table, replaced by default.

    Connection details come from the caller. ``connections`` limits the parallel writers to
    what the database can take; with ``truncate`` the table keeps its definition and grants.
    The partitions commit one by one, so a failed job can leave part of the rows behind: run
    it again, or write to a staging table where readers must not see that. The rows are dealt
    out to the writers by a shuffle, so that the stage which computes them keeps its width.
    """
    options = {
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
        "truncate": str(truncate).lower(),
        **properties,
    }
    df.repartition(connections).write.jdbc(url, table, mode=mode, properties=options)


def write_daily_log(log: DataFrame, root: str, *, mode: str = "overwrite") -> None:
    """Log rows as raw JSON lines in one folder per day, ``day=YYYYMMDD``."""
    raw = log.select(
        F.struct(
            F.col("contract").alias("Contract"),
            F.col("app_name").alias("AppName"),
            F.col("duration").alias("TotalDuration"),
        ).alias("_source"),
        F.date_format("log_date", "yyyyMMdd").alias("day"),
    )
    raw.hint("rebalance", F.col("day")).write.mode(mode).partitionBy("day").json(root)
