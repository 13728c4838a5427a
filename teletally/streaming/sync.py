"""Daily totals kept equal to a log whose files may be rewritten, emptied or deleted.

``run_daily_totals`` follows a log that only grows. Here every run lists the log, compares the listing with the
one of the last run, and does over the days whose files differ; other days' files are not opened.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from teletally.schema import APP_CODES, CategoryCodes
from teletally.sources.manifest import Manifest, changes, list_log
from teletally.storage import store
from teletally.streaming.daily import refresh_days


def sync_daily_totals(
    spark: SparkSession,
    root: str,
    out: str,
    manifest: str,
    *,
    layout: str = "file",
    duration: T.DataType | None = None,
    codes: CategoryCodes = APP_CODES,
) -> list[dt.date]:
    """Bring the totals in ``out`` up to date with the log; returns the days that were done over.

    The driver sees the dates of changed days, not their files. The listing is taken before the days are read, and
    becomes the new manifest after they are written: what fails in between, or changes meanwhile, is found
    by the next run.
    """
    stored = Manifest(manifest)
    listing = store(list_log(spark, root, layout=layout), "log-listing")
    changed = changes(listing, stored.read(spark)).select("log_date").distinct()
    days = sorted(row.log_date for row in changed.collect())
    if days:
        refresh_days(spark, root, out, days, layout=layout, duration=duration, codes=codes)
        stored.write(listing)
    return days
