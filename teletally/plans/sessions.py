"""Log rows to sessions: categorised, filtered and optionally de-duplicated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teletally.functions.categories import category_by_list, has_category
from teletally.operators import filters
from teletally.schema import APP_CODES, CategoryCodes


def sessions(
    log: DataFrame,
    codes: CategoryCodes = APP_CODES,
    *,
    keep_unmapped: bool = False,
    drop_unknown_contract: bool = False,
    dedup: bool = False,
) -> DataFrame:
    """Session rows of a log, keeping its own columns.

    By default only unmapped apps are dropped; the catch-all contract stays. ``dedup`` keeps
    one of several sessions that agree in contract, category, duration and day.
    """
    app = F.col("app_name")
    rows = log if keep_unmapped else log.where(has_category(app, codes))
    rows = rows.withColumn("category", category_by_list(app, codes))
    if drop_unknown_contract:
        rows = filters.known_contracts(rows)
    return filters.without_repeats(rows) if dedup else rows
