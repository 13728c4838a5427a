"""The registered queries: every operator over whole driver tables.

``events`` is one log (30 days, no Sport), ``orders`` a second one with all five categories;
keys that run on the second one end in ``_orders``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from teletally.functions.categories import category_by_case, category_by_list, with_category_by_dimension
from teletally.functions.dates import compact_date
from teletally.functions.scores import active_any, active_total
from teletally.operators import aggregates, filters, ledger, pivots, sketches
from teletally.plans import metrics, profiles, segments
from teletally.plans.calendar import calendar, on_days
from teletally.plans.sessions import sessions
from teletally.schema import profile_schema
from teletally.sinks import export_names, write_csv, write_daily_log, write_parquet
from teletally.sinks.compaction import compact
from teletally.sources import read_csv, read_log, read_parquet_log, read_whole_log
from teletally.sources.adapters import EVENTS, ORDERS, ORDERS_PAIRED, SCALE, TableLog, in_units
from teletally.sources.quarantine import broken_lines, consolidate_checked, good_rows
from teletally.storage import delete, shared_path, store, store_by_contract
from teletally.streaming import run_daily_totals, stored_daily_totals, sync_daily_totals

Query = Callable[[SparkSession, str], DataFrame]

ONE_WEEK = (dt.date(2024, 1, 5), dt.date(2024, 1, 11))
NEXT_WEEK = (dt.date(2024, 1, 12), dt.date(2024, 1, 18))
# Days that a ledger loses again.
RETRACTED = {"events": ONE_WEEK, "orders": (ORDERS.split, ORDERS.end)}


def _log(log: TableLog, build: Callable[[TableLog, DataFrame], DataFrame]) -> Query:
    """Query over all raw log rows of a table."""
    return lambda spark, folder: in_units(build(log, log.read(spark, folder)))


def _sessions(log: TableLog, build: Callable[[TableLog, DataFrame], DataFrame]) -> Query:
    """Query over all categorised rows of a table."""
    return _log(log, lambda log, raw: build(log, sessions(raw, log.codes)))


def _halves(log: TableLog, spark: SparkSession, folder: str) -> list[DataFrame]:
    """Sessions of an earlier and a later part of the period, together the whole table."""
    day = dt.timedelta(days=1)
    earlier, later = log.read(spark, folder, end=log.split - day), log.read(spark, folder, start=log.split)
    return [sessions(earlier, log.codes), sessions(later, log.codes)]


# --- rows ---------------------------------------------------------------------------------


def _categorized(raw: DataFrame, category) -> DataFrame:
    return raw.select("session_id", category.alias("category"))


def _parse_date(log: TableLog, raw: DataFrame) -> DataFrame:
    text = F.date_format("log_date", "yyyyMMdd")
    return raw.select(compact_date(text).alias("log_date")).groupBy("log_date").agg(F.count("*").alias("n_rows"))


ROW_QUERIES: dict[str, Query] = {
    "parse_date": _log(EVENTS, _parse_date),
    "date_stamp": _log(EVENTS, lambda log, raw: raw.select("session_id", "log_date")),
    "date_range": lambda spark, folder: EVENTS.read(spark, folder, *ONE_WEEK).select(
        "session_id", "contract", "log_date"
    ),
    "categorize_case": _log(
        EVENTS, lambda log, raw: _categorized(raw, category_by_case(F.col("app_name"), log.codes))
    ),
    "categorize_isin": _log(
        EVENTS, lambda log, raw: _categorized(raw, category_by_list(F.col("app_name"), log.codes))
    ),
    "categorize_dim": _log(
        EVENTS, lambda log, raw: with_category_by_dimension(raw, log.codes).select("session_id", "category")
    ),
    "categorize_isin_orders": _log(
        ORDERS, lambda log, raw: _categorized(raw, category_by_list(F.col("app_name"), ORDERS_PAIRED))
    ),
    "categorize_dim_orders": _log(
        ORDERS, lambda log, raw: with_category_by_dimension(raw, ORDERS_PAIRED).select("session_id", "category")
    ),
    "project": _sessions(EVENTS, lambda log, rows: filters.session_columns(rows)),
    "filter_contract": _log(EVENTS, lambda log, raw: filters.known_contracts(raw).select("session_id")),
    "filter_mapped": _log(
        EVENTS,
        lambda log, raw: filters.mapped(sessions(raw, log.codes, keep_unmapped=True), log.codes).select(
            "session_id", "category"
        ),
    ),
    "category_slice": _log(
        EVENTS,
        lambda log, raw: filters.category_slice(sessions(raw, log.codes, keep_unmapped=True), "TV", log.codes).select(
            "session_id", "contract", "duration"
        ),
    ),
    "contract_lookup": lambda spark, folder: in_units(
        sessions(EVENTS.read(spark, folder, contract="7"), EVENTS.codes).select(
            "session_id", "contract", "category", "duration", "log_date"
        )
    ),
    "union_days": lambda spark, folder: in_units(filters.union_days(*_halves(EVENTS, spark, folder))),
    "sort_contract": _sessions(
        EVENTS, lambda log, rows: filters.by_contract(rows.select("contract", "log_date", "category", "duration"))
    ),
    "mapping_audit": _log(
        EVENTS, lambda log, raw: aggregates.mapping_audit(sessions(raw, log.codes, keep_unmapped=True))
    ),
    "stamp_result": _sessions(EVENTS, lambda log, rows: filters.stamp_day(pivots.pivot(rows), log.start)),
}

# --- totals and pivots ----------------------------------------------------------------------


def _merged(log: TableLog) -> Query:
    """Stored pivots of an earlier and a later part of the period, merged."""
    return lambda spark, folder: in_units(
        pivots.merge_partials(*[store(pivots.pivot(part), "partial-pivot") for part in _halves(log, spark, folder)])
    )


def _joined_pivot(log: TableLog, rows: DataFrame) -> DataFrame:
    return pivots.pivot_by_join(store_by_contract(aggregates.category_totals(rows), "category-totals"))


def _flag_any(log: TableLog, rows: DataFrame) -> DataFrame:
    return pivots.pivot_by_day(rows).select("contract", "log_date", active_any().alias("is_active"))


def _flag_total(log: TableLog, rows: DataFrame) -> DataFrame:
    return aggregates.day_totals(rows).withColumn("is_active", active_total(F.col("total")))


TOTAL_PLANS = {
    "sum_contract_category": lambda log, rows: aggregates.category_totals(rows),
    "sum_contract_category_day": lambda log, rows: aggregates.daily_totals(rows),
    "sum_contract_day": lambda log, rows: aggregates.day_totals(rows),
    "category_summary": lambda log, rows: aggregates.category_summary(rows),
    "sketched_summary": lambda log, rows: _sketched_summary(log, rows),
    "pivot_category": lambda log, rows: pivots.pivot(rows),
    "pivot_category_day": lambda log, rows: pivots.pivot_by_day(rows),
    "pivot_by_join": _joined_pivot,
    "active_flag_any": _flag_any,
    "active_flag_total": _flag_total,
    "active_days": lambda log, rows: aggregates.active_days(rows),
    "duplicate_contracts": lambda log, rows: aggregates.repeated(rows),
    "dedup_sessions": lambda log, rows: filters.without_repeats(rows),
    "top_contracts": lambda log, rows: filters.top_contracts(aggregates.totals(rows, "contract"), 10),
}

# --- metrics, profiles, groups ----------------------------------------------------------------


def _profile(log: TableLog, rows: DataFrame) -> DataFrame:
    return profiles.customer_profile(rows, log.start, log.end)


def _stored_metrics(log: TableLog, rows: DataFrame) -> DataFrame:
    sized = profiles.customer_profile(rows, log.start, log.end, with_size=True)
    return store(sized, "contract-metrics")


def _stored_days(rows: DataFrame) -> DataFrame:
    """Daily totals, written once by contract, in place of the sessions they sum up."""
    return aggregates.as_sessions(store_by_contract(aggregates.daily_totals(rows), "daily-totals"))


def _profile_joined(log: TableLog, rows: DataFrame) -> DataFrame:
    return profiles.customer_profile_joined(_stored_days(rows), log.start, log.end)


def _daily_joined(log: TableLog, rows: DataFrame) -> DataFrame:
    days = _stored_days(rows)
    return profiles.daily_profile_joined(days, profiles.customer_profile(days, log.start, log.end))


def _dedup_profile(log: TableLog, rows: DataFrame) -> DataFrame:
    return _profile(log, filters.without_repeats(rows))


def _with_unmapped(log: TableLog, raw: DataFrame) -> DataFrame:
    """The one-day selection: without the catch-all contract, unmapped apps kept."""
    return sessions(raw, log.codes, keep_unmapped=True, drop_unknown_contract=True)


def _session_profile(log: TableLog, rows: DataFrame) -> DataFrame:
    wanted = rows.select("session_id", "contract", "category", "duration", "log_date")
    return profiles.session_profile(wanted, _stored_metrics(log, rows))


def _sketched_summary(log: TableLog, rows: DataFrame) -> DataFrame:
    daily = store(sketches.daily_customers(rows), "daily-customers")
    return sketches.customers_by_category(daily, log.start, log.end)


def _retracted(log: TableLog) -> Query:
    """The profile out of a ledger of all days that has lost some of them again."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        def parts(*period: dt.date) -> DataFrame:
            return ledger.day_parts(sessions(log.read(spark, folder, *period), log.codes))

        whole = store(ledger.ledger(parts()), "ledger")
        left = ledger.retracted(whole, parts(*RETRACTED[log.table]))
        return in_units(ledger.profile_of(left, log.start, log.end))

    return query


def _total_quantiles(log: TableLog, rows: DataFrame) -> DataFrame:
    """Quantiles of the daily totals; sketches of this size are exact for as many values."""
    size = 65_535
    daily = store(sketches.daily_quantiles(aggregates.day_totals(rows), k=size), "daily-quantiles")
    found = sketches.quantiles_of_period(daily, log.start, log.end, (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0), k=size)
    return found.select("fraction", F.col("value").alias("total"), "n")


def _engagement(log: TableLog, rows: DataFrame) -> DataFrame:
    return metrics.engagement_levels(
        aggregates.totals(rows, "contract"), log.low_max * SCALE, log.high_min * SCALE
    )


def _engagement_quantile(log: TableLog, rows: DataFrame) -> DataFrame:
    totals = store(aggregates.totals(rows, "contract"), "contract-totals")
    return metrics.engagement_by_quantile(totals).select("contract", "engagement_type")


def _levels(log: TableLog, rows: DataFrame) -> DataFrame:
    return metrics.active_levels(metrics.activeness(rows, log.start, log.end), log.level_threshold)


def _groups(log: TableLog, rows: DataFrame) -> DataFrame:
    return segments.customer_group(_profile(log, rows), log.level_threshold)


METRIC_PLANS = {
    "most_watch": lambda log, rows: metrics.most_watched_ranked(aggregates.category_totals(rows), "total"),
    "most_watch_max_by": lambda log, rows: metrics.most_watched(rows),
    "most_watch_day": lambda log, rows: metrics.most_watched(rows, "day"),
    "most_watch_session": lambda log, rows: metrics.most_watched(rows, "session"),
    "presence_labels": lambda log, rows: metrics.presence_labels(pivots.pivot(rows)),
    "customer_taste": lambda log, rows: metrics.customer_taste(pivots.pivot(rows)),
    "customer_taste_nonzero": lambda log, rows: metrics.customer_taste(pivots.pivot(rows), nonzero=True),
    "activeness": lambda log, rows: metrics.activeness(rows, log.start, log.end),
    "activeness_pivot": lambda log, rows: metrics.activeness_from_pivot(rows, log.start, log.end),
    "customer_profile": _profile,
    "customer_profile_join": _profile_joined,
    "customer_profile_dedup": _dedup_profile,
    "daily_profile": lambda log, rows: profiles.daily_profile(rows, log.start, log.end),
    "daily_profile_join": _daily_joined,
    "session_profile": _session_profile,
    "engagement_level": _engagement,
    "engagement_percentile": _engagement_quantile,
    "active_level": _levels,
    "customer_group": _groups,
    "segment_counts": lambda log, rows: segments.segment_counts(_groups(log, rows)),
    "segment_dimensions": lambda log, rows: segments.segment_dimensions(_groups(log, rows)),
    "segment_cube": lambda log, rows: segments.segment_cube(_groups(log, rows)),
    "export_profile": lambda log, rows: export_names(in_units(_profile(log, rows)), local_labels=True),
}

# Forms for one log only: unmapped apps occur in events alone, and its 30 days fit in one bit set.
EVENT_QUERIES: dict[str, Query] = {
    "pivot_unmapped": _log(EVENTS, lambda log, raw: pivots.pivot(_with_unmapped(log, raw), with_unmapped=True)),
    "category_summary_unmapped": _log(
        EVENTS, lambda log, raw: aggregates.category_summary(_with_unmapped(log, raw))
    ),
    "customer_profile_one_shuffle": _sessions(
        EVENTS, lambda log, rows: profiles.customer_profile(rows, log.start, log.end, non_negative=True)
    ),
    "activeness_one_shuffle": _sessions(
        EVENTS, lambda log, rows: metrics.activeness_by_marks(rows, log.start, log.end)
    ),
    "rolling_activeness": _sessions(
        EVENTS, lambda log, rows: metrics.rolling_activeness(rows, log.start, log.end, 7)
    ),
    "rolling_customers": _sessions(
        EVENTS,
        lambda log, rows: sketches.customers_per_window(
            store(sketches.daily_customers(rows), "daily-customers"), log.start, log.end, 7
        ),
    ),
    "retention": _sessions(
        EVENTS,
        lambda log, rows: sketches.retention(
            store(sketches.daily_customers(rows), "daily-customers"), ONE_WEEK, NEXT_WEEK
        ),
    ),
    "total_quantiles": _sessions(EVENTS, _total_quantiles),
}

# --- reading and writing ------------------------------------------------------------------------


def _write_log(spark: SparkSession, folder: str) -> str:
    """The whole events table as a raw daily JSON log in the shared folder."""
    root = shared_path(spark, "daily-log")
    write_daily_log(EVENTS.read(spark, folder), root)
    return root


def _scan_json(spark: SparkSession, folder: str) -> DataFrame:
    root = _write_log(spark, folder)
    return in_units(read_whole_log(spark, root, layout="folder"))


def _scan_json_range(spark: SparkSession, folder: str) -> DataFrame:
    return in_units(read_log(spark, _write_log(spark, folder), *ONE_WEEK, layout="folder"))


def _consolidate(spark: SparkSession, folder: str) -> DataFrame:
    out = shared_path(spark, "consolidated")
    write_parquet(EVENTS.read(spark, folder), out, rebalance=True, sort=True)
    return in_units(read_parquet_log(spark, out))


def _csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    out = shared_path(spark, "profile-csv")
    write_csv(_profile(EVENTS, sessions(EVENTS.read(spark, folder), EVENTS.codes)), out)
    return in_units(read_csv(spark, out, profile_schema()))


def _incremental(spark: SparkSession, folder: str) -> DataFrame:
    root, out = _write_log(spark, folder), shared_path(spark, "daily-totals")
    run = run_daily_totals(
        spark,
        root,
        out,
        shared_path(spark, "daily-totals-progress"),
        layout="folder",
        codes=EVENTS.codes,
    )
    run.awaitTermination()
    return stored_daily_totals(spark, out)


def _incremental_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The profile out of the stored daily totals, without going back to the log."""
    merged = aggregates.as_sessions(_incremental(spark, folder))
    return in_units(profiles.customer_profile(merged, EVENTS.start, EVENTS.end))


def _synced(spark: SparkSession, folder: str) -> DataFrame:
    """Totals that follow a log of which one day was rewritten and one deleted since the last run."""
    root, out, manifest = (shared_path(spark, name) for name in ("daily-log", "daily-totals", "log-manifest"))
    wrong = EVENTS.start + dt.timedelta(days=4)
    rows = EVENTS.read(spark, folder)
    first = rows.withColumn("duration", F.when(F.col("log_date") == wrong, F.col("duration") * 2).otherwise(F.col("duration")))
    extra = rows.where(F.col("log_date") == wrong).withColumn("log_date", F.lit(EVENTS.start - dt.timedelta(days=1)))
    write_daily_log(first.union(extra), root)
    sync_daily_totals(spark, root, out, manifest, layout="folder", codes=EVENTS.codes)
    for day in (wrong, EVENTS.start - dt.timedelta(days=1)):
        delete(spark, f"{root}/day={day:%Y%m%d}")
    write_daily_log(rows.where(F.col("log_date") == wrong), root, mode="append")
    sync_daily_totals(spark, root, out, manifest, layout="folder", codes=EVENTS.codes)
    return in_units(stored_daily_totals(spark, out))


def _quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """All lines of a log of which some are cut off and some have a duration that is no number."""
    root, out = shared_path(spark, "broken-log"), shared_path(spark, "checked")
    rows = EVENTS.read(spark, folder)
    text = F.when(F.col("session_id") % 89 == 0, F.lit("none")).otherwise(F.col("duration").cast("string"))
    payload = F.struct(
        F.col("contract").alias("Contract"), F.col("app_name").alias("AppName"), text.alias("TotalDuration")
    )
    line = F.to_json(F.struct(payload.alias("_source")))
    cut = F.when(F.col("session_id") % 97 == 0, F.substring("line", 1, 15)).otherwise(F.col("line"))
    lines = rows.select("session_id", line.alias("line"), F.date_format("log_date", "yyyyMMdd").alias("day"))
    lines.select(cut.alias("value"), "day").write.partitionBy("day").text(root)
    consolidate_checked(spark, root, out, EVENTS.start, EVENTS.end, layout="folder", codes=EVENTS.codes, names="*.txt")
    nothing = F.lit(None)
    broken = broken_lines(spark, out).select(
        nothing.cast("string").alias("contract"), nothing.cast("string").alias("app_name"),
        nothing.cast("bigint").alias("duration"), "log_date", "reason",
    )
    good = good_rows(spark, out).withColumn("reason", nothing.cast("string"))
    return in_units(good.unionByName(broken))


def _weekends(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of the weekends, by a stored calendar, from a log stored by day."""
    out = shared_path(spark, "consolidated")
    write_parquet(EVENTS.read(spark, folder), out, rebalance=True, sort=True)
    days = store(calendar(spark, EVENTS.start, EVENTS.end), "calendar")
    found = on_days(read_parquet_log(spark, out), days, F.col("weekday") >= 6)
    return in_units(found.select("contract", "app_name", "duration", "log_date"))


def _compacted(spark: SparkSession, folder: str) -> DataFrame:
    """A log stored in eight files a day, packed."""
    out = shared_path(spark, "consolidated")
    write_parquet(EVENTS.read(spark, folder).repartition(8), out)
    compact(spark, out)
    return in_units(read_parquet_log(spark, out))


def _stored_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """One contract out of a stored log, by its bloom filters."""
    out = shared_path(spark, "consolidated")
    write_parquet(EVENTS.read(spark, folder), out, rebalance=True, sort=True, bloom=["contract"])
    found = read_parquet_log(spark, out).where(F.col("contract") == "7")
    return in_units(sessions(found, EVENTS.codes).select("session_id", "contract", "category", "duration", "log_date"))


STORAGE_QUERIES: dict[str, Query] = {
    "scan_json": _scan_json,
    "scan_json_range": _scan_json_range,
    "consolidate": _consolidate,
    "csv_roundtrip": _csv_roundtrip,
    "incremental_days": lambda spark, folder: in_units(_incremental(spark, folder)),
    "incremental_profile": _incremental_profile,
    "synced_days": _synced,
    "quarantine": _quarantine,
    "weekend_sessions": _weekends,
    "compacted": _compacted,
    "contract_lookup_stored": _stored_lookup,
}


def all_queries() -> dict[str, Query]:
    """Every registered query by key."""
    found = dict(ROW_QUERIES)
    for key, plan in {**TOTAL_PLANS, **METRIC_PLANS}.items():
        found[key] = _sessions(EVENTS, plan)
        found[f"{key}_orders"] = _sessions(ORDERS, plan)
    found["merge_partials"], found["merge_partials_orders"] = _merged(EVENTS), _merged(ORDERS)
    found["retracted_profile"], found["retracted_profile_orders"] = _retracted(EVENTS), _retracted(ORDERS)
    return found | EVENT_QUERIES | STORAGE_QUERIES


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """The customer profile over the whole events table."""
    return _sessions(EVENTS, _profile)(spark, folder)
