"""Sinks: CSV, Parquet, JDBC and the daily JSON layout."""

from teletally.sinks.writers import export_names, write_csv, write_daily_log, write_jdbc, write_parquet

__all__ = ["export_names", "write_csv", "write_daily_log", "write_jdbc", "write_parquet"]
