"""Sources: daily JSON logs, stored tables and adapters for other event tables."""

from teletally.sources.daily_json import log_paths, read_log, read_whole_log
from teletally.sources.tables import read_csv, read_jdbc, read_parquet_log

__all__ = ["log_paths", "read_csv", "read_jdbc", "read_log", "read_parquet_log", "read_whole_log"]
