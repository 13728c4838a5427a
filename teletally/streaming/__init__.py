"""Incremental run over newly arrived days."""

from teletally.streaming.daily import refresh_days, run_daily_totals, stored_daily_totals
from teletally.streaming.sync import sync_daily_totals

__all__ = ["refresh_days", "run_daily_totals", "stored_daily_totals", "sync_daily_totals"]
