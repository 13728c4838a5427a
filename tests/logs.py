"""Hand-written logs for the edge cases."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

from teletally.schema import log_schema


def line(contract, app, duration) -> str:
    return json.dumps({"_index": "x", "_source": {"Contract": contract, "AppName": app, "TotalDuration": duration}})


def write_day(folder: Path, name: str, rows, extra: str = "") -> None:
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(line(*row) for row in rows) + "\n" + extra, encoding="utf-8")


def day(text: str) -> dt.date:
    return dt.datetime.strptime(text, "%Y%m%d").date()


def log_frame(spark, days: dict[str, list[tuple]]):
    """Log rows {YYYYMMDD: [(contract, app, duration), ...]} as a frame."""
    rows = [(*row, day(name)) for name, listed in days.items() for row in listed]
    return spark.createDataFrame(rows, log_schema())


def as_dict(df, key="contract", value=None):
    """{key: row} or {key: value}, insisting on one row per key."""
    rows = df.collect()
    found = {row[key]: (row[value] if value else row) for row in rows}
    assert len(found) == len(rows), "more than one row per key"
    return found


def rows_set(df, *columns):
    rows = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(rows, key=str)
