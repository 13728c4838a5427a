"""Other event tables presented as a viewing log.

Every adapter gives the log columns plus ``session_id``, the row's own key. Amounts are rounded
to two digits and counted in hundredths, as a bigint like the log's own durations: sums are then
exact whatever the order of the rows, and stay in fixed-width aggregation buffers.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from teletally.schema import CategoryCodes

# Hundredths per unit, and the type of an amount in units.
SCALE = 100
AMOUNT = "decimal(18,2)"


@dataclass(frozen=True)
class TableLog:
    """How one table maps to the log, and the period and cut-offs (in units) its metrics use."""

    table: str
    key: str
    contract: str
    app_name: str
    amount: str
    time: str
    codes: CategoryCodes
    start: dt.date
    end: dt.date
    split: dt.date
    level_threshold: float
    low_max: int
    high_min: int

    def read(
        self,
        spark: SparkSession,
        folder: str,
        start: dt.date | None = None,
        end: dt.date | None = None,
        contract: str | None = None,
    ) -> DataFrame:
        """Log rows of the whole table, of an inclusive date range, or of one contract.

        Range and contract are tested on the stored columns, not on what is derived from them, so
        that the scan can skip row groups.
        """
        rows = spark.read.parquet(f"{folder}/{self.table}.parquet")
        if start is not None:
            rows = rows.where(F.col(self.time) >= _midnight(start))
        if end is not None:
            rows = rows.where(F.col(self.time) < _midnight(end + dt.timedelta(days=1)))
        if contract is not None:
            stored = F.col(self.contract)
            wanted = F.lit(contract).try_cast(rows.schema[self.contract].dataType)
            # Other spellings of a number are other contracts.
            rows = rows.where((stored == wanted) & (stored.cast("string") == contract))
        return rows.select(
            F.col(self.key).alias("session_id"),
            F.col(self.contract).cast("string").alias("contract"),
            F.col(self.app_name).alias("app_name"),
            (F.col(self.amount).cast(AMOUNT) * SCALE).cast("bigint").alias("duration"),
            F.to_date(self.time).alias("log_date"),
        )


def in_units(df: DataFrame) -> DataFrame:
    """Duration columns of a result back in units, as ``decimal(18,2)``."""
    amounts = [c for c in df.columns if c in ("duration", "total") or c.endswith("_duration")]
    return df.withColumns({c: (F.col(c) * F.lit(Decimal(1) / SCALE)).cast(AMOUNT) for c in amounts})


def _midnight(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp_ntz")


# No event type maps to Sport: a category missing everywhere must still have its column.
EVENTS = TableLog(
    table="events",
    key="event_id",
    contract="user_id",
    app_name="event_type",
    amount="value",
    time="ts",
    codes={
        "TV": ("view",),
        "Movie": ("click",),
        "Relax": ("purchase",),
        "Child": ("signup",),
        "Sport": (),
    },
    start=dt.date(2024, 1, 1),
    end=dt.date(2024, 1, 30),
    split=dt.date(2024, 1, 16),
    level_threshold=0.8,
    low_max=2400,
    high_min=2800,
)

ORDERS = TableLog(
    table="orders",
    key="o_orderkey",
    contract="o_custkey",
    app_name="o_orderpriority",
    amount="o_totalprice",
    time="o_orderdate",
    codes={
        "TV": ("1-URGENT",),
        "Movie": ("2-HIGH",),
        "Relax": ("3-MEDIUM",),
        "Child": ("4-NOT SPECIFIED",),
        "Sport": ("5-LOW",),
    },
    start=dt.date(1995, 1, 1),
    end=dt.date(2001, 8, 1),
    split=dt.date(1998, 4, 1),
    level_threshold=0.004,
    low_max=2_000_000,
    high_min=3_000_000,
)

# Two codes per category, so that a membership list has something to do.
ORDERS_PAIRED: CategoryCodes = {
    "TV": ("1-URGENT", "2-HIGH"),
    "Movie": ("3-MEDIUM", "4-NOT SPECIFIED"),
}
