"""Active days as bit sets, for logs without negative durations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from teletally.functions.dates import days_between, parse_day

# Days per bigint; the sign bit stays unused.
_WIDTH = 63


class DayMarks:
    """Aggregates that mark the active days of a period, and the count of the marks."""

    def __init__(self, start: str | dt.date, end: str | dt.date) -> None:
        self.start = parse_day(start)
        self.days = days_between(start, end)
        self.names = [f"marks_{i}" for i in range(-(-self.days // _WIDTH))]

    def aggregates(self) -> list[Column]:
        """One bit set per 63 days of the period, over rows with ``duration`` and ``log_date``."""
        duration = F.col("duration")
        offset = F.date_diff("log_date", F.lit(self.start))
        active = (
            F.when(duration < 0, F.raise_error(F.lit("negative duration")))
            .when(
                offset.isNull() | ~offset.between(0, self.days - 1),
                F.raise_error(F.lit("session outside the period")),
            )
            .otherwise(duration > 0)
        )
        marks = []
        for i, name in enumerate(self.names):
            place = offset - F.lit(i * _WIDTH)
            bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
            marks.append(F.bit_or(F.when(active & place.between(0, _WIDTH - 1), bit)).alias(name))
        return marks

    def count(self) -> Column:
        """Number of marked days, out of the aggregated columns."""
        counts = [F.coalesce(F.bit_count(name), F.lit(0)) for name in self.names]
        return sum(counts[1:], counts[0]).cast("bigint")

    def count_in(self, first: Column, last: Column) -> Column:
        """Number of marked days between two offsets from the period's start, both included."""
        counts = []
        for i, name in enumerate(self.names):
            low = F.greatest(first - i * _WIDTH, F.lit(0))
            high = F.least(last - i * _WIDTH, F.lit(_WIDTH - 1))
            # As many ones as there are days, moved to the first of them.
            ones = F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), F.lit(63) - (high - low))
            wanted = F.call_function("shiftleft", ones, low)
            counts.append(F.when((low <= high) & F.col(name).isNotNull(), F.bit_count(F.col(name).bitwiseAND(wanted))).otherwise(0))
        return sum(counts[1:], counts[0]).cast("bigint")
