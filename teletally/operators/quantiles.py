"""Exact quantiles of a column too large for one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Of the sketch that finds the first brackets, and the counts per bracket that a task may hold.
_ACCURACY = 10_000
_BINS = 65_536


def _as_integer(df: DataFrame, column: str) -> tuple[Column, int]:
    """The column as an order-preserving bigint, and the factor it was scaled by."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("bigint"), 1
    if isinstance(kind, T.DecimalType):
        factor = 10**kind.scale
        return (F.col(column) * factor).cast("bigint"), factor
    raise TypeError(f"exact quantiles need an integer or decimal column, not {kind.simpleString()}")


def exact_quantiles(df: DataFrame, column: str, fractions: Sequence[float], *, bins: int = _BINS) -> DataFrame:
    """One row with columns ``q0, q1, ...``: linearly interpolated quantiles of ``column``.

    Spark's own ``percentile`` gathers all distinct values in one task. Here a sketch brackets
    the wanted values in one pass, and a second one counts the rows below and per part of each
    bracket, which names the part that holds the wanted rank: a single value, unless a bracket
    is wider than ``bins`` values; then the part is the next bracket. A bracket that misses its
    rank is replaced by the rest of the range on that side. No task holds more than ``bins``
    counts per wanted value. ``df`` is read once per pass: hand in a stored table.
    """
    key, factor = _as_integer(df, column)
    keys = df.select(key.alias("k")).where(F.col("k").isNotNull())
    near = [min(max(f + side * 2 / _ACCURACY, 0.0), 1.0) for f in fractions for side in (-1, 1)]
    ends = F.percentile_approx("k", near, _ACCURACY).alias("ends")
    seen = keys.agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high"), ends).first()
    if not seen.n:
        return df.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(f"q{i}") for i in range(len(fractions))])

    positions = [(seen.n - 1) * f for f in fractions]
    brackets = {}
    for i, position in enumerate(positions):
        for rank in (math.floor(position), math.ceil(position)):
            brackets.setdefault(rank, (seen.ends[2 * i], seen.ends[2 * i + 1]))
    values = {}
    while brackets:
        for rank, (low, high) in _narrowed(keys, brackets, (seen.low, seen.high), bins).items():
            brackets[rank] = low, high
            if low == high:
                values[rank] = brackets.pop(rank)[0]

    found = []
    for i, position in enumerate(positions):
        low, high = math.floor(position), math.ceil(position)
        below, above = values[low] / factor, values[high] / factor
        found.append(F.lit(below * (1 - (position - low)) + above * (position - low)).alias(f"q{i}"))
    return df.sparkSession.range(1).select(*found)


def _narrowed(
    keys: DataFrame, brackets: dict[int, tuple[int, int]], whole: tuple[int, int], bins: int
) -> dict[int, tuple[int, int]]:
    """For every zero-based rank a smaller bracket that holds it, by one counting pass."""
    width = {rank: -(-(high - low + 1) // bins) for rank, (low, high) in brackets.items()}
    parts = []
    for rank, (low, high) in brackets.items():
        # A difference of two bigints may not be one.
        offset = F.col("k").cast("decimal(20,0)") - F.lit(low) if high - low >= 2**63 else F.col("k") - low
        part = F.when(F.col("k") >= low, F.call_function("div", offset, F.lit(width[rank])).cast("bigint")).otherwise(-1)
        parts.append(F.when(F.col("k") <= high, F.struct(F.lit(rank).cast("bigint").alias("rank"), part.alias("part"))))
    counts = keys.select(F.explode(F.array_compact(F.array(*parts))).alias("in")).groupBy("in.rank", "in.part")
    order = Window.partitionBy("rank").orderBy("part")
    counts = counts.agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(order) - F.col("n"))
    holds = F.col("rank").between(F.col("before"), F.col("before") + F.col("n") - 1)
    held = {row.rank: row.part for row in counts.where(holds).select("rank", "part").collect()}
    found = {}
    for rank, (low, high) in brackets.items():
        part = held.get(rank)
        if part is None:
            found[rank] = high + 1, whole[1]
        elif part < 0:
            found[rank] = whole[0], low - 1
        else:
            start = low + part * width[rank]
            found[rank] = start, min(high, start + width[rank] - 1)
    return found
