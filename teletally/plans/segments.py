"""Customer groups and their sizes."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teletally.functions.scores import activity_level
from teletally.schema import CATEGORIES

# Label of a dimension that is summed over.
ALL = "All"
LEVELS = ("High", "Low")


def customer_group(profile: DataFrame, threshold: float) -> DataFrame:
    """Most-watched category, taste and activity level per contract, and the three as one label."""
    parts = profile.select(
        "contract",
        "most_watch",
        "customer_taste",
        activity_level(F.col("active_rate"), threshold).alias("active_level"),
    )
    label = F.concat_ws(" , ", "most_watch", "customer_taste", "active_level")
    return parts.withColumn("customer_group", label)


def segment_counts(groups: DataFrame) -> DataFrame:
    """Number of customers per group."""
    return groups.groupBy("most_watch", "customer_taste", "active_level").agg(F.count("*").alias("customers"))


def segment_dimensions(groups: DataFrame) -> DataFrame:
    """How many most-watched values, tastes and levels occur (one row).

    Counted over the distinct groups, of which there are at most 5 x 32 x 2.
    """
    return segment_counts(groups).agg(
        F.count_distinct("most_watch").alias("most_watch_values"),
        F.count_distinct("customer_taste").alias("taste_values"),
        F.count_distinct("active_level").alias("level_values"),
        F.sum("customers").alias("customers"),
    )


def tastes() -> list[str]:
    """Every taste that can occur: the categories in fixed order, any of them, or none."""
    return ["-".join(some) for n in range(len(CATEGORIES) + 1) for some in combinations(CATEGORIES, n)]


def segment_cube(groups: DataFrame) -> DataFrame:
    """Number of customers of every cell and every total of most-watched, taste and level, empty ones included.

    The groups are counted first, by one shuffle of at most a few hundred rows a task; totals are grouping sets
    over those counts. Cells that no customer is in come from a grid of 6 x 33 x 3 rows made of the fixed categories.
    A customer without a most-watched category or a level is in the totals over that dimension only.
    """
    dimensions = {"most_watch": list(CATEGORIES), "customer_taste": tastes(), "active_level": list(LEVELS)}
    counts = segment_counts(groups).cube(*dimensions).agg(
        F.sum("customers").alias("customers"), *[F.grouping(d).alias(f"{d}_all") for d in dimensions]
    )
    labels = [F.when(F.col(f"{d}_all") == 1, ALL).otherwise(F.col(d)).alias(d) for d in dimensions]
    counts = counts.select(*labels, "customers")
    grid = groups.sparkSession.range(1).drop("id")
    for name, values in dimensions.items():
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(v) for v in (*values, ALL)])))
    found = grid.join(counts, list(dimensions), "left")
    return found.select(*dimensions, F.coalesce("customers", F.lit(0).cast("bigint")).alias("customers"))
