"""Metrics joined back to finer rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A contract is split off when it holds more rows than this ...
SPLIT_ROWS = 1_000_000
# ... and more than one part in this many of all rows, so fewer contracts than this can qualify.
MAX_HOT_CONTRACTS = 100_000


def attach(rows: DataFrame, *metrics: DataFrame) -> DataFrame:
    """Left join of contract-grain metrics to rows, one after the other.

    Every metric frame holds one row per contract, so the row count does not change. All
    sides are hashed on contract and a left join keeps that partitioning: the rows are
    shuffled once for the whole chain. Meant for rows with few per contract, such as one
    per day; see ``attach_to_sessions`` for raw sessions.
    """
    return reduce(lambda joined, metric: joined.join(metric, "contract", "left"), metrics, rows)


def attach_to_sessions(
    sessions: DataFrame,
    metrics: DataFrame,
    *,
    split_rows: int = SPLIT_ROWS,
    max_hot: int = MAX_HOT_CONTRACTS,
) -> DataFrame:
    """Left join of contract-grain metrics to raw sessions, safe for very large contracts.

    ``metrics`` holds the session count ``n_sessions`` beside its other columns and is read
    three times: hand in a stored table. A contract above the split size is spread over
    several reducers: its sessions get a salt, its metric row one copy per salt. The list of
    such contracts is broadcast; each holds more than 1/``max_hot`` of all sessions, so there
    are fewer than ``max_hot`` of them however large the log is.

    The salt mixes the row's hash with the number of its scan partition. Equal rows are
    spread as well, and a repeated task sends each row to the same reducer as before.
    Sessions without a contract match nothing and are spread freely.
    """
    share = metrics.select(F.sum("n_sessions").cast("double") / F.lit(max_hot)).scalar()
    size = F.greatest(F.lit(float(split_rows)), share)
    splits = F.ceil(F.col("n_sessions") / size).cast("bigint")
    sized = metrics.withColumn("splits", splits).drop("n_sessions")
    hot = F.broadcast(sized.where(F.col("splits") > 1).select("contract", "splits"))

    place = F.xxhash64(*[F.col(c) for c in sessions.columns], F.spark_partition_id())
    none = F.lit(0).cast("bigint")
    salt = F.when(F.col("contract").isNull(), place).otherwise(F.coalesce(F.pmod(place, F.col("splits")), none))
    salted = sessions.join(hot, "contract", "left").withColumn("salt", salt).drop("splits")
    copies = F.explode(F.sequence(none, F.col("splits") - 1))
    copied = sized.withColumn("salt", copies).drop("splits")
    return salted.join(copied, ["contract", "salt"], "left").drop("salt")
