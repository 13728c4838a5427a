"""Mixing sources to target weights by Pfair scheduling.

Every source is a stream of blocks of ``block_bytes``. Weights are whole numbers that add up to a
period; in a period of that many turns, the j-th block of a source with weight w is released at
turn ``floor(j * period / w)`` and due before turn ``ceil((j + 1) * period / w)``. Among released
blocks the one due first takes the turn. The windows of a fair schedule can all be kept on one
line, so after any number of turns every source is less than one block away from its share.

The schedule of one period is all that is computed outside the data, and it repeats: block j of a
source takes turn ``period * (j div w) + turn[source, j mod w]``. Documents therefore find their
turns by a join with one period (bounded by its length), not by a sequential merge. A source that
ends before the others begins anew with its first block, until every source has been through once:
no document is dropped.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from teletally.llm.common import small_table, text_or_empty
from teletally.storage import store

PERIOD = 1000
# Sources that one schedule may have: it is made on the driver and broadcast, 16 turns a source.
MAX_SOURCES = 10_000
BLOCK_BYTES = 16 * 1024
FLATTEN = 0.9


def whole_weights(shares: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Weights as whole numbers with the sum ``period``, by largest remainder, at least 1 each."""
    total = sum(shares.values())
    spare = period - len(shares)
    if spare < 0:
        raise ValueError("the period must have a turn for every source")
    exact = {k: spare * v / total for k, v in shares.items()}
    found = {k: 1 + int(v) for k, v in exact.items()}
    by_rest = sorted(exact, key=lambda k: (int(exact[k]) - exact[k], k))
    for k in by_rest[: period - sum(found.values())]:
        found[k] += 1
    return found


def fair_turns(weights: Mapping[str, int]) -> list[tuple[str, int, int]]:
    """One period by earliest deadline first: (source, index of its block, turn)."""
    period = sum(weights.values())
    waiting = [(0, source, 0) for source in sorted(weights)]
    heapq.heapify(waiting)
    released: list[tuple[int, str, int]] = []
    found = []
    for turn in range(period):
        while waiting and waiting[0][0] <= turn:
            _, source, index = heapq.heappop(waiting)
            due = -(-(index + 1) * period // weights[source])
            heapq.heappush(released, (due, source, index))
        _, source, index = heapq.heappop(released)
        found.append((source, index, turn))
        if index + 1 < weights[source]:
            heapq.heappush(waiting, ((index + 1) * period // weights[source], source, index + 1))
    return found


def source_key(source: Column) -> Column:
    """Name of a source; rows without one form a source of their own."""
    return F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source.cast("string")))


def bucket_of(doc_id: Column) -> Column:
    """Part of a source's stream, one of 4,096 by a digest of the id, so that no source is one task."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 3), 16, 10).cast("int")


def mix(
    docs: DataFrame,
    shares: Mapping[str, float] | None = None,
    *,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    period: int = PERIOD,
    block_bytes: int = BLOCK_BYTES,
    max_epochs: int | None = None,
    max_sources: int = MAX_SOURCES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Documents in mixed order, sources to their target weights.

    ``shares``: weight of each source by its name (``None`` for rows without one); by default
    the source's bytes to the power 0.9, which takes from the largest source and gives to the small
    ones. They become whole numbers that add up to ``period``, or to 16 for each source where that is more. A source
    with no weight given, or one that is not positive, raises, and so do more than ``max_sources`` sources.

    ``max_epochs``: how often a source may be gone through; its turns stay empty after that. Without it, sources that
    end early begin anew until every source has been through once, however often that is.

    Returns doc_id, source, bytes, block (within the source), epoch (0: the first time through the
    source), turn, place (position in the turn), and the columns in ``keep``. A document belongs to the
    block in which its first byte lies, so a document longer than a block leaves later blocks empty.
    A null text has 0 bytes. Repeated rows take their places one by one. An empty table gives an
    empty result. Keeping a column whose name is one of those added here raises; ``mixed_rows`` keeps any.
    """
    clash = {"bytes", "block", "epoch", "turn", "place"} & set(keep)
    if clash:
        raise ValueError(f"columns cannot be kept under these names: {sorted(clash)}")
    found = _mixed(docs, shares, id_column, source_column, text_column, period, block_bytes, max_epochs, max_sources, keep)
    kept = [F.col("_kept")[c].alias(c) for c in keep if c not in ("doc_id", "source")]
    return found.select("doc_id", "source", "bytes", "block", "epoch", "turn", "place", *kept)


def mixed_rows(
    docs: DataFrame,
    shares: Mapping[str, float] | None = None,
    *,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    period: int = PERIOD,
    block_bytes: int = BLOCK_BYTES,
    max_epochs: int | None = None,
    max_sources: int = MAX_SOURCES,
) -> DataFrame:
    """The rows of the table, all columns whatever their names, sorted in mixed order; arguments as of ``mix``."""
    keep = tuple(docs.columns)
    found = _mixed(docs, shares, id_column, source_column, text_column, period, block_bytes, max_epochs, max_sources, keep)
    ordered = found.repartitionByRange("turn", "place").sortWithinPartitions("turn", "place", "doc_id")
    return ordered.select("_kept.*")


def _mixed(
    docs: DataFrame,
    shares: Mapping[str, float] | None,
    id_column: str,
    source_column: str,
    text_column: str,
    period: int,
    block_bytes: int,
    max_epochs: int | None,
    max_sources: int,
    keep: tuple[str, ...],
) -> DataFrame:
    """The columns of ``mix``, and those in ``keep`` as the struct ``_kept``."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        F.octet_length(text_or_empty(text_column)).cast("long").alias("bytes"),
        source_key(F.col(source_column)).alias("_key"),
        bucket_of(F.col(id_column)).alias("_bucket"),
        # One struct, so that kept columns never clash with those used here.
        *([F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in keep]).alias("_kept")] if keep else []),
    )
    # At most 4,096 rows a source; the driver sees one row per source, of a bounded number of them.
    sums = store(rows.groupBy("_key", "_bucket").agg(F.sum("bytes").alias("total")), "source-parts")
    by_source = sums.groupBy("_key").agg(F.sum("total").alias("total")).limit(max_sources + 1)
    totals = {r["_key"]: r["total"] for r in by_source.collect()}
    if len(totals) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    by_part = Window.partitionBy("_key").orderBy("_bucket")
    starts = sums.select("_key", "_bucket", (F.sum("total").over(by_part) - F.col("total")).alias("_first"))
    weights = _weights(totals, shares, max(period, 16 * len(totals)))
    blocks = {key: max(1, -(-total // block_bytes)) for key, total in totals.items()}
    turns = fair_turns(weights) if weights else []
    turn_of = {(key, index): turn for key, index, turn in turns}
    length = sum(weights.values())
    # The run ends when the last source has been through once.
    end = max(
        (length * ((n - 1) // weights[k]) + turn_of[k, (n - 1) % weights[k]] + 1 for k, n in blocks.items()), default=0
    )
    plan = [(k, weights[k], blocks[k]) for k in weights]
    plan = small_table(spark, plan, "_key string, _weight long, _blocks long")
    period_table = small_table(spark, turns, "_key string, _index long, _turn long")

    order = ["doc_id", "bytes"]
    in_bucket = Window.partitionBy("_key", "_bucket").orderBy(*order)
    before = F.sum("bytes").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes")
    placed = (
        rows.withColumn("_before", before)
        .join(starts, ["_key", "_bucket"])
        .join(F.broadcast(plan), "_key")
        .withColumn("_start", F.col("_first") + F.col("_before"))
        # A text of no bytes behind the last byte of its source belongs to the last block.
        .withColumn("block", F.least(F.expr(f"_start div {block_bytes}"), F.col("_blocks") - 1))
    )
    # Last epoch that can begin before the end; the exact test follows once the turn is known.
    most = F.expr(f"({end} div {max(length, 1)} + 1) * _weight div _blocks")
    repeated = (
        placed.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), most)))
        .withColumn("_number", F.col("epoch") * F.col("_blocks") + F.col("block"))
        .withColumn("_index", F.col("_number") % F.col("_weight"))
        .join(F.broadcast(period_table), ["_key", "_index"])
        .withColumn("turn", F.expr(f"(_number div _weight) * {length} + _turn"))
        .where(F.col("turn") < end)
    )
    if max_epochs is not None:
        repeated = repeated.where(F.col("epoch") < max_epochs)
    return repeated.withColumn("place", F.col("_start") - F.col("block") * block_bytes)


def _weights(totals: dict[str, int], shares: Mapping[str, float] | None, period: int) -> dict[str, int]:
    if not totals:
        return {}
    if shares is None:
        return whole_weights({k: max(v, 1) ** FLATTEN for k, v in totals.items()}, period)
    named = {("null" if k is None else f"={k}"): v for k, v in shares.items()}
    missing = [k for k in totals if named.get(k, 0) <= 0]
    if missing:
        raise ValueError(f"no positive weight for {missing}")
    return whole_weights({k: named[k] for k in totals}, period)
