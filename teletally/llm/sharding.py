"""Shards by fixed virtual slots.

Every record hashes into one of a few thousand slots, once and for all. Bytes and rows are summed
per slot, and a slot map says which shard holds which slot: large slots first, each to the shard
that is lightest so far. The map has a version; rebalancing and growing edit the map, so that only
the rows of moved slots move. Beyond the scan the only shuffle is of row numbers within slots.

The map has one row per slot, so planning it on the driver and broadcasting it is bounded by the
number of slots, whatever the data.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from teletally.llm.common import text_or_empty, utf8
from teletally.storage import file_names, shared_path

SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """Which shard holds which slot, with the sums the plan was made from."""

    version: int
    shards: int
    shard_of: tuple[int, ...]
    bytes_of: tuple[int, ...]
    rows_of: tuple[int, ...]

    def loads(self) -> list[int]:
        """Bytes per shard."""
        total = [0] * self.shards
        for shard, size in zip(self.shard_of, self.bytes_of, strict=True):
            total[shard] += size
        return total

    def first_rows(self) -> list[int]:
        """Place of each slot's first row in its shard: slots follow each other by number."""
        used, first = [0] * self.shards, []
        for shard, rows in zip(self.shard_of, self.rows_of, strict=True):
            first.append(used[shard])
            used[shard] += rows
        return first

    def rebalanced(self, bytes_of: Iterable[int], rows_of: Iterable[int], slack: float = 0.01) -> SlotMap:
        """The next version for new sums: slots leave shards more than ``slack`` above the mean.

        Each move takes the largest slot that fits from the heaviest shard to the lightest one, so
        few slots move; it ends when no move makes the heaviest shard lighter.
        """
        return replace(self, bytes_of=tuple(bytes_of), rows_of=tuple(rows_of))._moved(slack)

    def grown(self, slack: float = 0.01) -> SlotMap:
        """The next version with one more shard; slots only move into the new shard."""
        return replace(self, shards=self.shards + 1)._moved(slack, only_to=self.shards)

    def _moved(self, slack: float, only_to: int | None = None) -> SlotMap:
        shard_of, load = list(self.shard_of), self.loads()
        held: list[list[int]] = [[] for _ in range(self.shards)]
        for slot, shard in enumerate(shard_of):
            held[shard].append(slot)
        for slots in held:
            slots.sort(key=lambda s: (-self.bytes_of[s], s))
        mean = sum(load) / self.shards
        while True:
            heavy = max(range(self.shards), key=lambda s: (load[s], -s))
            light = min(range(self.shards), key=lambda s: (load[s], s)) if only_to is None else only_to
            # A move that overshoots would make the light shard the heavy one.
            room = min(load[heavy] - load[light] - 1, mean * (1 + slack) - load[light])
            slot = next((s for s in held[heavy] if 0 < self.bytes_of[s] <= room), None)
            if heavy == light or load[heavy] <= mean * (1 + slack) or slot is None:
                return replace(self, version=self.version + 1, shard_of=tuple(shard_of))
            held[heavy].remove(slot)
            held[light].append(slot)
            shard_of[slot] = light
            load[heavy] -= self.bytes_of[slot]
            load[light] += self.bytes_of[slot]

    def frame(self, spark: SparkSession) -> DataFrame:
        """The map as a table: version, shards, vslot, shard, bytes, rows, first_row."""
        columns = zip(self.shard_of, self.bytes_of, self.rows_of, self.first_rows(), strict=True)
        rows = [(self.version, self.shards, k, *values) for k, values in enumerate(columns)]
        schema = "version int, shards int, vslot int, shard int, bytes long, rows long, first_row long"
        return spark.createDataFrame(rows, schema)

    @classmethod
    def stored(cls, spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A version out of a stored map, the newest by default."""
        table = spark.read.parquet(path)
        wanted = table.agg(F.max("version")).first()[0] if version is None else version
        rows = sorted(table.where(F.col("version") == wanted).collect(), key=lambda r: r.vslot)
        columns = [tuple(r[name] for r in rows) for name in ("shard", "bytes", "rows")]
        return cls(wanted, rows[0].shards, *columns)

    def store(self, spark: SparkSession, path: str) -> None:
        """Append this version to the stored map."""
        self.frame(spark).coalesce(1).write.mode("append").parquet(path)


def slot_of(*key: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record: a hash of its key, fixed for ever."""
    return F.pmod(F.xxhash64(*key), F.lit(slots).cast("long")).cast("int")


def slot_sums(sized: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot, from rows with ``vslot`` and ``size``."""
    found = sized.groupBy("vslot").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect()
    bytes_of, rows_of = [0] * slots, [0] * slots
    for row in found:
        bytes_of[row.vslot], rows_of[row.vslot] = row["size"], row["rows"]
    return bytes_of, rows_of


def plan_shards(bytes_of: list[int], rows_of: list[int], shards: int) -> SlotMap:
    """Version 1 of a map: large slots first, each to the lightest shard."""
    lightest = [(0, shard) for shard in range(shards)]
    shard_of = [0] * len(bytes_of)
    for slot in sorted(range(len(bytes_of)), key=lambda s: (-bytes_of[s], s)):
        load, shard = heapq.heappop(lightest)
        shard_of[slot] = shard
        heapq.heappush(lightest, (load + bytes_of[slot], shard))
    return SlotMap(1, shards, tuple(shard_of), tuple(bytes_of), tuple(rows_of))


def sized_records(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", slots: int = SLOTS
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``vslot`` of every record.

    The slot comes from id, text checksum and size, so rows that share an id but not a text spread.
    A null text counts as empty (size 8, checksum 0); a null id hashes like any other value.
    """
    crc = F.crc32(utf8(text_column))
    size = F.octet_length(text_or_empty(text_column)).cast("long") + 8
    records = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), size.alias("size"), crc.alias("text_crc32")
    )
    return records.withColumn("vslot", slot_of(F.col("doc_id"), F.col("text_crc32"), F.col("size"), slots=slots))


def next_map(held: SlotMap, bytes_of: list[int], rows_of: list[int], shards: int, slack: float = 0.01) -> SlotMap:
    """The map for new sums: the same one if nothing has changed, else its next version.

    Slots move only into shards that are new, or out of shards that have become too heavy.
    """
    if len(held.shard_of) != len(bytes_of):
        raise ValueError(f"the stored map has {len(held.shard_of)} slots, not {len(bytes_of)}")
    if shards < held.shards:
        raise ValueError(f"the stored map has {held.shards} shards already")
    if (held.bytes_of, held.rows_of, held.shards) == (tuple(bytes_of), tuple(rows_of), shards):
        return held
    grown = replace(held, bytes_of=tuple(bytes_of), rows_of=tuple(rows_of))
    while grown.shards < shards:
        grown = grown.grown(slack)
    return replace(grown.rebalanced(bytes_of, rows_of, slack), version=held.version + 1)


def place(records: DataFrame, stored_map: DataFrame) -> DataFrame:
    """Shard and place in the shard of every record, by a stored version of the map.

    ``records``: doc_id, size, text_crc32, vslot. A slot's rows are numbered by id, then checksum and size; equal rows get
    neighbouring places. Equal rows are counted where they are read, and only the counts are numbered and
    turned into rows again: a row that is there very often is a few counts, not one slot's whole work.
    """
    alike = ["vslot", "doc_id", "text_crc32", "size"]
    counts = records.withColumn("part", F.spark_partition_id()).groupBy(*alike, "part").agg(F.count("*").alias("rows"))
    in_slot = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size", "part")
    before = F.sum("rows").over(in_slot.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("rows")
    held = stored_map.select("vslot", "shard", "first_row")
    joined = counts.withColumn("before", before).join(F.broadcast(held), "vslot")
    first = F.col("first_row") + F.col("before")
    return joined.withColumn("slot", F.explode(F.sequence(first, first + F.col("rows") - 1))).select(*alike, "shard", "slot")


def shard_documents(
    docs: DataFrame, shards: int = 24, slots: int = SLOTS, *, map_path: str | None = None, slack: float = 0.01
) -> DataFrame:
    """All documents in ``shards`` shards of nearly equal bytes.

    ``map_path``: a stored map. If there is one, it is edited: with more ``shards`` than it has, slots move into the new ones
    only, and slots leave a shard that is more than ``slack`` above the mean; the next version is appended. If
    there is none yet, or without a path, a first version is planned and stored.

    Returns doc_id, size, text_crc32, law (``bytes``), shard, slot (place in the shard, gapless from
    0), grown_shard (null under this law), vslot, map_version. Repeated rows are placed one by one;
    an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    records = sized_records(docs, slots=slots)
    sums = slot_sums(records, slots)
    path = map_path or shared_path(spark, "slot-map")
    held = SlotMap.stored(spark, path) if file_names(spark, path) else None
    planned = plan_shards(*sums, shards) if held is None else next_map(held, *sums, shards, slack)
    if held is None or planned.version != held.version:
        planned.store(spark, path)
    stored = spark.read.parquet(path).where(F.col("version") == planned.version)
    return place(records, stored).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
        F.lit(planned.version).alias("map_version"),
    )
