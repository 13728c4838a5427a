"""Near-duplicates by order MinHash.

A document is the sequence of its five-word shingles, each labelled with its occurrence number, so
that all labels of a document differ. One sketch takes the three labels that a random order of all
labels ranks lowest and keeps them in the order of the text; 16 such sketches make 16 keys. Two
documents share a key only if they have these shingles in common and in the same order, so keys
follow edit similarity where plain MinHash only follows the sets.

Documents that share a key are candidates. A candidate is verified by aligning the two label
sequences: since labels do not repeat, the longest common subsequence is the longest run of
matches that rises on both sides, and matches farther off the diagonal than the allowed number
of insertions and deletions cannot belong to an alignment that reaches the threshold. The
similarity is the aligned share of the union of shingles.

Only classes of equal texts are compared. First every class meets the most connected one of each of its keys, and linked
classes become components. What is left are keys whose classes lie in several components. They are not compared
all with all: two label sets at a similarity of t share a label among the rarest few of each (of n labels, the
n - ceil(t n) + 1 rarest), so only classes meet that have such a rare label in common. What merely shares a
common passage has rarer labels of its own, and never meets. Classes that do meet are sifted by their keys and by counts
of their labels, which bound the similarity from above; what is left is aligned, for each class the most promising
one of every other component first, then all of them. So no pair that shares a key is missed.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from teletally.llm.common import arrow_schema, map_rows, small_table, text_or_empty
from teletally.llm.components import connected_components
from teletally.storage import store

WIDTH = 5
THRESHOLD = 0.8
SKETCHES = 16
KEPT = 3
# Keys that a candidate must share, and those it must share to meet the leader of a key already, which decides
# the work only, not the result.
SHARED_KEYS = 1
ROUND_KEYS = 4
# Leaders of a key, classes in one side of a tile, and buckets of the label counts that bound a similarity from above.
DRAWN = 1
TILE = 2048
BUCKETS = 256
ID_HASHES = 2**19

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_SEEDS = np.array([(k + 1) * 0xD1B54A32D192ED03 % 2**64 for k in range(SKETCHES)], dtype=np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S1, _S2, _S3 = np.uint64(30), np.uint64(27), np.uint64(31)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < size:
        for k, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(2 * size, base, dtype=np.uint64)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers[0], _powers[1]


def mixed(values: np.ndarray) -> np.ndarray:
    """Hash of 64-bit values."""
    values = (values ^ (values >> _S1)) * _M1
    values = (values ^ (values >> _S2)) * _M2
    return values ^ (values >> _S3)


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the lower-case words between ASCII white space."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _power(len(data) + 1)
    inside = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    before = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=before[1:])
    return mixed((before[ends] - before[starts]) * inverse[starts])


def labels(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hashes of all shingles in text order, each with its occurrence number mixed in.

    A text shorter than ``width`` is one shingle, a text without words has none.
    """
    if not len(words):
        return words
    count = max(1, len(words) - width + 1)
    found = np.zeros(count, dtype=np.uint64)
    for k in range(min(width, len(words))):
        found = mixed(found + words[k : k + count] + np.uint64(k + 1))
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    if new.all():
        return found
    at = np.arange(count)
    number = np.empty(count, dtype=np.uint64)
    number[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return np.where(number > 0, mixed(found ^ mixed(number)), found)


def sketch(found: np.ndarray) -> np.ndarray:
    """The keys of one document: each of some lowest-ranked labels, in text order."""
    kept = min(KEPT, len(found))
    ranks = mixed(found[None, :] ^ _SEEDS[:, None])
    if kept < len(found):
        lowest = np.sort(np.argpartition(ranks, kept - 1, axis=1)[:, :kept], axis=1)
    else:
        lowest = np.tile(np.arange(kept), (SKETCHES, 1))
    keys = _SEEDS.copy()
    for k in range(kept):
        keys = mixed(keys + found[lowest[:, k]])
    return keys.view(np.int64)


def aligned_similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Aligned share of the union of two label sequences, 0.0 as soon as it must miss the threshold.

    Of labels that collide within a sequence the first one counts.
    """
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return float(total == 0)
    # The most insertions and deletions that an alignment may have to reach the threshold.
    band = total * (1 - threshold) / (1 + threshold) + 1e-9
    if abs(len(a) - len(b)) > band:
        return 0.0
    _, at_a, at_b = np.intersect1d(a, b, return_indices=True)
    near = np.abs(at_a - at_b) <= band
    at_a, at_b = at_a[near], at_b[near]
    if total - 2 * len(at_a) > band:
        return 0.0
    run = _longest_rise(at_b[np.argsort(at_a)])
    found = run / (total - run)
    return found if total - 2 * run <= band else 0.0


def _longest_rise(values: np.ndarray) -> int:
    """Length of the longest rising subsequence of distinct values."""
    if (values[1:] > values[:-1]).all():
        return len(values)
    tails: list[int] = []
    for value in values.tolist():
        at = bisect_left(tails, value)
        tails[at : at + 1] = [value]
    return len(tails)


def text_key(text_column: str = "text") -> Column:
    """Digest of the text; a null text counts as empty."""
    return F.unhex(F.substring(F.sha2(text_or_empty(text_column).cast("binary"), 256), 1, 32))


def sketches(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``text_key`` (digest of the text) and ``keys`` of every row; a null text counts as empty."""

    def rows(batch: dict[str, list]) -> dict[str, list]:
        return {"doc_id": batch["doc_id"], "text_key": batch["text_key"], "keys": [_keys(t) for t in batch["text"]]}

    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text_key(text_column).alias("text_key"),
        text_or_empty(text_column).alias("text"),
    )
    return map_rows(texts, "doc_id long, text_key binary, keys array<long>", rows)


def _keys(text: str) -> np.ndarray:
    """Keys of a text; none for a text without words, which is like no other."""
    found = labels(word_hashes(text))
    return sketch(found) if len(found) else np.zeros(0, dtype=np.int64)


def _with_labels(texts: DataFrame) -> DataFrame:
    """``node`` and the label sequence as bytes (32 bits a label), from ``node``, ``text``."""

    def rows(batch: dict[str, list]) -> dict[str, list]:
        found = [(labels(word_hashes(text)) >> np.uint64(32)).astype(np.uint32).tobytes() for text in batch["text"]]
        return {"node": batch["node"], "labels": found}

    return map_rows(texts, "node binary, labels binary", rows)


def _verified(pairs: DataFrame, labelled: DataFrame, threshold: float) -> DataFrame:
    """Links among pairs of nodes ``a``, ``b``."""
    schema = "a binary, b binary, similarity double"
    target = arrow_schema(schema)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
            left, right = (
                [np.frombuffer(value.as_buffer(), dtype=np.uint32) for value in part.column(name)]
                for name in ("labels_a", "labels_b")
            )
            found = [aligned_similarity(x, y, threshold) for x, y in zip(left, right, strict=True)]
            kept = [k for k, value in enumerate(found) if value >= threshold]
            columns = {"a": [a[k] for k in kept], "b": [b[k] for k in kept], "similarity": [found[k] for k in kept]}
            yield pa.RecordBatch.from_pydict(columns, schema=target)

    for end in ("a", "b"):
        pairs = pairs.join(labelled.select(F.col("node").alias(end), F.col("labels").alias(f"labels_{end}")), end)
    return pairs.mapInArrow(batches, schema)


def _in_common(x: Column, y: Column) -> Column:
    """Number of sketches that two documents share."""
    same = F.zip_with(x, y, lambda a, b: (a == b).cast("int"))
    return F.aggregate(same, F.lit(0), lambda total, one: total + one)


def _with_leaders(shared: DataFrame, drawn: int, at_least: int) -> DataFrame:
    """Pairs ``a``, ``b`` of each class with the leaders of its keys.

    ``shared``: node, key, weight, keys. The first leader of a key is its most connected class, others are drawn.
    """
    orders = [F.struct("weight", "node"), *[F.xxhash64("node", "key", F.lit(k)) for k in range(1, drawn)]]
    one = F.struct("node", "keys")
    leaders = shared.groupBy("key").agg(F.array(*[F.max_by(one, order) for order in orders]).alias("leaders"))
    met = shared.join(leaders, "key").select("node", "keys", F.explode("leaders").alias("leader"))
    pairs = met.where(
        (F.col("node") != F.col("leader.node")) & (_in_common(F.col("keys"), F.col("leader.keys")) >= at_least)
    )
    ends = F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")
    return pairs.select(*ends).distinct()


def _in_parts(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows with ``part``, the component of their ``node``, itself where it has no link yet."""
    found = rows.join(parts, "node", "left")
    return found.withColumn("part", F.coalesce("component", "node")).drop("component")


def _spanning(rows: DataFrame, by: str) -> DataFrame:
    """Values of a column whose rows lie in several components, and how many rows they have."""
    found = rows.groupBy(by).agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("rows"))
    return found.where("low < high").select(by, "rows")


def _signed(undecided: DataFrame, labelled: DataFrame) -> DataFrame:
    """``size`` of the label sequence, ``counts`` of its labels in buckets and its ``distinct`` labels, beside the rest."""
    schema = "node binary, part binary, keys array<long>, size int, counts binary, distinct array<int>"

    def rows(batch: dict[str, list]) -> dict[str, list]:
        found = [np.frombuffer(value, dtype=np.uint32) for value in batch["labels"]]
        # Counts are cut off at 255, which only lowers their differences.
        counts = [np.minimum(np.bincount(x % BUCKETS, minlength=BUCKETS), 255).astype(np.uint8).tobytes() for x in found]
        kept = {name: batch[name] for name in ("node", "part", "keys")}
        return kept | {"size": [len(x) for x in found], "counts": counts, "distinct": [np.unique(x).view(np.int32) for x in found]}

    return map_rows(undecided.join(labelled, "node").select("node", "part", "keys", "labels"), schema, rows)


def _rarest(signed: DataFrame, threshold: float) -> DataFrame:
    """``node``, ``label``: of each class the rarest labels, one of which it shares with every class at the threshold.

    Only labels that some class of another component has as well; rare is what few of the classes here have.
    """
    words = signed.select("node", "part", F.size("distinct").alias("n"), F.explode("distinct").alias("label"))
    common = words.groupBy("label").agg(
        F.count("*").alias("df"), (F.min("part") < F.max("part")).alias("spans")
    ).where("df > 1")
    held = words.join(common, "label").groupBy("node", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "label", "spans"))).alias("held")
    )
    # Labels that no other class has come first in this order.
    wanted = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1 - (F.col("n") - F.size("held"))
    held = held.withColumn("wanted", wanted.cast("int")).where("wanted > 0")
    found = held.select("node", F.explode(F.expr("slice(held, 1, wanted)")).alias("one"))
    return found.where("one.spans").select("node", "one.label")


class _Tile:
    """Classes of one tile, and the pairs across components that no bound excludes."""

    def __init__(self, rows: list[dict], threshold: float, at_least: int):
        self.rows, self.threshold, self.at_least = rows, threshold, at_least

    def pairs(self, best: bool) -> Iterator[tuple[bytes, bytes]]:
        """All such pairs, or per class and other component the one whose counts differ least."""
        rows, threshold = self.rows, self.threshold
        number = {part: k for k, part in enumerate({r["part"] for r in rows})}
        if len(number) < 2:
            return
        part = np.array([number[r["part"]] for r in rows])
        own = np.array([r["own"] for r in rows])
        apart = rows[0]["first"] != rows[0]["second"]
        size = np.array([r["size"] for r in rows])
        keys = np.array([r["keys"] for r in rows])
        counts = np.frombuffer(b"".join([r["counts"] for r in rows]), dtype=np.uint8).reshape(len(rows), -1).astype(np.int16)
        for i in range(len(rows) - 1):
            # Insertions and deletions that an alignment may have to reach the threshold.
            band = (size[i] + size) * (1 - threshold) / (1 + threshold) + 1e-9
            wanted = (part != part[i]) & (np.abs(size - size[i]) <= band)
            wanted[: i + 1] = False
            if apart:
                wanted &= own != own[i]
            at = np.flatnonzero(wanted)
            at = at[(keys[at] == keys[i]).sum(axis=1) >= self.at_least]
            # Labels that are in one of both only are at least as many as the counts differ.
            far = np.abs(counts[at] - counts[i]).sum(axis=1)
            at, far = at[far <= band[at]], far[far <= band[at]]
            if best and len(at) > 1:
                order = np.lexsort((at, far, part[at]))
                first = np.concatenate(([True], np.diff(part[at][order]) > 0))
                at = at[order[first]]
            for j in at.tolist():
                a, b = rows[i]["node"], rows[j]["node"]
                yield (a, b) if a < b else (b, a)


def _meeting(rare: DataFrame, signed: DataFrame, parts: DataFrame, threshold: float, at_least: int, tile: int, best: bool) -> DataFrame:
    """Pairs ``a``, ``b`` of classes in different components that share a rare label and that no bound excludes."""
    schema = "a binary, b binary"
    target = arrow_schema(schema)

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
        held, held_of = [], None
        for batch in batches:
            for row in batch.to_pylist():
                of = row["label"], row["first"], row["second"]
                if of != held_of and held:
                    yield held
                    held = []
                held_of = of
                held.append(row)
        if held:
            yield held

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for rows in tiles(batches):
            for x, y in _Tile(rows, threshold, at_least).pairs(best):
                a.append(x)
                b.append(y)
                if len(a) == 10_000:
                    yield pa.RecordBatch.from_pydict({"a": a, "b": b}, schema=target)
                    a, b = [], []
        yield pa.RecordBatch.from_pydict({"a": a, "b": b}, schema=target)

    rows = _in_parts(rare, parts)
    # A label of very many classes is compared in square tiles.
    rows = rows.join(_spanning(rows, "label"), "label").withColumn("tiles", F.ceil(F.col("rows") / tile).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", "label"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select(
        "node", "part", "label", "own", F.least("own", "with").alias("first"), F.greatest("own", "with").alias("second")
    )
    rows = rows.join(signed.select("node", "keys", "size", "counts"), "node")
    of = ["label", "first", "second"]
    return rows.repartition(*of).sortWithinPartitions(*of).mapInArrow(found, schema).distinct()


def _joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``node``, ``component`` after more links ``a``, ``b``; only the linked components are searched."""
    for end in ("a", "b"):
        of_end = parts.select(F.col("node").alias(end), "component")
        links = links.join(of_end, end, "left").withColumn(end, F.coalesce("component", end)).select("a", "b")
    found = connected_components(links.distinct())
    moved = found.select(F.col("node").alias("component"), F.col("component").alias("onward"))
    known = parts.join(moved, "component", "left").select("node", F.coalesce("onward", "component").alias("component"))
    new = found.join(parts.select("node"), "node", "left_anti").select("node", "component")
    return store(known.union(new), "parts")


def near_duplicates(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = THRESHOLD,
    shared_keys: int = SHARED_KEYS,
    drawn: int = DRAWN,
    tile: int = TILE,
) -> DataFrame:
    """Groups of exact and near copies: one row per input row.

    Returns doc_id, text_key, class_id (smallest doc_id with the same text), component_id (smallest
    doc_id reachable by links), kept (whether the row is the one that stays for its group: it has the smallest
    doc_id, and of several texts with that id the one whose digest is lowest). Null and empty texts are equal to each
    other and near to nothing. Texts are what is linked: rows that share an id but not the text are compared each for
    itself. Rows without an id are in no group: class and component are null and they are kept. Repeated rows
    get the same row each. An empty table gives an empty result; other columns are ignored.

    ``drawn``: leaders of a key that its classes meet first; ``tile``: classes in one side of a tile. Both decide
    the work only.
    """
    rows = store(sketches(docs, id_column=id_column, text_column=text_column), "sketches")
    named = rows.where(F.col("doc_id").isNotNull())
    classes = named.groupBy(F.col("text_key").alias("node")).agg(F.min("doc_id").alias("class_id"), F.first("keys").alias("keys"))
    classes = store(classes, "classes")
    keyed = classes.select("node", F.explode("keys").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    in_company = keyed.join(sizes, "key").groupBy("node").agg(F.sum(F.col("size") - 1).alias("weight"))
    company = store(classes.join(in_company, "node").select("node", "keys", "weight"), "candidates")

    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), text_key(text_column).alias("node"), text_or_empty(text_column).alias("text")
    )
    # Most texts have no company. Filters by hashed key before the shuffle: at most ``ID_HASHES`` numbers.
    hashed = F.pmod(F.xxhash64("node"), F.lit(ID_HASHES).cast("long")).cast("int").alias("hashed")
    texts = texts.where("doc_id IS NOT NULL").withColumn("hashed", hashed)
    texts = texts.join(F.broadcast(company.select(hashed).distinct()), "hashed", "left_semi")
    # One row per text before the shuffle, whatever the number of its copies.
    texts = texts.groupBy("node").agg(F.first("text").alias("text")).join(company.select("node"), "node", "left_semi")
    labelled = store(_with_labels(texts), "labels")
    shared = company.select("node", "weight", "keys", F.explode("keys").alias("key")).join(sizes.select("key"), "key")
    shared = store(shared, "shared-keys")

    parts = small_table(docs.sparkSession, [], "node binary, component binary")
    pairs = _with_leaders(shared, drawn, max(shared_keys, ROUND_KEYS))
    links = store(_verified(pairs, labelled, threshold), "near-links")
    if not links.isEmpty():
        parts = _joined(parts, links.select("a", "b"))

    placed = _in_parts(shared.select("node", "key"), parts)
    undecided = placed.join(_spanning(placed, "key"), "key", "left_semi").select("node", "part").distinct()
    signed = store(_signed(undecided.join(company.select("node", "keys"), "node"), labelled), "signed")
    rare = store(_rarest(signed, threshold), "rare-labels")
    for best in (True, False):
        pairs = store(_meeting(rare, signed, parts, threshold, shared_keys, tile, best), "met")
        links = store(_verified(pairs, labelled, threshold), "near-links")
        if not links.isEmpty():
            parts = _joined(parts, links.select("a", "b"))

    grouped = classes.join(parts, "node", "left").select("node", "class_id", F.coalesce("component", "node").alias("component"))
    heads = grouped.groupBy("component").agg(F.min(F.struct("class_id", "node")).alias("head"))
    # Stored, so that the join deals out both sides anew and Spark can split a text with very many copies.
    grouped = store(grouped.join(heads, "component"), "groups").select(
        F.col("node").alias("text_key"),
        "class_id",
        F.col("head.class_id").alias("component_id"),
        (F.col("node") == F.col("head.node")).alias("is_head"),
    )
    named = named.select("doc_id", "text_key").join(grouped, "text_key")
    kept = F.col("is_head") & (F.col("doc_id") == F.col("component_id"))
    unnamed = rows.where(F.col("doc_id").isNull()).select(
        "doc_id", "text_key", F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(True)
    )
    return named.select("doc_id", "text_key", "class_id", "component_id", kept.alias("kept")).union(unnamed)


def without_near_duplicates(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The table with one row of each group: all columns, in order, whatever their names.

    Rows without an id all stay; an empty table stays empty. Of repeated rows of the id and text that stay,
    the one whose values hash lowest.
    """
    groups = near_duplicates(docs, id_column=id_column, text_column=text_column)
    stay = groups.where(F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id", "text_key").distinct()
    whole = F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in docs.columns]).alias("row")
    rows = docs.select(whole, F.col(id_column).cast("long").alias("doc_id"), text_key(text_column).alias("text_key"))
    first = Window.partitionBy("doc_id", "text_key").orderBy(F.xxhash64("row"))
    chosen = rows.join(stay, ["doc_id", "text_key"], "left_semi").withColumn("place", F.row_number().over(first))
    return chosen.where("place = 1").select("row.*").union(rows.where("doc_id IS NULL").select("row.*"))
