"""Hard negatives by the threshold algorithm.

For every dimension the candidates of a block stand in a list sorted by their component. For an anchor each list is
read from its best end, the top where the anchor's component is positive and the bottom where it is negative, some
rows at a time; rows not seen before are scored in full by random access. The sum over all dimensions of the
anchor's component times the last component read is the most that an unseen row can score. As soon as it
falls strictly below the k-th score of every window that is being filled (or below a window that is not full),
the block is done; strictly, because an unseen row of equal score and smaller id would come first.

A window is a range of scores with a number of places. There are two rounds: an anchor's positives are one
window over the other rows of its label; each of its positives then opens a window over the rows of other labels.

All is integer arithmetic. Anchors and candidates are cut into blocks of bounded size by the hash of the row, so no
task holds more than one block of each, however many rows share a label; every pair of blocks returns at most k
rows a window, and these are merged by rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from teletally.llm.common import arrow_schema
from teletally.storage import store

POSITIVES = 5
NEGATIVES = 3
SCALE = 256
# What a negative must reach of its positive's score and may not exceed, in hundredths.
LOW, HIGH = 50, 95
# Rows in a block of candidates and of anchors, and rows of each list that are read at first.
CANDIDATES = 8192
ANCHORS = 1024
STEP = 16
# Bound of a vector's length: its scores, and a hundred times them, then fit in 64 bits.
LONGEST = 2**28

_LEAST, _MOST = -(2**63), 2**63 - 1
_HITS = "anchor_row long, number long, row long, vec_id long, score long"


def quantised(vectors: DataFrame, *, scale: int = SCALE) -> DataFrame:
    """``row`` (names the input row), ``vec_id``, ``label``, ``size``, ``vector`` (32-bit integers as bytes).

    A component x becomes floor(``scale`` * x), x as double. Left out: rows whose id, label or vector is null, and
    vectors with a null or non-finite component. A vector longer than 2**28 after scaling raises an error.
    """
    schema = "row long, vec_id long, label long, size int, vector binary"
    target = arrow_schema(schema)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found: list[list] = [[], [], [], [], []]
            for row, vec_id, label, vector in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):
                values = np.array([math.nan if x is None else x for x in vector], dtype=np.float64)
                if not np.isfinite(values).all():
                    continue
                whole = np.floor(scale * values)
                if np.abs(whole).max(initial=0) * math.sqrt(len(whole)) >= LONGEST:
                    raise ValueError(f"vector {vec_id} is too long for scores in 64 bits")
                for column, value in zip(found, (row, vec_id, label, len(whole), whole.astype("<i4").tobytes())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, target)], schema=target)

    wanted = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    return wanted.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").mapInArrow(batches, schema)


class Lists:
    """A block of candidates, with one sorted list per dimension."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        # By id, so that the position breaks ties.
        order = np.lexsort((rows, ids))
        self.rows, self.ids, self.labels, self.vectors = rows[order], ids[order], labels[order], vectors[order]
        self.order = np.argsort(self.vectors, axis=0, kind="stable").T.copy()
        # Doubles hold these integers, and sums of their products up to 2**53, exactly; they multiply much faster.
        self.exact = self.vectors.astype(np.float64)
        self.longest = float(np.sqrt((self.exact**2).sum(axis=1)).max(initial=0))

    def _scores(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Inner products of some rows with the anchor."""
        if self.longest * math.sqrt(float((anchor.astype(np.float64) ** 2).sum())) < 2**52:
            return (self.exact[at] @ anchor.astype(np.float64)).astype(np.int64)
        return self.vectors[at] @ anchor

    def best(
        self, anchor: np.ndarray, windows: np.ndarray, places: int, barred: np.ndarray, step: int = STEP
    ) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        """Per window the positions and scores of its best rows; also, how many rows were scored.

        ``windows``: lowest and highest score of each. ``barred``: rows that are no candidates of this anchor.
        """
        count = len(self.rows)
        used = np.flatnonzero(anchor)
        weights = anchor[used]
        # Rows not seen yet, and what a step has read of them.
        unseen, read_now = np.ones(count, dtype=bool), np.zeros(count, dtype=bool)
        left = count
        none = np.zeros(0, dtype=np.int64)
        held = [(none, none)] * len(windows)
        depth = scored = 0
        while left:
            if len(used):
                ranks = np.arange(depth, min(depth + step, count))
                from_top = np.where((weights > 0)[:, None], count - 1 - ranks, ranks)
                read = self.order[used[:, None], from_top]
                most = int(weights @ self.vectors[read[:, -1], used])
                read_now[read] = True
                fresh = np.flatnonzero(read_now & unseen)
                depth, step = depth + len(ranks), 2 * step
            else:
                # Every row scores 0, and no list tells rows apart.
                fresh, most = np.arange(count), 0
            unseen[fresh] = False
            left -= len(fresh)
            fresh = fresh[~barred[fresh]]
            scores = self._scores(fresh, anchor)
            scored += len(fresh)
            for w, (at, value) in enumerate(held):
                fits = (scores >= windows[w, 0]) & (scores <= windows[w, 1])
                if fits.any():
                    at, value = np.concatenate([at, fresh[fits]]), np.concatenate([value, scores[fits]])
                    first = np.lexsort((at, -value))[:places]
                    held[w] = at[first], value[first]
            if all(most < (v[-1] if len(v) == places else low) for (_, v), low in zip(held, windows[:, 0], strict=True)):
                break
        return held, scored


def _matrix(values: pd.Series, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype="<i4").reshape(len(values), size).astype(np.int64)


def _met(asked: DataFrame, given: DataFrame, places: int, same_label: bool) -> DataFrame:
    """The best rows of every window, over all blocks.

    ``asked``: row, label, size, vector, windows (number, low, high, number, ... as longs); ``given``: row, vec_id,
    label, size, vector. Only rows of equal size meet. ``same_label``: rows of the anchor's label but not itself,
    else rows of other labels. Returns ``_HITS`` and ``rank`` up to ``places``.
    """
    # Blocks of one label each, or of all labels; whatever the label, a block holds a bounded number of rows.
    group = ["size", "label"] if same_label else ["size"]
    hashed = F.xxhash64("row")
    blocks = given.groupBy(*group).agg(F.ceil(F.count("*") / F.lit(CANDIDATES)).cast("int").alias("blocks"))
    of_blocks = asked.groupBy(*group).agg(F.ceil(F.count("*") / F.lit(ANCHORS)).cast("int").alias("of_blocks"))
    both = store(blocks.join(of_blocks, group), "block-counts")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Every row, in a block of its own kind, once for each block of the other kind."""
        rows = rows.join(both, group).withColumn(own, F.pmod(hashed, F.col(f"{own}s")).cast("int"))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))

    def found(key: tuple, ask: pd.DataFrame, give: pd.DataFrame) -> pd.DataFrame:
        columns: list[list] = [[], [], [], [], []]
        if len(ask) and len(give):
            size = int(key[0])
            rows, ids, labels = (give[c].to_numpy() for c in ("row", "vec_id", "label"))
            lists = Lists(rows, ids, labels, _matrix(give["vector"], size))
            anchors = _matrix(ask["vector"], size)
            for row, label, limits, anchor in zip(ask["row"], ask["label"], ask["windows"], anchors, strict=True):
                limits = np.asarray(limits, dtype=np.int64).reshape(-1, 3)
                barred = lists.rows == row if same_label else lists.labels == label
                best, _ = lists.best(anchor, limits[:, 1:], places, barred)
                for number, (at, scores) in zip(limits[:, 0].tolist(), best, strict=True):
                    hits = [row] * len(at), [number] * len(at), lists.rows[at], lists.ids[at], scores
                    for column, values in zip(columns, hits, strict=True):
                        column.extend(values)
        names = [part.split()[0] for part in _HITS.split(", ")]
        return pd.DataFrame({n: np.array(c, dtype=np.int64) for n, c in zip(names, columns, strict=True)})

    keys = [*group, "block", "of_block"]
    own = ["row", "vector"] if same_label else ["row", "vector", "label"]
    left = dealt(asked, "of_block", "block").select(*keys, *own, "windows")
    right = dealt(given, "block", "of_block").select(*keys, *own, "vec_id")
    # Both sides come of one table; new names tell their columns apart.
    left, right = (side.toDF(*side.columns) for side in (left, right))
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(found, _HITS)
    rank = F.row_number().over(Window.partitionBy("anchor_row", "number").orderBy(F.desc("score"), "vec_id", "row"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= places)


def _hundredths(value: Column, up: bool) -> Column:
    """A hundredth of a long, rounded up or down, in integers."""
    value = -value if up else value
    down = F.call_function("div", value - F.pmod(value, F.lit(100)), F.lit(100).cast("long"))
    return -down if up else down


def mine(
    vectors: DataFrame,
    *,
    anchor: Column | None = None,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``anchor``: condition on vec_id that makes a row an anchor (by default, divisible by 50). ``label``: the label to
    use, from vec_id and label (by default, the table's). A score is the inner product of the scaled vectors. An
    anchor's positives are the ``positives`` highest other rows of its label; for each, the ``negatives`` highest
    rows of other labels are given whose score is between ``low`` and ``high`` hundredths of the positive's.
    Equal scores come by smaller vec_id.

    Rows left out by ``quantised`` take no part. Only vectors of one size are compared. Repeated rows and ids are rows of
    their own: each is an anchor, and a positive of the others. Anchors without positives, and positives without
    negatives, give no rows. An empty table gives an empty result; other columns are ignored.
    """
    rows = quantised(vectors, scale=scale)
    if label is not None:
        rows = rows.withColumn("label", label.cast("long")).where("label IS NOT NULL")
    rows = store(rows, "quantised")
    anchors = rows.where(F.col("vec_id") % 50 == 0 if anchor is None else anchor).withColumnRenamed("vec_id", "anchor_id")

    every = F.array(F.lit(0), F.lit(_LEAST), F.lit(_MOST)).cast("array<long>")
    near = store(_met(anchors.withColumn("windows", every), rows, positives, True), "positives")

    limits = F.col("rank").cast("long"), _hundredths(F.col("score") * low, True), _hundredths(F.col("score") * high, False)
    wanted = near.select("anchor_row", F.array(*limits).alias("window")).where("window[1] <= window[2]")
    wanted = wanted.groupBy("anchor_row").agg(F.flatten(F.collect_list("window")).alias("windows"))
    asked = anchors.join(wanted, F.col("row") == F.col("anchor_row"))
    hits = _met(asked.select("row", "label", "size", "vector", "windows"), rows, negatives, False)

    of = near.select("anchor_row", F.col("rank").alias("number"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = hits.join(of, ["anchor_row", "number"])
    named = named.join(anchors.select(F.col("row").alias("anchor_row"), "anchor_id"), "anchor_row")
    return named.select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def seventh_relabelled() -> Column:
    """The label of the query: every seventh row's is one further, of ten."""
    moved = (F.col("label") + 1) % 10
    return F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))
