"""Hard negatives against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from teletally.llm import hard_negatives, queries
from tests.compare import duck, duck_rows, spark_rows

SCHEMA = "vec_id long, embedding array<double>, label int, score string, row string, block string, vector string"


def frame(spark, rows):
    """Rows of (id, vector, label) beside columns of clashing names."""
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


def mined(rows, positives=5, negatives=3, low=50, high=95):
    """By plain Python over all rows."""
    usable = []
    for number, (i, vector, label) in enumerate(rows):
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((number, i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in vector]))
    found = []
    for number, i, label, v in usable:
        if i % 50:
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w)), j, other, k)
            for other, j, k, w in usable
            if other != number and len(w) == len(v)
        ]
        for s, j, _, _ in sorted(r for r in scored if r[3] == label)[:positives]:
            fits = sorted(r for r in scored if r[3] != label and low * -s <= 100 * -r[0] <= high * -s)
            found += [(i, j, rank + 1, r[1], -s, -r[0]) for rank, r in enumerate(fits[:negatives])]
    return sorted(found)


def got(frame):
    columns = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    assert frame.columns == list(columns)
    return sorted(tuple(r) for r in frame.collect())


def clustered(seed, count, size, labels, spread=0.5):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels, size))
    rows = []
    for i in range(count):
        label = int(rng.integers(labels))
        rows.append((i, (centres[label] + spread * rng.standard_normal(size) + 0.5).round(3).tolist(), label))
    return rows


ODD = [
    (0, [0.5, 0.5], 1),
    (0, [0.5, 0.5], 1),
    (0, [0.5, 0.25], 1),
    (1, [0.5, 0.5], 1),
    (2, [0.4, 0.4], 2),
    (3, [0.4, 0.4], 3),
    (4, [0.4, 0.4], 2),
    (4, [0.4, 0.4], 2),
    (5, [0.3, 0.3], None),
    (6, None, 1),
    (8, [], 1),
    (50, [], 1),
    (51, [], 2),
    (9, [None, 0.1], 1),
    (10, [math.nan, 0.1], 1),
    (11, [math.inf, 0.1], 2),
    (None, [0.4, 0.4], 2),
    (100, [0.0, 0.0], 1),
    (150, [-0.5, -0.5], 1),
    (200, [0.1, 0.2, 0.3], 1),
    (13, [0.1, 0.2, 0.3], 1),
    (12, [-0.1, 0.2, 0.3], 4),
    (-50, [0.5, -0.5], 3),
    (-7, [0.5, -0.3], 3),
]


def relabelled(table):
    return got(hard_negatives.mine(table, label=hard_negatives.seventh_relabelled()))


def test_odd_rows(spark):
    wanted = mined(ODD)
    assert wanted and relabelled(frame(spark, ODD)) == wanted
    assert relabelled(frame(spark, [])) == []
    assert relabelled(frame(spark, [(1, [0.5], 1), (3, [0.4], 2)])) == []


@pytest.mark.parametrize(("candidates", "anchors", "size"), [(8192, 1024, 8), (40, 3, 5), (7, 1, 3)])
def test_any_blocks(spark, monkeypatch, candidates, anchors, size):
    monkeypatch.setattr(hard_negatives, "CANDIDATES", candidates)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    rows = clustered(1, 400, size, 6)
    # A third of the rows are the same vector under one label, with many ties.
    rows += [(1000 + i, rows[0][1], 3) for i in range(200)]
    wanted = mined(rows)
    assert len(wanted) > 30 and relabelled(frame(spark, rows)) == wanted


def test_other_anchors_places_and_windows(spark):
    rows = clustered(2, 150, 6, 4)
    found = hard_negatives.mine(
        frame(spark, rows), anchor=F.col("vec_id") % 50 == 0, positives=2, negatives=4, low=10, high=80,
        label=hard_negatives.seventh_relabelled(),
    )
    assert got(found) == mined(rows, 2, 4, 10, 80)


def lists(rng, count, size, most=50):
    vectors = rng.integers(-most, most + 1, (count, size))
    return hard_negatives.Lists(np.arange(count), rng.permutation(count), rng.integers(0, 3, count), vectors)


def test_threshold_stops_early_and_right():
    rng = np.random.default_rng(5)
    for turn in range(200):
        block = lists(rng, 300, int(rng.integers(1, 6)), int(rng.integers(1, 60)))
        anchor = rng.integers(-50, 51, block.vectors.shape[1])
        if turn % 10 == 0:
            anchor[:] = 0
        scores = block.vectors @ anchor
        lows = np.sort(rng.choice(scores, 4))
        windows = np.array([[low, low + int(rng.integers(0, 500))] for low in lows] + [[-(2**63), 2**63 - 1]])
        barred = block.labels == 0
        best, _ = block.best(anchor, windows, 3, barred, step=2)
        for (low, high), (at, value) in zip(windows, best, strict=True):
            fits = [(-int(s), k) for k, s in enumerate(scores) if not barred[k] and low <= s <= high]
            assert sorted(fits)[:3] == [(-int(v), int(k)) for v, k in zip(value, at)]
    # One window, few dimensions: most rows are never scored.
    block = lists(rng, 5000, 3, 1000)
    _, scored = block.best(np.array([40, 1, -1]), np.array([[-(2**63), 2**63 - 1]]), 5, np.zeros(5000, dtype=bool), step=2)
    assert scored < 1000


def test_equal_scores_at_the_border_come_by_id():
    # All rows score the same, so no threshold may cut the smallest ids off.
    ids = np.arange(100)[::-1].copy()
    vectors = np.tile(np.array([[3, 4]]), (100, 1))
    block = hard_negatives.Lists(np.arange(100), ids, np.zeros(100), vectors)
    ((at, value),), _ = block.best(np.array([1, 1]), np.array([[0, 100]]), 3, np.zeros(100, dtype=bool), step=1)
    assert block.ids[at].tolist() == [0, 1, 2] and value.tolist() == [7, 7, 7]


def test_too_long_vectors_are_refused(spark):
    with pytest.raises(Exception, match="too long"):
        hard_negatives.mine(frame(spark, [(50, [1e9], 1), (1, [1.0], 1)])).collect()


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = spark_rows(queries.op12_hard_negatives(spark, folder))
    assert found == duck_rows(duck(folder), queries.NEGATIVES_SQL) and len(found[1]) > 10
