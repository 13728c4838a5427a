"""Links between embeddings against all pairs."""

import math
from collections import Counter

import numpy as np
import pytest

from teletally.llm import embedding_dedup, queries
from tests.compare import duck, duck_rows, spark_rows

SCHEMA = "vec_id long, embedding array<float>, label int, cls string, leaf string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", "y") for i, v, lab in rows], SCHEMA).repartition(4)


def brute(rows, threshold=0.93):
    usable = {}
    for i, vector, label in rows:
        if vector is None or label is None or i is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = np.array(vector, dtype=np.float32).astype(float)
        if len(v) and np.abs(v).max() > 0:
            v = v / np.abs(v).max()
            usable[i] = (v / np.linalg.norm(v), label)
    links = {i: set() for i, _, _ in rows}
    for i, (v, label) in usable.items():
        for j, (w, other) in usable.items():
            if i != j and label == other and len(v) == len(w) and float(v @ w) >= threshold:
                links[i].add(j)
    found = {}
    for i, _, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        found[i] = (len(links[i]), i if i is None else min(seen), i is None or i == min(seen))
    return found


def clusters(seed, groups, members, spread, size=64):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.standard_normal(size)
        for _ in range(members):
            rows.append((len(rows), (centre + spread * rng.standard_normal(size)).tolist(), int(g % 3)))
    return rows


@pytest.mark.parametrize(("spread", "least"), [(0.1, 1.0), (0.25, 0.98)])
def test_recall_against_all_pairs(spark, spread, least):
    rows = clusters(1, 30, 12, spread)
    wanted = brute(rows)
    # Small leaves: several rounds of splits and leaves that no split divides.
    found = {r.vec_id: r for r in embedding_dedup.near_vectors(frame(spark, rows), capacity=8).collect()}
    assert all(found[i].n_links <= n for i, (n, _, _) in wanted.items())
    assert sum(r.n_links for r in found.values()) >= least * sum(n for n, _, _ in wanted.values())
    if least == 1.0:
        assert {i: (r.n_links, r.component_id, r.kept) for i, r in found.items()} == wanted


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], 0),
        (2, [2.0, 4.0], 0),
        (3, [1.0, 2.0], None),
        (4, None, 0),
        (5, [0.0, 0.0], 0),
        (6, [nan, 1.0], 0),
        (7, [inf, 1.0], 0),
        (8, [None, 1.0], 0),
        (9, [], 0),
        (10, [1.0, 2.0, 0.0], 0),
        (11, [1.0, 2.0], 1),
        (12, [1e30, 2e30], 0),
        (13, [1e-40, 2e-40], 0),
        (14, [-1.0, -2.0], 0),
        (15, [1.0, 2.0], 0),
    ]
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(frame(spark, rows)).collect()}
    assert found == brute(rows)
    twice = embedding_dedup.near_vectors(frame(spark, [*rows, rows[0], (None, [1.0, 2.0], 0)])).collect()
    assert Counter(r.vec_id for r in twice)[1] == 2 and len(twice) == len(rows) + 2
    assert [(r.n_links, r.kept) for r in twice if r.vec_id is None] == [(0, True)]
    assert [(r.n_links, r.component_id) for r in twice if r.vec_id == 2] == [found[2][:2]]
    assert embedding_dedup.near_vectors(frame(spark, [])).count() == 0


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = spark_rows(queries.QUERIES["op5_embedding_dedup"](spark, folder))
    assert found == duck_rows(duck(folder), queries.SQL["op5_embedding_dedup"])
