"""Mixing: the fair schedule, whole sources, and the SQL counterpart."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from teletally.llm import mixing, queries
from tests.compare import duck, duck_rows, spark_rows
from tests.llm.cases import ODD, docs, texts


@pytest.mark.parametrize("seed", range(20))
def test_less_than_one_block_from_the_share(seed):
    rng = random.Random(seed)
    shares = {f"s{k}": rng.random() ** 3 + 1e-3 for k in range(rng.randint(1, 40))}
    period = rng.choice([50, 101, 1000])
    weights = mixing.whole_weights(shares, period)
    assert sum(weights.values()) == period and min(weights.values()) >= 1
    used = Counter()
    for source, index, turn in mixing.fair_turns(weights):
        assert index == used[source]
        used[source] += 1
        for name, weight in weights.items():
            assert abs(used[name] * period - (turn + 1) * weight) < period
    assert used == Counter(weights)


def test_whole_sources_in_their_shares(spark):
    rows = [(k, t, "big" if k % 3 else f"s{k % 5}") for k, t in enumerate(texts(1, 300))]
    shares = {"big": 2.0, **{f"s{k}": 1.0 for k in range(5)}}
    found = mixing.mix(docs(spark, rows), shares, period=70, block_bytes=1000, keep=("text", "lang")).collect()
    assert {r.doc_id for r in found} == {r[0] for r in rows}
    first = [r for r in found if r.epoch == 0]
    assert len(first) == len(rows)
    assert all(dict((r[0], r[1]) for r in rows)[r.doc_id] == r.text for r in found)
    # Every turn serves one block of one source, and turns follow the schedule.
    served = defaultdict(set)
    for row in found:
        served[row.turn].add((row.source, row.epoch, row.block))
    assert all(len(blocks) == 1 for blocks in served.values())
    weights = mixing.whole_weights({f"={k}": v for k, v in shares.items()}, 96)
    end = max(served) + 1
    turns = Counter(source for blocks in served.values() for source, _, _ in blocks)
    for source, number in turns.items():
        # Blocks without a document's start leave their turns empty.
        assert number <= end * weights["=" + source] / 96 + 1
    # Blocks hold what begins in them.
    starts = defaultdict(int)
    for row in sorted(first, key=lambda r: (r.source, r.block, r.place)):
        assert row.block * 1000 + row.place == starts[row.source]
        starts[row.source] += row.bytes


def test_odd_rows(spark):
    rows = [(*r, None if k % 4 == 0 else f"s{k % 2}") for k, r in enumerate(ODD)]
    found = mixing.mix(docs(spark, rows), keep=("score", "_key")).collect()
    assert Counter((r.doc_id, r.source) for r in found if r.epoch == 0) == Counter((r[0], r[2]) for r in rows)
    assert all(r._key == "clash" for r in found)
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, [(1, None)])).count() == 1
    with pytest.raises(ValueError, match="weight"):
        mixing.mix(docs(spark, rows), {"s0": 1.0})
    with pytest.raises(ValueError, match="names"):
        mixing.mix(docs(spark, rows), keep=("turn",))


def test_epochs_and_sources_are_bounded(spark):
    rows = [(k, t, "big" if k % 20 else "small") for k, t in enumerate(texts(2, 200))]
    shares = {"big": 1.0, "small": 3.0}
    free = mixing.mix(docs(spark, rows), shares, block_bytes=1000).collect()
    assert max(r.epoch for r in free) > 2
    for most in (1, 2):
        found = mixing.mix(docs(spark, rows), shares, block_bytes=1000, max_epochs=most).collect()
        assert sorted(found) == sorted(r for r in free if r.epoch < most)
    assert len(mixing.mix(docs(spark, rows), shares, max_epochs=1).collect()) == 200
    many = [(k, "a text", f"host{k}") for k in range(30)]
    assert mixing.mix(docs(spark, many), max_sources=30).count() >= 30
    with pytest.raises(ValueError, match="more than 29 sources"):
        mixing.mix(docs(spark, many), max_sources=29)


def test_mixed_rows_keep_all_columns(spark):
    table = docs(spark, [(*r, f"s{k % 3}") for k, r in enumerate(ODD)])
    for name in ("turn", "place", "bytes", "epoch", "_kept", "a.b", "_key"):
        table = table.withColumn(name, F.lit("clash"))
    found = mixing.mixed_rows(table, max_epochs=1)
    assert found.columns == table.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, table.collect()))


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = spark_rows(queries.QUERIES["op3_mixing"](spark, folder))
    assert found == duck_rows(duck(folder), queries.SQL["op3_mixing"])
