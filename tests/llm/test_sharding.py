"""Sharding by virtual slots."""

import random
from zlib import crc32

import pytest

from teletally.llm import sharding
from tests.llm.cases import ODD, docs, texts


def check(found, shards):
    for shard in range(shards):
        places = sorted(r.slot for r in found if r.shard == shard)
        assert places == list(range(len(places)))


def test_sizes_and_places(spark):
    rows = [(k, t) for k, t in enumerate(texts(1, 600))]
    found = sharding.shard_documents(docs(spark, rows)).collect()
    assert sorted(r.doc_id for r in found) == [r[0] for r in rows]
    by_id = dict(rows)
    for row in found:
        data = by_id[row.doc_id].encode()
        assert (row.size, row.text_crc32, row.law, row.grown_shard) == (len(data) + 8, crc32(data), "bytes", None)
    check(found, 24)
    loads = [sum(r.size for r in found if r.shard == s) for s in range(24)]
    assert max(loads) - min(loads) <= max(r.size for r in found)


def test_odd_rows(spark):
    found = sharding.shard_documents(docs(spark, ODD), shards=4).collect()
    assert len(found) == len(ODD)
    check(found, 4)
    assert [(r.size, r.text_crc32) for r in found if r.doc_id == 1] == [(8, 0)]
    assert sharding.shard_documents(docs(spark, [])).count() == 0


def test_same_slots_again(spark):
    table = docs(spark, [(k, t) for k, t in enumerate(texts(2, 100))])
    a = sharding.shard_documents(table).select("doc_id", "vslot", "shard", "slot").collect()
    b = sharding.shard_documents(table.repartition(7)).select("doc_id", "vslot", "shard", "slot").collect()
    assert sorted(a) == sorted(b)


def test_growing_and_rebalancing_move_few_slots(spark, tmp_path):
    rng = random.Random(3)
    sizes = [rng.randint(50, 150) for _ in range(2000)]
    first = sharding.plan_shards(sizes, [1] * 2000, 10)
    grown = first.grown()
    moved = [(a, b) for a, b in zip(first.shard_of, grown.shard_of) if a != b]
    assert all(b == 10 for _, b in moved) and 0.05 < len(moved) / 2000 < 0.15
    assert max(grown.loads()) < 1.05 * sum(sizes) / 11
    heavier = [s * (5 if shard == 0 else 1) for s, shard in zip(sizes, first.shard_of)]
    later = first.rebalanced(heavier, [1] * 2000)
    assert later.version == 2 and max(later.loads()) < 1.03 * sum(heavier) / 10
    assert all(a == 0 for a, b in zip(first.shard_of, later.shard_of) if a != b)
    path = str(tmp_path / "map")
    first.store(spark, path)
    later.store(spark, path)
    assert sharding.SlotMap.stored(spark, path) == later
    assert sharding.SlotMap.stored(spark, path, 1) == first


def test_a_stored_map_is_edited(spark, tmp_path):
    path = str(tmp_path / "map")
    rows = [(k, t) for k, t in enumerate(texts(4, 800, 40))]

    def placed(some, shards=8):
        found = sharding.shard_documents(docs(spark, some), shards, slots=256, map_path=path, slack=0.05).collect()
        check(found, shards)
        return found, {r.vslot: r.shard for r in found}, {r.map_version for r in found}

    _, first, versions = placed(rows[:600])
    assert versions == {1}
    # The same table again: the same version of the map.
    _, again, versions = placed(rows[:600])
    assert (again, versions) == (first, {1})
    # A grown table: the next version, and few slots have moved.
    found, later, versions = placed(rows)
    moved = [k for k in first if later[k] != first[k]]
    assert versions == {2} and len(moved) < 0.15 * 256
    loads = [sum(r.size for r in found if r.shard == s) for s in range(8)]
    assert max(loads) <= 1.06 * sum(loads) / 8
    # One more shard: slots move into it alone.
    found, more, versions = placed(rows, 9)
    assert versions == {3} and all(shard == 8 for k, shard in more.items() if shard != later[k])
    loads = [sum(r.size for r in found if r.shard == s) for s in range(9)]
    assert max(loads) <= 1.06 * sum(loads) / 9 and loads[8] >= 0.8 * sum(loads) / 9
    assert sum(shard == 8 for shard in more.values()) < 0.2 * len(more)
    with pytest.raises(ValueError, match="9 shards already"):
        placed(rows, 8)
    with pytest.raises(ValueError, match="256 slots"):
        sharding.shard_documents(docs(spark, rows), 9, slots=128, map_path=path)


def test_equal_rows_and_ids(spark):
    rows = [(7, "the same row")] * 500 + [(7, f"same id {k}") for k in range(200)] + [(None, "no id")] * 300
    found = sharding.shard_documents(docs(spark, rows, 6), shards=3, slots=64).collect()
    assert len(found) == 1000
    check(found, 3)
    assert sum(r.doc_id is None for r in found) == 300
    same = sorted(r.slot for r in found if r.text_crc32 == crc32(b"the same row"))
    assert same == list(range(same[0], same[0] + 500))
