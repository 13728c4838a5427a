"""Near-duplicates: texts as what is linked, work of hot keys, clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from teletally.llm import order_minhash as omh
from tests.llm.cases import docs, texts
from tests.llm.test_order_minhash import aligned, changed, components


def counted(monkeypatch, name):
    """Rows that a function of the module returns, call by call."""
    seen, plain = [], getattr(omh, name)

    def wrapped(*args, **kw):
        found = plain(*args, **kw)
        seen.append(found.count())
        return found

    monkeypatch.setattr(omh, name, wrapped)
    return seen


def test_rows_that_share_an_id_keep_their_texts(spark):
    a, b = texts(1, 2, 80, 900)
    rows = [(1, a), (1, b), (4, a)]
    found = omh.near_duplicates(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.class_id, r.component_id, r.kept) for r in found) == [
        (1, 1, 1, True), (1, 1, 1, True), (4, 1, 1, False),
    ]
    stay = omh.without_near_duplicates(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in stay) == sorted([(1, a), (1, b)])
    # Two near texts under one id: one of them stays.
    near = changed(random.Random(1), a, 1)
    stay = omh.without_near_duplicates(docs(spark, [(1, a), (1, near), (1, a)])).collect()
    assert len(stay) == 1


def test_repeated_rows_are_one_class(spark, monkeypatch):
    (base,) = texts(2, 1, 100, 900)
    near = changed(random.Random(2), base, 1)
    seen = counted(monkeypatch, "_with_leaders")
    found = omh.near_duplicates(docs(spark, [(1, base)] * 200 + [(2, near)] * 200, 4)).collect()
    assert seen == [1]
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found) == [(1, 1, True)] * 200 + [(2, 1, False)] * 200
    assert omh.without_near_duplicates(docs(spark, [(1, base)] * 200 + [(2, near)] * 200, 4)).count() == 1


def test_names_that_clash(spark):
    names = "_stays", "_first", "text_key", "node", "row", "place", "keys", "part", "component", "a b", "kept", "head"
    base, other = texts(3, 2, 60, 900)
    table = docs(spark, [(1, base), (2, base), (3, other), (None, other)])
    for name in names:
        table = table.withColumn(name, F.lit("clash"))
    stay = omh.without_near_duplicates(table)
    assert stay.columns == table.columns
    assert sorted(str(r.doc_id) for r in stay.collect()) == ["1", "3", "None"]


@pytest.mark.parametrize("count", [250, 500, 1000])
def test_work_of_a_common_passage_grows_with_the_texts(spark, monkeypatch, count):
    # Texts that share a passage are below 0.8 to each other; every tenth has a near copy.
    rng = random.Random(4)
    passage = " ".join(texts(5, 1, 200, 5000)[0].split()[:150])
    rows = []
    for k in range(count):
        own = " ".join(f"own{k}x{n}" for n in range(60))
        rows.append(f"{passage} {own}")
        if k % 10 == 0:
            rows.append(f"{passage} {own} one{k} two{k} three{k}")
    table = list(enumerate(rows))
    assert aligned(rows[0], rows[1]) >= 0.8 > aligned(rows[0], rows[2])
    rng.shuffle(table)
    rare, met = counted(monkeypatch, "_rarest"), counted(monkeypatch, "_meeting")
    found = {r.doc_id: r.component_id for r in omh.near_duplicates(docs(spark, table, 8)).collect()}
    wanted = {k: k for k in range(len(rows))} | {k: k - 1 for k in range(len(rows)) if "one" in rows[k].split()[-3]}
    assert found == wanted
    # A pair of near copies shares some rare labels, a passage none: a bounded number of rows for every text.
    assert rare[0] <= 10 * count and sum(met) <= 2 * count


def test_a_chain_of_near_copies_is_one_group(spark):
    # Neighbours are above 0.8, texts farther apart are not.
    rng = random.Random(6)
    rows = [texts(7, 1, 100, 4000)[0]]
    for _ in range(40):
        rows.append(changed(rng, rows[-1], 2))
    table = list(enumerate(rows))
    links = [(i, j) for i, x in table for j, y in table if i < j and aligned(x, y) >= 0.8]
    wanted = components(links, range(len(rows)))
    found = omh.near_duplicates(docs(spark, table, 4), tile=3).collect()
    assert {r.doc_id: r.component_id for r in found} == wanted
