"""Threshold-scaled sketches."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from xxhash import xxh64

from teletally.llm import fingerprints
from tests.llm.cases import ODD, docs, texts


def report(spark, rows, **options):
    return fingerprints.fingerprint_report(docs(spark, rows), **options).collect()


def signed_hash(data, seed=42):
    value = xxh64(data, seed=seed % 2**64).intdigest()
    return value - 2**64 if value >= 2**63 else value


def edited(rows):
    """Edited texts in the order of the rows by descending id, then by descending hash of the text."""
    full = ((-(2**63) if i is None else i, t or "") for i, t in rows)
    order = sorted(full, key=lambda r: (-r[0], -(xxh64(r[1].encode(), seed=42).intdigest() >> 12), r[1]))
    for k, (i, text) in enumerate(order):
        following, half = order[(k + 1) % len(order)][1], len(text) // 2
        yield i, text, text[: len(text) - half] + following[:half]


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_texts_and_likeness(spark, seed):
    rows = [(k * 7 % 1009, t) for k, t in enumerate(texts(seed, 400, 200))]
    found = {r.doc_id: r for r in report(spark, rows)}
    for i, text, changed in edited(rows):
        assert found[i].edited_sha256 == sha256(changed.encode()).hexdigest()
        assert found[i].n_chars == len(text)
    near = [r.near_edited for r in found.values()]
    assert 0.4 < sum(near) / len(near) < 0.6
    assert sum(r.near_next for r in found.values()) / len(near) < 0.05


def test_odd_rows(spark):
    found = report(spark, ODD)
    wanted = sorted(sha256(e.encode()).hexdigest() for _, _, e in edited(ODD))
    assert sorted(r.edited_sha256 for r in found) == wanted
    same = {r.doc_id: r.fingerprint for r in found}
    assert same[5] == same[6] and same[7] == same[8] and same[1] == same[2] == same[3] == ""
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert report(spark, []) == []
    (only,) = report(spark, [(3, "abcd")])
    assert only.edited_sha256 == sha256(b"abab").hexdigest() and only.near_next == 1.0


def test_sketches_estimate_containment_and_merge(spark):
    long, short = texts(5, 2, 4000, 5000)
    part = " ".join(long.split()[:900])
    table = docs(spark, [(1, long), (2, part), (3, short), (4, long + " " + short)])
    found = {r.doc_id: set(r.sketch) for r in fingerprints.fingerprint(table).collect()}
    assert len(found[2] & found[1]) / len(found[2]) > 0.97
    assert len(found[2] & found[3]) == 0
    assert len(found[4] ^ (found[1] | found[3])) <= 4
    size = len(long.split())
    assert abs(len(found[1]) / size - fingerprints.FRACTION) < 0.03


def sketch_by_hand(text, width=5, fraction=fingerprints.FRACTION):
    words = text.lower().split()
    found = set()
    for start in range(max(1, len(words) - width + 1) if words else 0):
        value = 42
        for word in words[start : start + width]:
            value = signed_hash(word.encode(), value)
        found.add(value)
    return {h for h in found if h < -(2**63) + fraction * 2**64} | ({min(found)} if found else set())


def contained(a, b):
    return len(a & b) / len(a) if a else float(not b)


@pytest.mark.parametrize("options", [{}, {"width": 2, "fraction": 1 / 2}])
def test_sketches_and_likeness_equal_those_by_hand(spark, options):
    rows = [(k * 7 % 1009, t) for k, t in enumerate([*texts(3, 150, 80), "", "one two", " a  b c d e\tF g ", None, *texts(4, 60, 6)])]
    found = {r.doc_id: r for r in report(spark, rows, **options)}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    changed = {i: e for i, _, e in edited(rows)}
    for k, (i, text) in enumerate(order):
        own, other, following = (
            sketch_by_hand(t, **options) for t in (text, changed[i], order[(k + 1) % len(order)][1])
        )
        assert found[i].fingerprint == ",".join(f"{h % 2**64:x}" for h in sorted(own))
        assert found[i].edited_fingerprint == ",".join(f"{h % 2**64:x}" for h in sorted(other))
        assert found[i].near_edited == pytest.approx(contained(own, other))
        assert found[i].near_next == pytest.approx(contained(own, following))


def test_many_rows_of_one_id_are_divided(spark):
    rows = [(k, t) for k, t in enumerate(texts(7, 200, 6))]
    rows += [(None, t) for t in texts(8, 400, 6)] + [(100, t) for t in texts(9, 300, 6)] + [(100, "same")] * 3
    found = report(spark, rows)
    assert sorted(r.edited_sha256 for r in found) == sorted(sha256(e.encode()).hexdigest() for _, _, e in edited(rows))
    frame = spark.createDataFrame([(i if i is not None else -(2**63), t) for i, t in rows], "key long, text string")
    tied = frame.withColumn("tie", F.shiftrightunsigned(F.xxhash64("text"), 12))
    ends = fingerprints.range_ends(tied, "key", "tie", 64)
    assert ends == sorted(set(ends)) and 32 < len(ends) <= 130
    assert sum(e[0] == -(2**63) for e in ends) > 15 and sum(e[0] == 100 for e in ends) > 10


def test_ids_that_no_double_holds(spark):
    rows = [(2**62 + k, t) for k, t in enumerate(texts(11, 300, 6))] + [(-(2**62) - k, t) for k, t in enumerate(texts(12, 90, 6))]
    found = {r.doc_id: r.edited_sha256 for r in report(spark, rows)}
    assert found == {i: sha256(e.encode()).hexdigest() for i, _, e in edited(rows)}
