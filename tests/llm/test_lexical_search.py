"""Ranked lexical search against plain Python and SQL."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from teletally.llm import lexical_search, queries
from tests.compare import duck, duck_rows, spark_rows
from tests.llm.cases import ODD, docs, texts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def ranked(rows, items, top=50):
    """By plain Python over all rows."""
    read = [(i, terms(t)) for i, t in rows]
    read = [(i, t) for i, t in read if t]
    n_docs, n_terms = len(read), sum(len(t) for _, t in read)
    df = {}
    for _, t in read:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    found = []
    for item, held in wanted.items():
        scored = []
        for i, t in read:
            m = 100 - 50 + 50 * len(t) * n_docs // n_terms
            score = 0
            for term in held & set(t):
                tf = t.count(term)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += w * (1_000_000_000 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        found += [(item, k + 1, None if lacks else i, -s) for k, (s, lacks, i) in enumerate(sorted(scored)[:top])]
    return sorted(found, key=str)


def items_of(spark, items):
    frame = spark.createDataFrame([(*i, "x", "x") for i in items], "item_id long, text string, score string, rank string")
    return frame.repartition(2) if items else frame


def got(frame):
    assert frame.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in frame.collect()), key=str)


ITEMS = [
    (1, "one two THREE three"),
    (2, None),
    (3, "..."),
    (4, "id w1 w2 w3 w500 éß中 nowhere"),
    (4, "a double"),
    (4, "a double"),
    (None, "negative blanks"),
]


def test_terms():
    rng = random.Random(1)
    signs = [*" .-_\x00\x7f@AZaz09[`{", "é", "İ", " ", " ", "中", "\U0001f642"]
    for _ in range(2000):
        text = "".join(rng.choices(signs, k=rng.randint(0, 20)))
        assert [t.decode() for t in lexical_search.terms_of(text)] == terms(text)


def test_odd_rows(spark):
    index = lexical_search.build_index(docs(spark, ODD))
    assert got(lexical_search.search(index, items_of(spark, ITEMS))) == ranked(ODD, ITEMS)
    assert got(lexical_search.search(index, items_of(spark, []))) == []
    for rows in ([], [(1, None)], [(1, ""), (2, None), (3, " .")]):
        empty = lexical_search.build_index(docs(spark, rows, 1))
        assert got(lexical_search.search(empty, items_of(spark, ITEMS))) == []


@pytest.mark.parametrize(("segment", "block", "window", "top"), [(8192, 128, 2048, 50), (60, 16, 8, 7), (13, 4, 5, 3)])
def test_any_segments_blocks_and_windows(spark, segment, block, window, top):
    made = texts(3, 300, 30, 120)
    # A third of the documents is the same text, so that scores tie at every border.
    rows = [*enumerate(made), *[(1000 + k, made[7]) for k in range(150)]]
    items = [(k, t) for k, t in enumerate(texts(4, 12, 15, 120) + made[:3])]
    index = lexical_search.build_index(docs(spark, rows, 2), segment_docs=segment, block=block)
    found = lexical_search.search(index, items_of(spark, items), top=top, window=window, round_bytes=900)
    assert got(found) == ranked(rows, items, top)


def segment_of(rows, block=128):
    n_docs = sum(bool(terms(t)) for _, t in rows)
    n_terms = sum(len(terms(t)) for _, t in rows)
    row = lexical_search.segment_row(0, [i for i, _ in rows], pa.array([t for _, t in rows], pa.string()), block)
    names = "segment", "n_docs", "n_terms", "block", "terms", "meta", "documents", "postings"
    assert row[1:3] == (n_docs, n_terms)
    return lexical_search.Segment(dict(zip(names, row, strict=True)), n_docs, n_terms)


def test_block_maxima_are_exact():
    rows = list(enumerate(texts(5, 400, 40, 50)))
    segment = segment_of(rows, 16)
    for k in segment.number.values():
        last, most = segment.maxima(k)
        for block in range(len(last)):
            places, worth = segment.postings_of(k, block)
            assert places[-1] == last[block] and worth.max() == most[block]


def test_blocks_are_rejected_before_decompression():
    rng = random.Random(6)
    # A common word everywhere, and a rare one in a few documents that therefore come first.
    rows = [(k, "common " * rng.randint(1, 3) + "filler " * rng.randint(5, 30)) for k in range(6000)]
    for k in range(0, 3000, 40):
        rows[k] = (k, rows[k][1] + " rare rare rare")
    segment = segment_of(rows)
    weights = [(b"common", 1), (b"rare", 5000)]
    at, score = segment.best(weights, 50, 1024)
    total = np.zeros(len(segment.length), dtype=np.int64)
    for term, w in weights:
        k = segment.number[term]
        for block in range(len(segment.maxima(k)[0])):
            places, worth = _fresh(segment, k, block)
            total[places] += w * worth
    first = np.lexsort((np.arange(len(total)), -total))[:50]
    assert at.tolist() == first.tolist() and score.tolist() == total[first].tolist()
    # The common word's list has 47 blocks; once 50 rare documents are found it is essential no more.
    assert segment.decompressed < 40


def _fresh(segment, k, block):
    """A block's postings, without counting it as needed by the search."""
    held = dict(segment._blocks)
    found = segment.postings_of(k, block)
    segment._blocks = held
    return found


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = spark_rows(queries.op11_lexical_search(spark, folder))
    assert found == duck_rows(duck(folder), queries.SEARCH_SQL) and len(found[1]) > 1000
