"""The hidden Markov model: base score by brute force, recursions by hand, held-out gain."""

import math
import re
from collections import Counter
from itertools import product
from zlib import crc32

import numpy as np
import pytest

from teletally.llm import language_model as lm
from tests.llm.cases import LONG, ODD, docs


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def brute(rows):
    """Counts and base scores over rows (id, text)."""
    held = [crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for (_, t), h in zip(rows, held) if not h for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    found = []
    for (i, text), h in zip(rows, held):
        words = tokens(text)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        found.append((i, h, len(words), sum(counts[w] > 0 for w in words), total, base))
    return found


def model(seed, states=3, symbols=5):
    rng = np.random.default_rng(seed)
    rows = lambda *shape: (lambda x: x / x.sum(axis=-1, keepdims=True))(rng.random(shape))
    return lm.HiddenMarkov(rows(states), rows(states, states), rows(states, symbols).T.copy())


def paths(sequence, m):
    """Probability and expected counts over all state paths."""
    states = range(len(m.start))
    total, start, move, emit = 0.0, np.zeros(len(m.start)), np.zeros_like(m.move), np.zeros_like(m.emit)
    for path in product(states, repeat=len(sequence)):
        chance = m.start[path[0]] * m.emit[sequence[0], path[0]]
        for a, b, s in zip(path, path[1:], sequence[1:]):
            chance *= m.move[a, b] * m.emit[s, b]
        total += chance
        start[path[0]] += chance
        for a, b in zip(path, path[1:]):
            move[a, b] += chance
        for a, s in zip(path, sequence):
            emit[s, a] += chance
    return total, start / total, move / total, emit / total


def test_recursions_equal_the_sum_over_paths():
    m, rng = model(1), np.random.default_rng(2)
    sequences = [rng.integers(0, 5, n).astype(np.int32) for n in (1, 4, 2, 6, 1, 5)]
    expected = {"emit": np.zeros_like(m.emit), "move": np.zeros_like(m.move), "start": np.zeros(3)}
    logs = lm.forward(sequences, m, expected)
    by_hand = [paths(s.tolist(), m) for s in sequences]
    assert np.allclose(logs, [math.log(p) for p, *_ in by_hand])
    assert np.allclose(lm.forward(sequences, m), logs)
    for k, name in enumerate(("start", "move", "emit"), 1):
        assert np.allclose(expected[name], sum(b[k] for b in by_hand))


def test_baum_welch_never_loses_likelihood():
    rng = np.random.default_rng(4)
    sequences = [rng.integers(0, 5, rng.integers(1, 40)).astype(np.int32) for _ in range(60)]
    m, before = model(5), -math.inf
    for _ in range(8):
        expected = {"emit": np.zeros_like(m.emit), "move": np.zeros_like(m.move), "start": np.zeros(3)}
        now = lm.forward(sequences, m, expected).sum()
        assert now >= before - 1e-9
        before = now
        m = lm.HiddenMarkov(
            expected["start"] / expected["start"].sum(),
            expected["move"] / expected["move"].sum(axis=1, keepdims=True),
            expected["emit"] / expected["emit"].sum(axis=0),
        )


@pytest.mark.parametrize("size", [4, 10_000])
def test_base_score_and_odd_rows(spark, size):
    rows = [*ODD, *[(200 + k, f"The end of the Story {k} É{k % 3}") for k in range(40)]]
    found = lm.score_documents(docs(spark, rows), dictionary_size=size).collect()
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    wanted = sorted(brute(rows), key=key)
    got = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found], key=key)
    for a, b in zip(got, wanted, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2, 3)}) == 1


def test_scores_are_the_models_probability(spark):
    rows = [(k, " ".join(f"{'xy'[k % 2]}{j % 5}" for j in range(k % 9))) for k in range(80)]
    found = {r.doc_id: r.score for r in lm.score_documents(docs(spark, rows), dictionary_size=50).collect()}
    # Texts of one word: their probabilities and that of the empty text stay below one.
    one = {t: found[i] for i, t in rows if len(t.split()) <= 1}
    assert sum(10**s for s in one.values()) < 1


def test_tables_without_rows_or_training(spark):
    assert lm.score_documents(docs(spark, [])).count() == 0
    held = [i for i in range(200) if crc32(str(i).encode()) % 7 == 2][:5]
    found = lm.score_documents(docs(spark, [(i, "a b") for i in held])).collect()
    assert all(r.held_out and r.train_tokens == 0 and r.base_score == 0.0 and r.n_known == 0 for r in found)


def test_held_out_texts_gain(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = [r for r in lm.score_documents(table).collect() if r.held_out]
    assert sum(r.score for r in found) > sum(r.base_score for r in found) * 0.97
    assert sum(r.score > r.base_score for r in found) > 0.8 * len(found)


def test_very_long_texts():
    assert len(lm.tokens(LONG)) == 20_000
    m = model(9)
    assert np.isfinite(lm.forward([np.zeros(20_000, dtype=np.int32)], m)).all()
