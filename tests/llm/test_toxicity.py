"""Toxicity: restored words, learnt features, held-out accuracy."""

import random
from zlib import crc32

import numpy as np
import pytest

from teletally.llm import toxicity
from tests.llm.cases import ODD, docs, texts

INSULTS = ("idiot", "loser", "stupid", "pathetic", "worthless")


@pytest.fixture(scope="module")
def costs():
    sample = [" ".join([*INSULTS, "the", "thing", "that", "was", "nation"] * 20), *texts(1, 50)]
    return toxicity.letter_costs(toxicity.trigram_counts(sample)).tolist()


@pytest.mark.parametrize(
    ("written", "word"),
    [
        ("1d10t", "idiot"),
        ("i.d.i.o.t", "idiot"),
        ("l-o-s-e-r", "loser"),
        ("looooser", "loser"),
        ("$tup1d", "stupid"),
        ("stuuuupid!!", "stupid"),
        ("p@th3t1c", "pathetic"),
        ("w0rthl3$$", "worthless"),
        ("idiot", "idiot"),
        ("idiot!!!", "idiot"),
        ("(loser)", "loser"),
    ],
)
def test_restored_words(costs, written, word):
    assert word in toxicity.hidden_words(written, costs)


def test_plain_words_stay(costs):
    for word in ("the", "naïve", "straße", "word,", "\"end.\""):
        assert toxicity.hidden_words(word, costs) == [word.strip("\".,")]
    assert toxicity.hidden_words("2186", costs) == [] == toxicity.hidden_words("...", costs)


def brute_restore(token, costs):
    """Cheapest reading of a token over all choices."""
    readings = [("", 0.0, 0, 0)]
    for choices in toxicity._choices(token):
        grown = []
        for text, cost, a, b in readings:
            for char, extra in choices:
                if char == "":
                    grown.append((text, cost + extra, a, b))
                else:
                    letter = 0 if char == " " else toxicity.LETTER.get(char, toxicity.SIZE - 1)
                    step = costs[(a * toxicity.SIZE + b) * toxicity.SIZE + letter]
                    grown.append((text + char, cost + extra + step, b, letter))
        readings = grown
    return min(cost + costs[(a * toxicity.SIZE + b) * toxicity.SIZE] for _, cost, a, b in readings)


def test_viterbi_is_the_cheapest_reading(costs):
    rng = random.Random(2)
    for _ in range(60):
        token = "".join(rng.choices("ab1i!$.-*0ee", k=rng.randint(1, 7)))
        text = toxicity.restore(token, costs)
        best = brute_restore(token, costs)
        # The text found must be among the cheapest readings.
        readings = [("", 0.0)]
        for choices in toxicity._choices(token):
            readings = [(t + c, x + e) for t, x in readings for c, e in choices]

        def cost(reading, extra):
            a = b = 0
            for char in reading:
                letter = 0 if char == " " else toxicity.LETTER.get(char, toxicity.SIZE - 1)
                extra += costs[(a * toxicity.SIZE + b) * toxicity.SIZE + letter]
                a, b = b, letter
            return extra + costs[(a * toxicity.SIZE + b) * toxicity.SIZE]

        assert min(cost(t, x) for t, x in readings if t == text) == pytest.approx(best)


def corpus(seed, count=600):
    rng = random.Random(seed)
    rows, labels = [], []
    for k, text in enumerate(texts(seed, count)):
        words, toxic = text.split(), int(rng.random() < 0.2)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, toxic))
    return rows, labels


def test_held_out_rows_are_told_apart(spark):
    rows, labels = corpus(1)
    written = {"idiot": "1d10t", "loser": "l o s e r", "stupid": "stuuupid", "pathetic": "p@thet1c"}
    known = dict((i, t) for i, _, t in labels)
    # Held-out documents hide their words.
    hidden = [
        (i, " ".join(written.get(w, w) for w in t.split()) if crc32(str(i).encode()) % 5 == 0 else t) for i, t in rows
    ]
    table, marks = docs(spark, hidden), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(table, marks)
    found = toxicity.score(table, model).collect()
    assert {r.doc_id: r.held_out for r in found} == {i: crc32(str(i).encode()) % 5 == 0 for i, _ in rows}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    held = [r for r in found if r.held_out]
    wrong = [r for r in held if r.predicted != known[r.doc_id]]
    assert len(wrong) <= 0.03 * len(held) and sum(known[r.doc_id] for r in held) > 10
    clean = toxicity.without_toxic(table, model)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in found if not r.predicted}
    assert clean.columns == table.columns


def test_copies_teach_nothing_by_themselves(spark):
    rows, labels = corpus(2)
    (copied,) = texts(99, 1, 80, 2000)
    for k in range(150):
        rows.append((5000 + k, f"{copied} idiot"))
        labels.append((5000 + k, 1, 1))
    model = toxicity.fit(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    words = {f.rstrip("$") for f in model.weights}
    assert not words & set(copied.split())
    assert {"idiot", "loser"} <= words


def test_odd_rows_and_labels(spark):
    marks = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None), (5, 0)], "doc_id long, toxic int")
    table = docs(spark, ODD)
    found = toxicity.score(table, toxicity.fit(table, marks)).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    found = toxicity.score(table, toxicity.fit(table, none)).collect()
    assert len({r.score for r in found}) == 1
    empty = docs(spark, [])
    model = toxicity.fit(empty, none)
    assert toxicity.score(empty, model).count() == 0 and toxicity.without_toxic(empty, model).count() == 0
    long = toxicity.Scorer(model)
    assert 0 <= long.score("1d10t" * 20_000) <= 1


def test_training_rows_are_bounded_and_not_held_out(spark):
    marks = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, toxic int")
    chosen = toxicity.training_labels(marks, rows=50).collect()
    assert len(chosen) == 50 and all(crc32(str(r.doc_id).encode()) % 5 for r in chosen)


def test_letter_costs_are_probabilities():
    costs = toxicity.letter_costs(toxicity.trigram_counts(["abc abd", "xyz"]))
    assert np.allclose(np.exp(-costs).reshape(-1, toxicity.SIZE).sum(axis=1), 1)


@pytest.mark.parametrize(
    ("written", "seen"),
    [
        ("you are a l o s e r ok", True),
        ("you l  o  s  e  r ok", True),
        ("you l\to\ts\te\tr ok", True),
        ("you l\no\ns\ne\nr ok", True),
        ("you a s s ok", True),
        ("x a s s y ok", False),
        ("pa th e t i c ok", False),
        ("p a t h e t i c ok", True),
        ("you are a b c ok", False),
        ("l o s", False),
    ],
)
def test_spelled_out_words(costs, written, seen):
    weights = {"loser$": 5.0, "ass$": 4.0, "pathet": 3.0}
    scorer = toxicity.Scorer(toxicity.ToxicityModel(costs, weights, (0.0, 1.0, 1.0)))
    assert (scorer.evidence(written)[0] > 0) == seen


def test_rows_of_one_id_teach_once(spark):
    rows, labels = corpus(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    repeated = [(i, t) for i, t in rows for _ in range(4)]
    once, again = (toxicity.fit(docs(spark, r), marks) for r in (rows, repeated))
    assert once.weights == again.weights and once.weights
    assert once.scale == pytest.approx(again.scale)


def test_covering_and_widespread_features():
    counts = {"bad$": (0, 6), "copy$": (0, 6), "late$": (0, 4)}
    holders = {"bad$": 0b111111, "copy$": 0b111111, "late$": 0b1111000000}
    assert toxicity._covering(dict(holders), counts, 90, 10, 2.0) == ["copy$", "late$"]
    assert toxicity._widespread({"bad$": 6, "copy$": 1, "late$": 4}, counts, 90, 10, 2.0) == ["bad$", "late$"]
