"""Toxicity of texts after noisy-channel restoration.

A token that does not look plain (digits or signs among letters, letters three times in a row, single
letters spaced out) is taken as a written form of some hidden word. Every character becomes a set of
weighted choices: itself, the letters it may stand for, nothing (a separator or a repetition), or
a word border. The Viterbi path through this lattice, under a character trigram model of the whole
corpus, is the restored text.

What marks toxic documents is learnt from labels: restored words and their first letters, counted per
document. A feature is kept if its log-likelihood ratio exceeds the logarithm of the number of
features looked at, so that chance rarely keeps one, whatever the size of the data, and the features
kept either cover the toxic documents one after the other, each counted on those that the ones before
it do not explain, or stand behind many different words. So what toxic documents share because they
are copies of each other is not learnt. A text's score is a logistic function of its strongest feature
and of the sum of the others.

The classifier is fitted on at most ``TRAINING_ROWS`` labelled rows (those whose ids hash lowest); the
character model counts every whole text.
"""

from __future__ import annotations

import heapq
import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teletally.llm.common import arrow_schema, drop_tool, fold, map_rows, text_or_empty, worker_tool
from teletally.storage import store

TRAINING_ROWS = 20_000
HOLD_OUT = 5
MAX_FEATURES = 50_000
STEMS = (4, 5, 6)
LONGEST = 24
# Entries of the tables of a counting task before they are emptied.
HELD_TOKENS = 100_000
HELD_FEATURES = 200_000
MIN_DOCS = 3
WIDESPREAD = 0.25

# Letters that a character may stand for, signs that may stand between letters, and
# the costs of the channel in nats.
LOOKS_LIKE = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "gb",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "(": "c",
    "<": "c",
    "€": "e",
    "£": "l",
    "¡": "i",
    "#": "h",
    "*": "aeiou",
}
PLAIN_ENDS = ".,;:!?\"'()[]{}"
COST_LETTER = 1.0
COST_DROP = 12.0
COST_SEPARATOR = 0.7
COST_SPLIT = 6.0
COST_REPEAT = 0.3

# Letters of the character model: index 0 is a word border, the last one any other letter.
ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
SIZE = len(ALPHABET) + 2
LETTER = {c: k + 1 for k, c in enumerate(ALPHABET)}

# Log odds that a text without any kept feature has at most.
NO_EVIDENCE = math.log(1 / 3)

_RUN = re.compile(r"(.)\1\1")
_SPACED = re.compile(r"(?<!\S)\S(?:\s{1,3}\S){2,}(?!\S)")
_TAIL = re.compile(r"([^\w\s])\1\1+$")


def _letter_table() -> np.ndarray:
    table = np.zeros(0x110000, dtype=np.uint8)
    for code in range(0x110000):
        if code < 0x100:
            table[code] = LETTER.get(chr(code), 0)
        elif chr(code).isalpha():
            table[code] = SIZE - 1
    return table


_table: np.ndarray | None = None


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of all letter trigrams of the texts, word borders included."""
    global _table
    if _table is None:
        _table = _letter_table()
    codes = np.frombuffer("  ".join(["", *texts, ""]).lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letters = _table[codes].astype(np.int32)
    grams = (letters[:-2] * SIZE + letters[1:-1]) * SIZE + letters[2:]
    return np.bincount(grams, minlength=SIZE**3)


def letter_costs(counts: np.ndarray) -> np.ndarray:
    """Negative log-probabilities of a letter behind two others, smoothed by shorter contexts."""
    three = counts.reshape(SIZE, SIZE, SIZE).astype(float)
    two = three.sum(axis=0)
    one = (two.sum(axis=0) + 1) / (two.sum() + SIZE)
    after_one = (two + 5 * one) / (two.sum(axis=1, keepdims=True) + 5)
    after_two = (three + 5 * after_one) / (three.sum(axis=2, keepdims=True) + 5)
    return -np.log(after_two).ravel()


def _choices(token: str) -> list[list[tuple[str, float]]]:
    """Per character: what it may stand for ('' nothing, ' ' a word border) and the cost."""
    found = []
    repeats = 0
    is_sign = [not c.isalpha() and c not in LOOKS_LIKE for c in token]
    for k, char in enumerate(token):
        repeats = repeats + 1 if k and token[k - 1] == char else 0
        long_run = repeats or token[k + 1 : k + 2] == char
        in_run = long_run and (repeats >= 2 or token[k - repeats : k - repeats + 3] == char * 3)
        if repeats and in_run:
            choices = [("", COST_REPEAT)]
            if repeats == 1 and char.isalpha():
                choices.append((char, COST_REPEAT))
        elif char.isalpha():
            choices = [(char, 0.0)]
        elif char in LOOKS_LIKE:
            choices = [(c, COST_LETTER) for c in LOOKS_LIKE[char]] + [("", COST_DROP)]
        else:
            # Next to a single letter a sign spells a word out rather than dividing two.
            spells = any(is_sign[max(0, k - 2) : k - 1]) or any(is_sign[k + 2 : k + 3]) or k == 1 or k == len(token) - 2
            choices = [("", COST_SEPARATOR), (" ", COST_SPLIT if spells else COST_SEPARATOR)]
        found.append(choices)
    return found


def restore(token: str, costs: list[float]) -> str:
    """The likeliest hidden text of a lower-case token, words divided by blanks."""
    other = SIZE - 1
    # (last letter but one, last letter) to (cost, text so far as a linked list).
    paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for choices in _choices(token):
        following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, text) in paths.items():
            base = (a * SIZE + b) * SIZE
            for char, extra in choices:
                if char == "":
                    state, new, behind = (a, b), cost + extra, text
                else:
                    letter = 0 if char == " " else LETTER.get(char, other)
                    state, new, behind = (b, letter), cost + extra + costs[base + letter], (char, text)
                held = following.get(state)
                if held is None or new < held[0]:
                    following[state] = (new, behind)
        paths = following
    best = min(((cost + costs[(a * SIZE + b) * SIZE], text) for (a, b), (cost, text) in paths.items()), key=lambda p: p[0])
    letters, text = [], best[1]
    while text:
        letters.append(text[0])
        text = text[1]
    return "".join(reversed(letters))


def plain_word(token: str) -> str | None:
    """The word of a lower-case token that needs no restoration, else None."""
    if token.isalpha() and not _RUN.search(token):
        return token
    word = token.strip(PLAIN_ENDS)
    word = _TAIL.sub("", word)
    if not word or not any(c.isalpha() for c in word):
        return ""
    return word if word.isalpha() and not _RUN.search(word) else None


def hidden_words(token: str, costs: list[float]) -> list[str]:
    """Words that a lower-case token may stand for."""
    word = plain_word(token)
    if word is not None:
        # A sign directly before a word may be its first letter.
        if word and token[0] in "!|(<":
            return [word, *restore(token.rstrip(PLAIN_ENDS), costs).split()]
        return [word] if word else []
    inner = _TAIL.sub("", token.strip("\"'()[]{}").rstrip(".,;:!?"))
    found = restore(inner, costs).split()
    once = re.sub(r"(.)\1\1+", r"\1", inner)
    if once != inner and once.isalpha():
        found.append(once)
    return found


def features_of(word: str) -> list[str]:
    """Features of a word: itself, marked at its end, and its first letters."""
    if len(word) < 3:
        return []
    return [word[:LONGEST] + "$", *[word[:k] for k in STEMS if len(word) >= k]]


@dataclass
class ToxicityModel:
    """What is broadcast: bounded by ``MAX_FEATURES`` and the alphabet."""

    costs: list[float]
    weights: dict[str, float]
    scale: tuple[float, float, float]
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


class Scorer:
    """Scores whole texts with one model; tokens seen before are looked up."""

    TOKENS = 250_000

    def __init__(self, model: ToxicityModel):
        self._model = model
        self._known: dict[str, float] = {}
        words = {f[:-1] for f in model.weights if f[-1] == "$"}
        self._inside = {k: {w for w in words if len(w) == k} for k in range(4, LONGEST + 1)}
        self._inside = {k: found for k, found in self._inside.items() if found}

    def _token(self, token: str) -> float:
        weights = self._model.weights
        found = [weights.get(f, 0.0) for word in hidden_words(token, self._model.costs) for f in features_of(word)]
        best = max(found, default=0.0)
        if len(self._known) < self.TOKENS and len(token) <= 48:
            self._known[token] = best
        return best

    def _spaced(self, run: str) -> float:
        """Strongest kept word spelled out by single characters.

        Words of four letters and more are looked for in the whole run; one of three, and first letters, only
        as what the run spells, because single letters spell them by chance.
        """
        costs, weights = self._model.costs, self._model.weights
        joined = restore("".join(run.split()), costs).replace(" ", "")
        best = max((weights.get(f, 0.0) for f in features_of(joined)), default=0.0)
        for k, words in self._inside.items():
            for at in range(len(joined) - k + 1):
                if joined[at : at + k] in words:
                    best = max(best, weights[joined[at : at + k] + "$"])
        return best

    def evidence(self, text: str) -> tuple[float, float]:
        """Weight of the strongest token, and of all other distinct ones together."""
        lower = text.lower()
        known, token = self._known.get, self._token
        best = total = 0.0
        for word in set(lower.split()):
            weight = known(word)
            if weight is None:
                weight = token(word)
            if weight:
                total += weight
                if weight > best:
                    best = weight
        for run in _SPACED.finditer(lower):
            weight = self._spaced(run.group())
            total += weight
            best = max(best, weight)
        return best, total - best

    def score(self, text: str) -> float:
        none, strongest, others = self._model.scale
        best, rest = self.evidence(text)
        logit = none + strongest * best + others * rest
        if not best:
            logit = min(logit, NO_EVIDENCE)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, logit))))


def _worker_scorer(shared) -> Scorer:
    model = shared.value
    return worker_tool(("toxicity", model.key), lambda: Scorer(model))


def _letter_model(docs: DataFrame, text_column: str) -> list[float]:
    """Letter costs from every whole text; at most one count per trigram of the alphabet is gathered."""
    target = arrow_schema("gram int, n long")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tool()
        total = np.zeros(SIZE**3, dtype=np.int64)
        for part in parts:
            # A bounded number of characters at a time.
            group, size = [], 0
            for text in part.column(0):
                group.append(text.as_py())
                size += len(group[-1])
                if size > 1_000_000:
                    total += trigram_counts(group)
                    group, size = [], 0
            if group:
                total += trigram_counts(group)
        grams = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(grams.astype(np.int32)), pa.array(total[grams])], schema=target)

    counted = docs.select(text_or_empty(text_column).alias("text")).mapInArrow(batches, "gram int, n long")
    counts = np.zeros(SIZE**3)
    for row in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[row.gram] = row.n
    return letter_costs(counts).tolist()


def training_labels(labels: DataFrame, rows: int = TRAINING_ROWS, hold_out: int = HOLD_OUT) -> DataFrame:
    """``doc_id`` and ``toxic`` of the training rows: not held out, lowest hashes first.

    A document with several labels is toxic if one says so; labels without an id or a value are left out.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    known = known.where(fold(F.col("doc_id"), hold_out) != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows: int = TRAINING_ROWS,
    hold_out: int = HOLD_OUT,
) -> ToxicityModel:
    """Model from all texts and at most ``rows`` labels.

    Without labels, with labels of one kind only, or with fewer rows than a feature needs, no feature is kept and every text
    gets the same score, which is below 0.5: a text without evidence is never called toxic, whatever the labels' share.
    Null texts count as empty. Of several rows of one id the model learns from one, so that the rows it
    learns from are bounded as the labels are.
    """
    spark = docs.sparkSession
    costs = _letter_model(docs, text_column)
    shared = spark.sparkContext.broadcast(costs)
    chosen = F.broadcast(training_labels(labels, rows, hold_out))  # at most ``rows`` pairs of numbers
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    marked = texts.join(chosen, "doc_id").groupBy("doc_id", "toxic")
    marked = marked.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("text", "toxic")

    schema = "feature string, clean long, toxic long"
    target = arrow_schema(schema)

    def features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tool()
        known: dict[str, list[str]] = {}
        counts: dict[str, list[int]] = {"": [0, 0]}  # under "" the documents
        for part in parts:
            for text, toxic in zip(part.column(0), part.column(1).to_pylist(), strict=True):
                found = {""}
                for token in set(text.as_py().lower().split()):
                    if token not in known:
                        known[token] = [f for word in hidden_words(token, shared.value) for f in features_of(word)]
                    found.update(known[token])
                for feature in found:
                    counts.setdefault(feature, [0, 0])[toxic] += 1
                if len(known) > HELD_TOKENS:
                    known.clear()
                if len(counts) > HELD_FEATURES:
                    yield _counted(counts, target)
                    counts = {"": [0, 0]}
        yield _counted(counts, target)

    counted = marked.mapInArrow(features, schema)
    counted = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    summary = counted.agg(
        F.count(F.when(F.col("clean") + F.col("toxic") >= MIN_DOCS, True)).alias("n"),
        F.sum(F.when(F.col("feature") == "", F.col("clean"))).alias("clean"),
        F.sum(F.when(F.col("feature") == "", F.col("toxic"))).alias("toxic"),
    )
    totals = summary.first()
    toxic, clean = totals["toxic"] or 0, totals["clean"] or 0
    if not toxic or not clean or not totals["n"]:
        return ToxicityModel(costs, {}, (math.log((toxic + 1) / (clean + 1)), 0.0, 0.0))
    least = math.log(totals["n"])
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    base = toxic / (toxic + clean)
    rest = F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - base))).otherwise(0.0)
    ratio = (F.col("toxic") * F.log(share / base) + rest).alias("ratio")
    found = counted.where(f"feature <> '' AND toxic >= {MIN_DOCS}").where(share > base)
    found = found.select("feature", "clean", "toxic", ratio).where(F.col("ratio") > least)
    found = found.orderBy(F.desc("ratio"), "feature").limit(MAX_FEATURES).collect()
    counts = {r["feature"]: (r["clean"], r["toxic"]) for r in found}
    number = {feature: k for k, feature in enumerate(counts)}

    def candidates(batch: dict[str, list]) -> dict[str, list]:
        lists = []
        for text in batch["text"]:
            tokens = text.lower().split()
            pairs = set()
            for before, token in zip(["", *tokens], tokens):
                words = hidden_words(token, shared.value)
                behind = crc32(before.encode("utf-8", "replace"))
                pairs.update((number[f], behind) for w in words for f in features_of(w) if f in number)
            lists.append([{"feature": f, "before": b} for f, b in sorted(pairs)])
        return {"held": lists}

    schema = "held array<struct<feature:int,before:long>>"
    held = store(map_rows(marked.where("toxic = 1").select("text"), schema, candidates), "toxic-features")
    pairs = held.select(F.inline("held"))
    spread = pairs.groupBy("feature").agg(F.count_distinct("before").alias("n")).collect()  # a number per feature
    names = list(counts)
    behind = {names[r.feature]: r.n for r in spread}
    # One bit per feature and training row: 125 MB at most, and a row at a time on the way.
    holders = dict.fromkeys(counts, 0)
    for k, row in enumerate(held.select(F.array_distinct("held.feature").alias("found")).toLocalIterator()):
        for feature in row.found:
            holders[names[feature]] |= 1 << k
    chosen = {*_covering(holders, counts, clean, toxic, least), *_widespread(behind, counts, clean, toxic, least)}
    chosen = _without_borrowed(chosen, counts)
    spread = math.log((clean + 1) / (toxic + 1))
    weights = {f: math.log((counts[f][1] + 0.5) / (counts[f][0] + 0.5)) + spread for f in chosen}
    unscaled = spark.sparkContext.broadcast(ToxicityModel(costs, weights, (0.0, 0.0, 0.0)))

    def evidence(batch: dict[str, list]) -> dict[str, list]:
        scorer = _worker_scorer(unscaled)
        found = [scorer.evidence(text) for text in batch["text"]]
        return {"best": [f[0] for f in found], "rest": [f[1] for f in found], "toxic": batch["toxic"]}

    seen = map_rows(marked, "best double, rest double, toxic int", evidence, with_tool=True)
    seen = seen.groupBy("best", "rest", "toxic").count().orderBy("best", "rest", "toxic").collect()
    return ToxicityModel(costs, weights, _scaled(np.array([tuple(r) for r in seen], dtype=float)))


def _scaled(seen: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of the label on the evidence, by Newton's method with a small ridge.

    ``seen``: rows of strongest weight, other weights, label, number of documents.
    """
    x = np.column_stack([np.ones(len(seen)), seen[:, :2]])
    label, number = seen[:, 2], seen[:, 3]
    ridge = np.diag([0.01, 0.01, 0.01])
    found = np.zeros(3)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(x @ found, -50, 50)))
        slope = x.T @ (number * (label - chance)) - ridge @ found
        bend = (x * (number * chance * (1 - chance))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        # Short steps: on separable evidence the full one would overshoot.
        found = found + step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return tuple(found.tolist())


def _counted(counts: dict[str, list[int]], target: pa.Schema) -> pa.RecordBatch:
    clean, toxic = ([pair[k] for pair in counts.values()] for k in (0, 1))
    return pa.RecordBatch.from_pydict({"feature": list(counts), "clean": clean, "toxic": toxic}, schema=target)


def _ratio(clean: int, toxic: int, base: float) -> float:
    """Log-likelihood ratio of a feature's counts against the share of toxic documents."""
    share = toxic / (toxic + clean) if toxic else 0.0
    if share <= base:
        return 0.0
    return toxic * math.log(share / base) + (clean * math.log((1 - share) / (1 - base)) if clean else 0.0)


def _covering(
    holders: dict[str, int], counts: dict[str, tuple[int, int]], clean: int, toxic: int, least: float
) -> list[str]:
    """Features that explain the toxic documents, the best first, each on those not explained before.

    ``holders``: a bit per toxic document that holds the feature. Words that toxic documents share for another
    reason, such as being copies of each other, lose their support once the documents are explained.
    """
    base = toxic / (toxic + clean)
    # Support only shrinks, so a feature's last ratio bounds its present one.
    heap = [(-_ratio(counts[f][0], h.bit_count(), base), f[-1] == "$", -len(f), f) for f, h in holders.items()]
    heapq.heapify(heap)
    explained = 0
    found = []
    while heap:
        before, word, size, feature = heapq.heappop(heap)
        holders[feature] &= ~explained
        now = -_ratio(counts[feature][0], holders[feature].bit_count(), base)
        if now > -least:
            continue
        if now > before:
            heapq.heappush(heap, (now, word, size, feature))
            continue
        found.append(feature)
        explained |= holders[feature]
    return found


def _widespread(
    behind: dict[str, int], counts: dict[str, tuple[int, int]], clean: int, toxic: int, least: float
) -> list[str]:
    """Features that stand behind many different words in the toxic documents, as copied text does not.

    ``behind``: the number of those words.
    """
    base = toxic / (toxic + clean)
    found = []
    for feature, words in behind.items():
        seen = counts[feature][1]
        count = min(words, seen)
        if count >= WIDESPREAD * seen and _ratio(counts[feature][0], count, base) > least:
            found.append(feature)
    return found


def _without_borrowed(chosen: set[str], counts: dict[str, tuple[int, int]]) -> set[str]:
    """Leaves out first letters that owe their toxic documents to one longer feature kept as well."""
    strongest: dict[str, str] = {}
    for feature in chosen:
        for k in STEMS:
            stem = feature[:k]
            if stem != feature and stem in chosen:
                held = strongest.get(stem)
                if held is None or counts[feature][1] > counts[held][1]:
                    strongest[stem] = feature
    rest = {s: (counts[s][0] - counts[f][0], counts[s][1] - counts[f][1]) for s, f in strongest.items()}
    return chosen - {stem for stem, (clean, toxic) in rest.items() if clean > toxic}


def score(
    docs: DataFrame,
    model: ToxicityModel,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    hold_out: int = HOLD_OUT,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row.

    A score of exactly 0.5 is predicted toxic. Null texts count as empty and score as any text without kept
    features, 0.25 at most. Repeated rows get the same row each, an empty table gives an empty result, other
    columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batch: dict[str, list]) -> dict[str, list]:
        scorer = _worker_scorer(shared)
        found = [scorer.score(text) for text in batch["text"]]
        columns = {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": found}
        return columns | {"predicted": [int(s >= 0.5) for s in found]}

    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (fold(F.col(id_column), hold_out) == 0).alias("held_out"),
        text_or_empty(text_column).alias("text"),
    )
    return map_rows(texts, "doc_id long, held_out boolean, score double, predicted int", rows, with_tool=True)


def without_toxic(docs: DataFrame, model: ToxicityModel, *, text_column: str = "text") -> DataFrame:
    """The rows of the table that are not predicted toxic: all columns, whatever their names.

    Rows with a null or empty text stay, repeated rows stay or go together, and a score of exactly 0.5 goes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(texts):
        scorer = _worker_scorer(shared)
        return texts.map(lambda text: scorer.score(text) < 0.5)

    return docs.where(clean(text_or_empty(text_column)))
