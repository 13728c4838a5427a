"""A hidden Markov language model, trained by Baum-Welch over all training documents.

Symbols are the most frequent words, each by itself, and classes of all other words (by their last
letters). A hidden state emits a symbol, a class emits its word by add-one frequency, so every text has an
exact probability: the scaled forward recursion over its symbols times its words' shares of their classes.

The jobs, each over whole texts: count words; turn texts into symbols, with the words outside the
dictionary beside them; count neighbouring symbols to find first states; per iteration, sum expected counts
over all partitions; score. Words outside the dictionary meet their counts in a shuffle join, so the
vocabulary has no bound, while all that is broadcast or gathered is bounded by the dictionary and the
states. Such words are rarer than those inside, so none of their keys is hot.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teletally.llm.common import arrow_schema, fold, text_or_empty
from teletally.storage import store

HOLD_OUT, HELD = 7, 2
DICTIONARY = 2**17
LONGEST = 32
LEAST = 3
CLASSES = 256
STATES = 8
ITERATIONS = 2
TOP = 512
LANE_TOKENS = 300_000
FLUSH = 400_000
END = b""  # no word is empty


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; the end is not among them."""
    return text.encode("utf-8", "replace").lower().split()


def class_of(word: bytes) -> int:
    """Class of a word outside the dictionary, by its last three bytes."""
    return crc32(word[-3:]) % CLASSES


# --- counts and dictionary -------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``c`` over rows of ``text``; each text adds one end, the empty word.

    Counts are summed per task before the shuffle, in a table of bounded size.
    """
    target = arrow_schema("word binary, n long")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for part in parts:
            for text in part.column(0):
                held.update(tokens(text.as_py()))
                held[END] += 1
                if len(held) > FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(held.values())], schema=target)
                    held.clear()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], schema=target
        )

    return texts.mapInArrow(batches, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Dictionary:
    """The frequent words in order of their ids, with their counts, and sums over the others."""

    ids: dict[bytes, int]
    counts: np.ndarray
    total: int
    distinct: int
    class_counts: np.ndarray
    class_words: np.ndarray

    @property
    def symbols(self) -> int:
        return len(self.ids) + CLASSES


def build_dictionary(counts: DataFrame, size: int = DICTIONARY) -> Dictionary:
    """The words of a count so high that at most ``size`` words reach it, and the end.

    Only words of up to 32 bytes enter, which bounds the dictionary in bytes, and only words counted 3
    times, so that classes learn from rare words where unseen ones stand. Counts are ranked by 64 steps per
    doubling, so what is gathered to find the limit is bounded too.
    """
    step = F.floor(F.log2(F.col("c").cast("double")) * 64).cast("int")
    short = (F.length("word") <= LONGEST) & (F.col("c") >= LEAST)
    ranked = counts.withColumn("step", step)
    steps = ranked.where(short).groupBy("step").count().orderBy(F.desc("step")).collect()
    reached, limit = 0, None
    for row in steps:
        reached += row["count"]
        if reached > size:
            break
        limit = row["step"]
    inside = short & (F.col("step") >= (limit if limit is not None else 2**30)) | (F.col("word") == F.lit(END))
    sums = counts.agg(F.sum("c").alias("total"), F.count("*").alias("distinct")).first()
    found = ranked.where(inside).select("word", "c").toArrow()
    words = {w: c for w, c in zip(found["word"].to_pylist(), found["c"].to_pylist(), strict=True)}
    ends = words.pop(END, 0)
    order = [END, *sorted(words, key=lambda w: (-words[w], w))]
    outside = ranked.where(~inside).groupBy(
        F.pmod(F.crc32(F.expr("substring(word, -3)")), F.lit(CLASSES).cast("long")).alias("class")
    )
    class_counts, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in outside.agg(F.sum("c").alias("c"), F.count("*").alias("words")).collect():
        class_counts[row["class"]], class_words[row["class"]] = row["c"], row["words"]
    return Dictionary(
        {w: k for k, w in enumerate(order)},
        np.array([ends, *[words[w] for w in order[1:]]], dtype=float),
        sums["total"] or 0,
        sums["distinct"],
        class_counts,
        class_words,
    )


# --- symbols -----------------------------------------------------------------------------------


def to_symbols(texts: DataFrame, dictionary: Dictionary) -> DataFrame:
    """One row per document of ``doc_id``, ``held_out``, ``text``.

    Adds ``row`` (unique), ``n_tokens``, ``symbols`` (32-bit ids as bytes), the sum over dictionary words of
    log10(c + 1), the number of them that were counted, and the other words with their numbers.
    """
    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, symbols binary, inside double, known long, "
        "others array<binary>, numbers array<int>"
    )
    target = arrow_schema(schema)
    shared = texts.sparkSession.sparkContext.broadcast((dictionary.ids, np.log10(dictionary.counts + 1), dictionary.counts > 0))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, logs, seen = shared.value
        get, size = ids.get, len(ids)
        row = TaskContext.get().partitionId() << 40
        for part in parts:
            found: dict[str, list] = {name: [] for name in target.names}
            for text in part.column("text"):
                words = tokens(text.as_py())
                symbols = np.array([*[get(w, -1) for w in words], 0], dtype=np.int32)
                at = np.flatnonzero(symbols < 0)
                others = Counter([words[k] for k in at.tolist()])
                within = symbols[symbols >= 0]
                symbols[at] = [size + class_of(words[k]) for k in at.tolist()]
                found["row"].append(row)
                found["n_tokens"].append(len(symbols))
                found["symbols"].append(symbols.tobytes())
                found["inside"].append(float(logs[within].sum()))
                found["known"].append(int(seen[within].sum()))
                found["others"].append(list(others))
                found["numbers"].append(list(others.values()))
                row += 1
            found["doc_id"], found["held_out"] = part.column("doc_id"), part.column("held_out")
            yield pa.RecordBatch.from_pydict(found, schema=target)

    return texts.select("doc_id", "held_out", "text").mapInArrow(batches, schema)


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(value.as_buffer(), dtype=np.int32) for value in column]


# --- the model -----------------------------------------------------------------------------------


@dataclass
class HiddenMarkov:
    """Start, transition and emission probabilities; ``emit`` has a row per symbol."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def _groups(sequences: list[np.ndarray]) -> Iterator[list[int]]:
    """Sequences by falling length, in groups of a bounded number of tokens."""
    order = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
    group, size = [], 0
    for k in order:
        group.append(k)
        size += len(sequences[k])
        if size >= LANE_TOKENS:
            yield group
            group, size = [], 0
    if group:
        yield group


def forward(sequences: list[np.ndarray], model: HiddenMarkov, expected: dict | None = None) -> np.ndarray:
    """Natural log-likelihood of every sequence by the scaled forward recursion.

    All sequences of a group advance together, one position at a time. With ``expected``, the backward
    recursion follows and adds expected starts, moves and emissions to it.
    """
    result = np.zeros(len(sequences))
    move, states = model.move, len(model.start)
    for group in _groups(sequences):
        lengths = np.array([len(sequences[k]) for k in group])
        running = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # longer than t
        offset = np.concatenate(([0], np.cumsum(running)))
        lane = np.repeat(np.arange(len(group)), lengths)
        time = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        place = offset[time] + lane
        symbols = np.empty(offset[-1], dtype=np.int32)
        symbols[place] = np.concatenate([sequences[k] for k in group])
        emitted = model.emit[symbols]
        alpha, scale = np.empty((offset[-1], states)), np.empty(offset[-1])
        now = None
        for t in range(lengths[0]):
            low, high = offset[t], offset[t + 1]
            now = emitted[low:high] * (model.start if t == 0 else now[: high - low] @ move)
            total = now.sum(axis=1)
            now /= total[:, None]
            alpha[low:high], scale[low:high] = now, total
        result[group] = np.bincount(lane, weights=np.log(scale)[place], minlength=len(group))
        if expected is not None:
            _backward(alpha, emitted, scale, offset, symbols, model, expected)
    return result


def _backward(alpha, emitted, scale, offset, symbols, model: HiddenMarkov, expected: dict) -> None:
    """Expected counts of one group; ``alpha`` becomes the state probabilities."""
    states = len(model.start)
    backward = model.move.T.copy()
    emitted /= scale[:, None]
    moved = np.zeros((states, states))
    beta = np.ones((offset[-1] - offset[-2], states))
    for t in range(len(offset) - 2, 0, -1):
        low, high, before = offset[t], offset[t + 1], offset[t - 1]
        onward = emitted[low:high] * beta
        moved += alpha[before : before + high - low].T @ onward
        alpha[low:high] *= beta
        beta = np.ones((low - before, states))
        beta[: high - low] = onward @ backward
    alpha[: offset[1]] *= beta
    expected["move"] += model.move * moved
    expected["start"] += alpha[: offset[1]].sum(axis=0)
    for state in range(states):
        expected["emit"][:, state] += np.bincount(symbols, weights=alpha[:, state], minlength=len(model.emit))


def first_model(neighbours: np.ndarray, bucket: np.ndarray, weight: np.ndarray, states: int, rounds: int = 60) -> HiddenMarkov:
    """A model from counts of neighbouring buckets alone: the likeliest states for pairs.

    ``bucket``: bucket of every symbol; ``weight``: its expected count.
    """
    size = len(neighbours)
    noise = np.random.default_rng(7)
    one = neighbours.sum(axis=0) + neighbours.sum(axis=1) + 1e-3
    emit = one[:, None] / one.sum() * noise.uniform(0.5, 1.5, (size, states))
    emit /= emit.sum(axis=0)
    joint = noise.uniform(0.5, 1.5, (states, states)) + 2 * np.eye(states)
    joint /= joint.sum()
    for _ in range(rounds):
        ratio = neighbours / np.maximum(emit @ joint @ emit.T, 1e-300)
        left, right = emit * (ratio @ (emit @ joint.T)), emit * (ratio.T @ (emit @ joint))
        joint = joint * (emit.T @ ratio @ emit) + 1e-6
        joint /= joint.sum()
        emit = left + right + 1e-9 * one[:, None]
        emit /= emit.sum(axis=0)
    start = joint.sum(axis=1)
    state_of = emit * start
    state_of = (state_of + 1e-12) / (state_of + 1e-12).sum(axis=1, keepdims=True)
    found = weight[:, None] * state_of[bucket]
    return HiddenMarkov(start / start.sum(), joint / joint.sum(axis=1, keepdims=True), found / found.sum(axis=0))


def _neighbours(symbols: DataFrame, bucket: np.ndarray, size: int) -> np.ndarray:
    """Counts of neighbouring buckets over all rows, at most ``size`` squared numbers."""
    target = arrow_schema("pair int, n long")
    shared = symbols.sparkSession.sparkContext.broadcast(bucket)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, dtype=np.int64)
        for part in parts:
            for sequence in _sequences(part.column(0)):
                held = shared.value[sequence]
                np.add.at(total, held[:-1] * size + held[1:], 1)
        pairs = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int32)), pa.array(total[pairs])], schema=target)

    found = symbols.select("symbols").mapInArrow(batches, "pair int, n long")
    found = found.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    result = np.zeros(size * size)
    result[found["pair"].to_numpy()] = found["n"].to_numpy()
    return result.reshape(size, size)


def _expected(symbols: DataFrame, model: HiddenMarkov) -> dict:
    """Expected counts over all rows: summed per task, then by symbol across partitions.

    Rows below 0 carry the moves out of a state, and the last of them the starts.
    """
    states, size = len(model.start), len(model.emit)
    schema = "symbol int, " + ", ".join(f"s{k} float" for k in range(states))
    target = arrow_schema(schema)
    shared = symbols.sparkSession.sparkContext.broadcast(model)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {"emit": np.zeros((size, states)), "move": np.zeros((states, states)), "start": np.zeros(states)}
        for part in parts:
            forward(_sequences(part.column(0)), shared.value, total)
        seen = np.flatnonzero(total["emit"].any(axis=1))
        names = np.concatenate([seen, -1 - np.arange(states + 1)]).astype(np.int32)
        values = np.concatenate([total["emit"][seen], total["move"], total["start"][None, :]]).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array(names), *[pa.array(values[:, k]) for k in range(states)]], schema=target)

    sums = [F.sum(F.col(f"s{k}").cast("double")).alias(f"s{k}") for k in range(states)]
    found = symbols.select("symbols").mapInArrow(batches, schema).groupBy("symbol").agg(*sums).toArrow()
    names = found["symbol"].to_numpy()
    values = np.column_stack([found[f"s{k}"].to_numpy() for k in range(states)])
    emit, rest = np.zeros((size, states)), np.zeros((states + 1, states))
    emit[names[names >= 0]] = values[names >= 0]
    rest[-1 - names[names < 0]] = values[names < 0]
    return {"emit": emit, "move": rest[:states], "start": rest[states]}


def _estimated(expected: dict, prior: np.ndarray) -> HiddenMarkov:
    """Probabilities from expected counts, smoothed by the symbols' overall shares."""
    states = len(expected["start"])
    emit = expected["emit"] + 50 * prior[:, None]
    move = expected["move"] + 0.1
    start = expected["start"] + 1 / states
    return HiddenMarkov(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def train(symbols: DataFrame, dictionary: Dictionary, states: int = STATES, iterations: int = ITERATIONS) -> HiddenMarkov:
    """Baum-Welch over all rows of ``symbols``, from first states found on neighbouring symbols."""
    words = [w for w, _ in sorted(dictionary.ids.items(), key=lambda p: p[1])]
    weight = np.concatenate([dictionary.counts, dictionary.class_counts]) + 1
    classes = [min(k, TOP) if k < TOP else TOP + class_of(w) for k, w in enumerate(words)]
    bucket = np.array([*classes, *range(TOP, TOP + CLASSES)], dtype=np.int64)
    model = first_model(_neighbours(symbols, bucket, TOP + CLASSES), bucket, weight, states)
    prior = weight / weight.sum()
    for _ in range(iterations):
        model = _estimated(_expected(symbols, model), prior)
    return model


# --- scores --------------------------------------------------------------------------------------


def _likelihoods(symbols: DataFrame, model: HiddenMarkov) -> DataFrame:
    """Log10-likelihood of every row's symbols, with its other plain columns."""
    schema = "row long, doc_id long, held_out boolean, n_tokens long, inside double, known long, symbol_score double"
    target = arrow_schema(schema)
    shared = symbols.sparkSession.sparkContext.broadcast(model)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = forward(_sequences(part.column("symbols")), shared.value) / math.log(10)
            columns = [part.column(name) for name in target.names[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], schema=target)

    return symbols.select(*target.names[:-1], "symbols").mapInArrow(batches, schema)


def score_documents(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    dictionary_size: int = DICTIONARY,
    states: int = STATES,
    iterations: int = ITERATIONS,
) -> DataFrame:
    """Probability of every whole text under the model learnt from the training documents.

    Training documents are those whose crc32 of the id as text is not 2 modulo 7 (a null id counts as empty
    text). Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one unigram), score
    (hidden Markov model), both log10. A null or empty text is an end alone. Repeated rows are scored one by
    one. Without training documents every count is zero and the model is uniform; an empty table gives an
    empty result; other columns are ignored.
    """
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (fold(F.col(id_column), HOLD_OUT) == HELD).alias("held_out"),
        text_or_empty(text_column).alias("text"),
    )
    counts = store(word_counts(texts.where(~F.col("held_out")).select("text")), "word-counts")
    dictionary = build_dictionary(counts, dictionary_size)
    symbols = store(to_symbols(texts, dictionary), "symbols")
    model = train(symbols.where(~F.col("held_out")), dictionary, states, iterations)

    smooth = dictionary.class_counts + dictionary.class_words + 1
    class_size = F.array(*[F.lit(float(math.log10(x))) for x in smooth])
    others = symbols.select("row", F.explode(F.arrays_zip("others", "numbers")).alias("pair"))
    others = others.select("row", F.col("pair.others").alias("word"), F.col("pair.numbers").cast("long").alias("n"))
    others = others.join(counts, "word", "left")
    in_class = F.pmod(F.crc32(F.expr("substring(word, -3)")), F.lit(CLASSES).cast("long")).cast("int")
    seen = F.log10(F.coalesce(F.col("c"), F.lit(0)) + 1)
    others = others.groupBy("row").agg(
        F.sum(F.col("n") * seen).alias("outside"),
        F.sum(F.col("n") * (seen - F.get(class_size, in_class))).alias("word_score"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("others_known"),
    )
    joined = _likelihoods(symbols, model).join(others, "row", "left")
    per_token = math.log10(dictionary.total + dictionary.distinct + 1)
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("others_known", F.lit(0))).alias("n_known"),
        F.lit(dictionary.total).cast("long").alias("train_tokens"),
        (F.col("inside") + F.coalesce("outside", F.lit(0.0)) - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("symbol_score") + F.coalesce("word_score", F.lit(0.0))).alias("score"),
    )
