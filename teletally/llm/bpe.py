"""Byte-pair encoding and decoding by dynamic programming over prefixes.

The encoding of a text by merges has one property that makes it a dynamic programme: of all
tokens that end at a prefix, exactly one can be its last token, namely the one that stays
separate from the last token of what precedes it when the two are merged afresh. For every
prefix that token is stored, and the ids are read off by going back from the end.

Tokens that end at a prefix come from an automaton over all tokens (suffix links give the
longest one and then the shorter ones). Whether two neighbours stay separate (`_separate`) is
decided by undoing merges on both sides of their border, latest first: if any two parts that
ever meet there would have been merged earlier than the merge that hides them, the pair is not
an encoding.

Texts are cut before merging as the tokenizer's own pattern does. A piece between two spaces
never depends on its neighbours unless spaces repeat, so pieces are looked up in a bounded table
of pieces already encoded; texts with repeated spaces go through the pattern as a whole, and so do texts with
white space that some token of the vocabulary joins to a blank behind it.
"""

from __future__ import annotations

import itertools
import json
import zlib
from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from teletally.llm.common import arrow_schema, map_rows, text_or_empty, worker_tool

# Fixed value: how the vocabulary's tokenizer cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# White space other than the blank.
WHITE = [chr(c) for c in range(0x3001) if chr(c).isspace() and c != 0x20]

# Entries of the per-worker tables of encoded pieces, of their parts and of tested pairs.
PIECES = 200_000
PARTS = 100_000
PAIRS = 400_000
# Texts whose ids are held at a time.
SLICE = 500


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file.

    Printable bytes of Latin-1 stand for themselves, the others for letters from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in printable}
    rest = [b for b in range(256) if b not in set(printable)]
    return letters | {chr(256 + k): b for k, b in enumerate(rest)}


def refuse_other_kinds(read: dict) -> None:
    """Raise for a vocabulary file whose settings would give other ids than this encoder does."""
    model, cut = read["model"], read.get("pre_tokenizer") or {}
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if any(cut.get(name) != value for name, value in plain.items()):
        raise ValueError(f"texts are cut by {cut.get('type')}, not by the byte-level pattern")
    for name in ("continuing_subword_prefix", "end_of_word_suffix", "dropout", "byte_fallback", "ignore_merges"):
        if model.get(name):
            raise ValueError(f"the model has {name}")
    if model.get("type", "BPE") != "BPE" or read.get("normalizer"):
        raise ValueError("only byte-pair encoding of texts as they are")
    for token in read["added_tokens"]:
        if any(token.get(name) for name in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"the added token {token['content']} is not taken literally")


class Vocabulary:
    """Tokens and merges of a byte-level vocabulary; any other kind raises."""

    def __init__(self, content: str | bytes):
        read = json.loads(content)
        refuse_other_kinds(read)
        letters = byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        model = read["model"]
        self.tokens = {i: raw(t) for t, i in model["vocab"].items()}
        ids = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in merges]
        self.special = {t["content"]: t["id"] for t in read["added_tokens"]}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            return cls(file.read())


class Encoder:
    """Encodes and decodes with the tables of one vocabulary.

    ``form`` makes of a piece's ids what is kept and returned for it, by default the ids themselves.
    """

    def __init__(self, vocabulary: Vocabulary, form: Callable[[Encoder, list[int]], object] | None = None):
        self.bytes_of = dict(vocabulary.tokens)
        for text, i in vocabulary.special.items():
            self.bytes_of[i] = text.encode()
        self._special = vocabulary.special
        self._cut = regex.compile(PATTERN).findall
        self._at_special = None
        if self._special:
            longest_first = sorted(self._special, key=len, reverse=True)
            self._at_special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")
        # Rank of the merge that makes a token (single bytes: none), and its two parts.
        self._merged: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b, made) in enumerate(vocabulary.merges):
            self._merged[a, b] = rank
            self._parts.setdefault(made, (rank, a, b))
        # Other white space that a token may join to a blank behind it, told by its last byte.
        behind = {a for token in vocabulary.tokens.values() for a, b in itertools.pairwise(token) if b == 0x20}
        self._joins_blanks = [c for c in WHITE if c.encode()[-1] in behind]
        self._separates: dict[int, bool] = {}
        self._form = form or (lambda encoder, ids: tuple(ids))
        self._pieces: dict[str, object] = {}
        self._parts_seen: dict[str, tuple[int, ...]] = {}
        self._automaton = ahocorasick.Automaton()
        for i, token in vocabulary.tokens.items():
            if self._whole(i):
                self._automaton.add_word(token.decode("latin-1"), (len(token), i))
        self._automaton.make_automaton()

    def _whole(self, token: int) -> bool:
        """Whether the bytes of a token, on their own, merge to that token."""
        if token not in self._parts:
            return len(self.bytes_of[token]) == 1
        _, a, b = self._parts[token]
        return self._whole(a) and self._whole(b) and self._separate(a, b, self._parts[token][0])

    def _separate(self, left: int, right: int, before: int | None = None) -> bool:
        """Whether no merge joins the two at their border.

        ``before``: only merges of a lower rank are held against the pair. At equal ranks the
        leftmost place merges first, hence the one-sided comparisons.
        """
        merged, parts = self._merged, self._parts
        limit = len(merged) if before is None else before
        while True:
            rank = merged.get((left, right))
            if rank is not None and rank < limit:
                return False
            a, b = parts.get(left), parts.get(right)
            if a is None and b is None:
                return True
            # Undo the later merge: the parts it hid met at the border before it.
            if b is None or (a is not None and a[0] > b[0]):
                limit = min(limit, a[0])
                left = a[2]
            else:
                limit = min(limit, b[0] + 1)
                right = b[1]

    def _merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the last token of every prefix, then back from the end."""
        known, separates, separate = self._separates, self._separates.get, self._separate
        last, length = [0] * len(piece), [0] * len(piece)
        for at, (size, token) in self._automaton.iter(piece.decode("latin-1")):
            if length[at]:
                continue
            start = at - size
            if start >= 0:
                pair = last[start] << 32 | token
                fits = separates(pair)
                if fits is None:
                    fits = separate(last[start], token)
                    if len(known) < PAIRS:
                        known[pair] = fits
                if not fits:
                    continue
            last[at], length[at] = token, size
        ids, at = [], len(piece) - 1
        while at >= 0:
            ids.append(last[at])
            at -= length[at]
        ids.reverse()
        return ids

    def _part(self, text: str) -> tuple[int, ...]:
        """Ids of one part that the pattern cut out."""
        ids = self._parts_seen.get(text)
        if ids is None:
            ids = tuple(self._merge(text.encode()))
            if len(self._parts_seen) < PARTS and len(text) <= 64:
                self._parts_seen[text] = ids
        return ids

    def _cut_piece(self, text: str) -> list[str]:
        """The pattern's parts of a text; letters with at most one sign behind need no pattern."""
        if text[:1] == " ":
            if text[1:].isalpha():
                return [text]
            if text[1:-1].isalpha() and text[-1] in ".,!":
                return [text[:-1], text[-1]]
        return self._cut(text)

    def _piece(self, text: str) -> object:
        """The form of a text without special tokens."""
        parts = self._cut_piece(text)
        room = len(self._pieces) < PIECES and len(text) <= 64
        if room and len(parts) == 1:
            # Kept as a piece, hence not as a part as well.
            ids = self._merge(text.encode())
        else:
            ids = []
            for part in parts:
                ids += self._part(part)
        found = self._form(self, ids)
        if room:
            self._pieces[text] = found
        return found

    def _encoded(self, text: str) -> list[object]:
        known, piece = self._pieces.get, self._piece
        if "  " in text or any(c in text for c in self._joins_blanks):
            return [known(part) or piece(part) for part in self._cut(text)]
        parts = text.split(" ")
        found = [known(part) or piece(part) for part in [" " + p for p in parts[1:]]]
        return [piece(parts[0]), *found] if parts[0] else found

    def pieces(self, text: str, specials: bool = True) -> list[object]:
        """Forms of the pieces of a whole text; with ``specials``, special tokens in it keep their own ids."""
        if not specials or self._at_special is None or not self._at_special.search(text):
            return self._encoded(text)
        found = []
        for part in self._at_special.split(text):
            if part in self._special:
                found.append(self._form(self, [self._special[part]]))
            elif part:
                found += self._encoded(part)
        return found

    def encode(self, text: str, specials: bool = True) -> list[int]:
        """Ids of a whole text, for an encoder whose form is the ids."""
        return [i for ids in self.pieces(text, specials) for i in ids]

    def decode(self, ids: Sequence[int]) -> str:
        """Text of the ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")


def digest_form(encoder: Encoder, ids: list[int]) -> tuple[int, bytes, bytes]:
    """Number of ids, their decimal form, the bytes they decode to."""
    return len(ids), ",".join(map(str, ids)).encode(), b"".join([encoder.bytes_of[i] for i in ids])


def worker_encoder(shared, form: Callable[[Encoder, list[int]], object] | None = None) -> Encoder:
    """The encoder of a broadcast vocabulary file, built once per worker process."""
    content = shared.value
    key = "bpe", zlib.crc32(content), form and form.__qualname__
    return worker_tool(key, lambda: Encoder(Vocabulary(content), form))


def broadcast_vocabulary(spark: SparkSession, path: str):
    """The vocabulary file (a few MB) on every executor; it is read on the driver only."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def ids_form(encoder: Encoder, ids: list[int]) -> bytes:
    """The ids in 32 bits each."""
    return np.array(ids, dtype="<i4").tobytes()


def encode(docs: DataFrame, path: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids of every whole text: ``doc_id``, ``n_tokens``, ``ids`` (array of int), ``round_trip``.

    ``round_trip``: whether the ids decode to the text again. One row per input row, repeated rows and ids
    included. A null text counts as empty and has no ids; an empty table gives an empty result; other
    columns are ignored, so their names may clash.
    """
    shared = broadcast_vocabulary(docs.sparkSession, path)
    schema = "doc_id long, n_tokens long, ids array<int>, round_trip boolean"
    target = arrow_schema(schema)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared, ids_form)
        for part in (p.slice(at, SLICE) for p in parts for at in range(0, p.num_rows, SLICE)):
            packed, same = [], []
            for text in part.column(1).to_pylist():
                packed.append(b"".join(encoder.pieces(text)))
                same.append(encoder.decode(np.frombuffer(packed[-1], dtype="<i4").tolist()) == text)
            counts = np.array([len(p) // 4 for p in packed], dtype=np.int64)
            ends = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
            ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(packed), dtype="<i4")))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts), ids.cast(target.field("ids").type), pa.array(same)], schema=target
            )

    return _named(docs, id_column, text_column).mapInArrow(batches, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Texts of the ids: ``doc_id``, ``text``. Null ids give a null text, no ids an empty one."""
    shared = broadcast_vocabulary(encoded.sparkSession, path)

    def rows(batch: dict[str, list]) -> dict[str, list]:
        encoder = worker_encoder(shared)
        texts = [None if ids is None else encoder.decode(ids) for ids in batch["ids"]]
        return {"doc_id": batch["doc_id"], "text": texts}

    return map_rows(encoded.select("doc_id", "ids"), "doc_id long, text string", rows, with_tool=True)


def digests(docs: DataFrame, path: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: number of ids, SHA-256 of the decimal ids joined by commas, of the decoded text.

    Ids and decoded bytes are joined from the pieces; rows, nulls and clashes as in ``encode``.
    """
    shared = broadcast_vocabulary(docs.sparkSession, path)

    def rows(batch: dict[str, list]) -> dict[str, list]:
        encoder = worker_encoder(shared, digest_form)
        counts, ids, texts = [], [], []
        for text in batch["text"]:
            pieces = encoder.pieces(text)
            counts.append(sum([p[0] for p in pieces]))
            ids.append(sha256(b",".join([p[1] for p in pieces])).hexdigest())
            decoded = b"".join([p[2] for p in pieces]).decode("utf-8", "replace")
            texts.append(sha256(decoded.encode()).hexdigest())
        return {"doc_id": batch["doc_id"], "n_tokens": counts, "ids_sha256": ids, "decoded_sha256": texts}

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(_named(docs, id_column, text_column), schema, rows, with_tool=True)


def _named(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
