"""Ranked lexical search by Block-Max MaxScore.

The index consists of segments, each of some whole documents. Within a segment every term has a posting list in
ascending order of ``doc_id``: positions of the documents and counts of the term, in blocks of up to 128 postings that
are compressed one by one. Beside each block stand, uncompressed, the position of its last posting and its strongest
postings, those that no other one of the block beats in count and in shortness at once. From them follows the
exact maximum of the block for any corpus, so a segment needs no statistics of the whole corpus and stays
valid when documents are added. A task builds the segments of the rows it reads; no posting is shuffled.

A search goes through the positions of a segment in windows. Lists whose maxima together do not exceed the item's 50th
score so far are non-essential: a document that only they hold cannot enter. The essential lists of the window are
added up; each document found gets the block maxima of the non-essential lists on top, and is rejected, without
decompressing any of their blocks, if that does not exceed the 50th score. For the rest the non-essential lists are
looked up from the strongest down, and documents are dropped as soon as what is left cannot lift them. Each segment
returns a heap of at most 50 documents per item, and the heaps are merged.

Items are searched in rounds of bounded size, each against all segments; a round is what is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from teletally.llm.common import arrow_schema, text_or_empty
from teletally.storage import store

TOP = 50
# Postings in a block, and from how many on it is compressed; documents and bytes of text in a segment.
BLOCK = 128
LEAST = 16
SEGMENT_DOCS = 8192
SEGMENT_BYTES = 2**24
# Positions in a window of the search, and bytes of terms in a round of items.
WINDOW = 2048
ROUND_BYTES = 2**24

# Terms are runs of ASCII digits and letters and of all other characters; A-Z are lower-cased.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

_SEGMENTS = (
    "segment long, n_docs long, n_terms long, block int, terms binary, meta binary, documents binary, postings binary"
)


def terms_of(text: str) -> list[bytes]:
    """Terms of a whole text in order, as UTF-8."""
    return text.encode("utf-8", "replace").translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    """What a term counts, by how many of all documents hold it."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What counts of a term are worth in documents of these lengths, before the term's weight."""
    m = 50 + (50 * length * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit integers in one compressed value."""
    data = b"".join([len(a).to_bytes(8, "little") + a.astype("<i8").tobytes() for a in arrays])
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpacked(value: bytes) -> list[np.ndarray]:
    data, at, found = zstandard.ZstdDecompressor().decompress(value), 0, []
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little")
        found.append(np.frombuffer(data, dtype="<i8", count=size, offset=at + 8))
        at += 8 + 8 * size
    return found


def _counted(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Terms in order; and for every term of every text, ordered by term: term, text, count."""
    texts = pa.concat_arrays([texts])
    _, offsets, data = texts.buffers()
    plain = (data.to_pybytes() if data else b"").translate(_TABLE)
    table = pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, offsets, pa.py_buffer(plain)])
    parts = pc.split_pattern(table, b" ")
    coded = parts.flatten().dictionary_encode()
    of_text = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    terms, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    order = np.argsort(np.array(terms, dtype=object)) if terms else np.zeros(0, dtype=np.int64)
    rank = np.empty(len(terms), dtype=np.int64)
    rank[order] = np.arange(len(terms))
    # The empty string, which stands between neighbouring signs, is first in order and no term.
    empty = bool(terms) and terms[order[0]] == b""
    code = rank[code] - empty
    of_text, code = of_text[code >= 0], code[code >= 0]
    both, counts = np.unique(code * len(texts) + of_text, return_counts=True)
    return [terms[k] for k in order[int(empty) :]], both // max(1, len(texts)), both % max(1, len(texts)), counts


def segment_row(segment: int, ids: list[int | None], texts: pa.Array, block: int = BLOCK) -> tuple | None:
    """One segment of the index; none if no document holds a term."""
    # Ascending ids, rows without one behind; equal ids stay in order.
    first = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0))
    terms, term, at, tf = _counted(texts.take(pa.array(first, pa.int64())))
    if not terms:
        return None
    length = np.bincount(at, weights=tf, minlength=len(ids)).astype(np.int64)
    held = np.flatnonzero(length)
    # Positions count only documents with terms.
    position = np.zeros(len(ids), dtype=np.int64)
    position[held] = np.arange(len(held))
    at, length = position[at], length[held]
    df = np.bincount(term, minlength=len(terms))
    starts = np.cumsum(df) - df
    blocks = -(-df // block)
    of_term = np.repeat(np.arange(len(terms)), blocks)
    within = np.arange(len(of_term)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    low = starts[of_term] + within * block
    high = np.minimum(low + block, (starts + df)[of_term])
    # The strongest postings: by falling count, those shorter than all before them in the block.
    of_block = np.repeat(np.arange(len(low)), high - low)
    order = np.lexsort((length[at], -tf, of_block))
    far = int(length.max()) + 1
    falling = length[at][order] + (len(low) - of_block[order]) * far
    least = np.minimum.accumulate(falling)
    strong = order[np.concatenate(([True], least[1:] < least[:-1]))]
    strong_counts = np.bincount(of_block[strong], minlength=len(low))
    # Blocks in a row; short ones stay as they are.
    data = np.stack([at, tf], axis=1).astype("<i4").tobytes()
    sizes = (high - low) * 8
    compress = zstandard.ZstdCompressor(level=1).compress
    parts, done = [], 0
    for k in np.flatnonzero(high - low >= LEAST).tolist():
        parts.append(data[done : 8 * int(low[k])])
        done = 8 * int(high[k])
        parts.append(compress(data[8 * int(low[k]) : done]))
        sizes[k] = len(parts[-1])
    parts.append(data[done:])
    meta = _packed(df, at[high - 1], sizes, strong_counts, tf[strong], length[at][strong])
    known = [ids[first[k]] for k in held.tolist()]
    documents = _packed(np.array([i or 0 for i in known]), np.array([i is not None for i in known]), length)
    terms_packed = zstandard.ZstdCompressor(level=1).compress(b" ".join(terms))
    return segment, len(held), int(length.sum()), block, terms_packed, meta, documents, b"".join(parts)


def build_index(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    segment_docs: int = SEGMENT_DOCS,
    segment_bytes: int = SEGMENT_BYTES,
    block: int = BLOCK,
) -> DataFrame:
    """Segments of the index over whole texts, stored in the shared folder.

    ``segment``, ``n_docs`` (with a term at least), ``n_terms`` (with repeats), ``block`` and the packed ``terms``, ``meta``,
    ``documents`` and ``postings``. A null text has no terms. Every row is a document of its own, also where ids repeat
    or are null. An empty table gives an empty index; other columns are ignored, so their names may clash.
    """
    target = arrow_schema(_SEGMENTS)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in parts:
            sizes = pc.binary_length(part.column(1)).to_numpy(zero_copy_only=False).cumsum()
            low = 0
            while low < part.num_rows:
                before = sizes[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(sizes, before + segment_bytes, "right")))
                high = min(high, low + segment_docs)
                some = part.slice(low, high - low)
                row = segment_row(number, some.column(0).to_pylist(), some.column(1), block)
                if row:
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, target)], schema=target)
                    number += 1
                low = high

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return store(texts.mapInArrow(batches, _SEGMENTS), "lexical-index")


class Segment:
    """One segment, open for a search; ``decompressed`` counts the blocks that were needed."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        terms = zstandard.ZstdDecompressor().decompress(row["terms"]).split(b" ")
        self.number = dict(zip(terms, range(len(terms)), strict=True))
        self.df, self.last, sizes, strong_counts, self.strong_tf, self.strong_n = _unpacked(row["meta"])
        self.ids, self.known, self.length = _unpacked(row["documents"])
        self.postings, self.n_docs, self.n_terms = row["postings"], n_docs, n_terms
        self.ends = np.cumsum(sizes)
        self.sizes = sizes
        self.strong_starts = np.concatenate(([0], np.cumsum(strong_counts)))
        # Blocks of term k: from first[k] to first[k + 1]. How long a block is follows from the term's df.
        self.block = row["block"]
        self.first = np.concatenate(([0], np.cumsum(-(-self.df // self.block))))
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @property
    def decompressed(self) -> int:
        return len(self._blocks)

    def maxima(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Last positions and greatest impacts of the blocks of a term."""
        found = self._lists.get(k)
        if found is None:
            low, high = int(self.first[k]), int(self.first[k + 1])
            some = slice(int(self.strong_starts[low]), int(self.strong_starts[high]))
            strong = impacts(self.strong_tf[some], self.strong_n[some], self.n_docs, self.n_terms)
            most = np.maximum.reduceat(strong, self.strong_starts[low:high] - self.strong_starts[low])
            found = self._lists[k] = self.last[low:high], most
        return found

    def postings_of(self, k: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and impacts of one block of a term, decompressed."""
        at = int(self.first[k]) + block
        found = self._blocks.get(at)
        if found is None:
            end, size = int(self.ends[at]), int(self.sizes[at])
            count = min(self.block, int(self.df[k]) - block * self.block)
            data = self.postings[end - size : end]
            if count >= LEAST:
                data = zstandard.ZstdDecompressor().decompress(data)
            pairs = np.frombuffer(data, dtype="<i4").reshape(count, 2).astype(np.int64)
            worth = impacts(pairs[:, 1], self.length[pairs[:, 0]], self.n_docs, self.n_terms)
            found = self._blocks[at] = pairs[:, 0], worth
        return found

    def best(self, terms: list[tuple[bytes, int]], top: int = TOP, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the ``top`` best documents for weighted terms; equal scores by position."""
        lists = [(self.number[t], w) for t, w in terms if t in self.number and w > 0]
        bounds = [int(self.maxima(k)[1].max()) * w for k, w in lists]
        # Weakest first, so that non-essential lists are a prefix.
        order = sorted(range(len(lists)), key=bounds.__getitem__)
        lists, bounds = [lists[k] for k in order], [bounds[k] for k in order]
        reach = np.cumsum(bounds) if bounds else np.zeros(0, dtype=np.int64)
        at, score = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        floor = 0
        for start in range(0, len(self.length), window):
            stop = min(start + window, len(self.length))
            essential = int(np.searchsorted(reach, floor, "right"))
            if essential == len(lists):
                break
            total = np.zeros(stop - start, dtype=np.int64)
            for k, w in lists[essential:]:
                last, _ = self.maxima(k)
                block = int(np.searchsorted(last, start))
                while block < len(last):
                    places, worth = self.postings_of(k, block)
                    low, high = np.searchsorted(places, (start, stop))
                    total[places[low:high] - start] += w * worth[low:high]
                    if last[block] >= stop - 1:
                        break
                    block += 1
            found = np.flatnonzero(total)
            total, found = total[found], found + start
            total, found = self._lifted(lists[:essential], total, found, floor, reach[essential - 1] if essential else 0)
            enter = total > floor
            if enter.any():
                at, score = np.concatenate([at, found[enter]]), np.concatenate([score, total[enter]])
                first = np.lexsort((at, -score))[:top]
                at, score = at[first], score[first]
                if len(at) == top:
                    floor = int(score[-1])
        return at, score

    def _lifted(self, lists: list[tuple[int, int]], total: np.ndarray, found: np.ndarray, floor: int, most: int):
        """Documents that non-essential lists may lift above ``floor``, with their whole scores."""
        wanted = total + most > floor
        total, found = total[wanted], found[wanted]
        if not lists or not len(found):
            return total, found
        # What each list's block may add at most, block by block, before any of them is decompressed.
        blocks = np.empty((len(lists), len(found)), dtype=np.int64)
        bound = np.empty((len(lists), len(found)), dtype=np.int64)
        for i, (k, w) in enumerate(lists):
            last, peak = self.maxima(k)
            blocks[i] = np.searchsorted(last, found)
            bound[i] = np.append(peak, 0)[blocks[i]] * w
        left = np.cumsum(bound, axis=0)
        wanted = total + left[-1] > floor
        for i in range(len(lists) - 1, -1, -1):
            total, found, blocks, bound, left = total[wanted], found[wanted], blocks[:, wanted], bound[:, wanted], left[:, wanted]
            if not len(found):
                return total, found
            k, w = lists[i]
            for block in np.unique(blocks[i][bound[i] > 0]).tolist():
                here = np.flatnonzero(blocks[i] == block)
                places, worth = self.postings_of(k, block)
                near = np.minimum(np.searchsorted(places, found[here]), len(places) - 1)
                total[here] += np.where(places[near] == found[here], worth[near] * w, 0)
            wanted = total + (left[i - 1] if i else 0) > floor
        return total[wanted], found[wanted]


def _frequencies(index: DataFrame, terms: set[bytes]) -> dict[bytes, int]:
    """In how many documents of the whole index each of some terms occurs, if in any."""
    shared = index.sparkSession.sparkContext.broadcast(terms)
    schema = "term binary, df long"
    target = arrow_schema(schema)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for packed, meta in zip(part.column(0), part.column(1), strict=True):
                held = zstandard.ZstdDecompressor().decompress(packed.as_py()).split(b" ")
                df = _unpacked(meta.as_py())[0].tolist()
                found = [(t, n) for t, n in zip(held, df, strict=True) if t in shared.value]
                columns = [t for t, _ in found], [n for _, n in found]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    counts = index.select("terms", "meta").mapInArrow(batches, schema)
    return {bytes(r["term"]): r["df"] for r in counts.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def search(
    index: DataFrame,
    items: DataFrame,
    *,
    top: int = TOP,
    window: int = WINDOW,
    round_bytes: int = ROUND_BYTES,
    item_column: str = "item_id",
    text_column: str = "text",
) -> DataFrame:
    """The ``top`` best documents of an index for each item: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    Only scores above 0; equal ones by ascending doc_id, rows without an id behind. The terms of an item are those of all
    its rows, each once: repeated rows change nothing. Items without terms, and an empty index, give no rows. A null
    item_id is an item.
    """
    spark = index.sparkSession
    kind = items.schema[item_column].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            terms = [list(set(terms_of(text))) for text in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(terms, target.field(1).type)], schema=target)

    schema = f"item_id {kind}, terms array<binary>"
    target = arrow_schema(schema)
    texts = items.select(F.col(item_column).alias("item_id"), text_or_empty(text_column).alias("text"))
    pairs = texts.mapInArrow(batches, schema).select("item_id", F.explode("terms").alias("term")).distinct()
    pairs = store(pairs, "item-terms")
    sums = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    size = pairs.agg(F.sum(F.octet_length("term") + 64)).first()[0]
    found = spark.createDataFrame([], f"item_id {kind}, doc_id long, score long")
    if sums[0] is None or size is None:
        return found.select("item_id", F.lit(0).alias("rank"), "doc_id", "score").limit(0)
    n_docs, n_terms = sums
    rounds = -(-size // round_bytes)
    for number in range(rounds):
        asked = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == number)
        of_item: dict = {}
        for row in asked.collect():
            of_item.setdefault(row["item_id"], []).append(bytes(row["term"]))
        df = _frequencies(index, {t for terms in of_item.values() for t in terms})
        asked_terms = {i: [(t, weight(n_docs, df[t])) for t in sorted(terms) if t in df] for i, terms in of_item.items()}
        found = found.union(_searched(index, asked_terms, kind, n_docs, n_terms, top, window))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _searched(index: DataFrame, asked: dict, kind: str, n_docs: int, n_terms: int, top: int, window: int) -> DataFrame:
    """The heaps of all segments for one round of items."""
    shared = index.sparkSession.sparkContext.broadcast(asked)
    schema = f"item_id {kind}, doc_id long, score long"
    target = arrow_schema(schema)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k in range(part.num_rows):
                row = {name: part.column(name)[k].as_py() for name in part.schema.names}
                segment = Segment(row, n_docs, n_terms)
                columns: list[list] = [[], [], []]
                for item, terms in shared.value.items():
                    at, score = segment.best(terms, top, window)
                    columns[0] += [item] * len(at)
                    columns[1] += [int(i) if there else None for i, there in zip(segment.ids[at], segment.known[at])]
                    columns[2] += score.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    return index.select("block", "terms", "meta", "documents", "postings").mapInArrow(batches, schema)
