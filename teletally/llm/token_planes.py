"""Token files in bit or byte planes.

The ids of all documents, in ascending order of ``doc_id`` and with an end id behind each, form one sequence.
It is cut into chunks of a fixed number of ids. A chunk is transposed into planes, all first bytes (or bits)
of its ids, then all second ones, and so on, and every plane is compressed with zstandard by itself: high bits hardly
vary, so their planes shrink to almost nothing.

The files lie in one folder: ``chunks`` has a row per chunk with its planes and, small beside them, the documents
that it holds and how many ids of each; ``index`` has a row per chunk with the place of its first id in the whole
sequence, so that a range of ids or a document is read without touching other chunks. Both are Parquet, whose
writer commits whole tasks only: a lost executor leaves no half-written file behind.

Nothing passes through one task: rows are sorted by range, every task cuts its own part of the sequence, and
only one number per writing task is summed up to find where its part begins.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from teletally.llm.common import arrow_schema, text_or_empty, worker_tool
from teletally.storage import shared_path, store

CHUNK = 2**16
END = 1
LEVEL = 3
# Entries of the per-worker table of encoded words, and the longest word kept in it.
WORDS = 500_000
LONGEST = 48
# Signs that are words of their own behind letters.
SIGNS = ".,!?:;"
# Bytes of text that are encoded at a time.
SLICE = 2**23

_CHUNKS = (
    "part int, chunk long, first long, n int, crc long, carried long, open boolean, "
    "docs array<long>, counts array<int>, planes array<binary>"
)


def to_planes(ids: np.ndarray, kind: str = "byte") -> list[np.ndarray]:
    """Planes of unsigned 32-bit ids, lowest first: 4 of whole bytes or 32 of single bits."""
    data = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return list(np.ascontiguousarray(data.T))
    if kind == "bit":
        bits = np.unpackbits(data, axis=1, bitorder="little")
        return list(np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little"))
    raise ValueError(f"planes are of kind byte or bit, not {kind}")


def from_planes(planes: list[bytes], count: int) -> np.ndarray:
    """The ids again; the number of planes tells their kind."""
    held = np.stack([np.frombuffer(plane, dtype=np.uint8) for plane in planes])
    if len(planes) == 32:
        bits = np.unpackbits(held, axis=1, count=count, bitorder="little")
        held = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").T
    return np.ascontiguousarray(held.T).view("<u4").ravel()


class WordEncoder:
    """The tokenizers library behind a bounded table of words.

    For a vocabulary whose pre-tokenizer drops white space and never looks across it, the ids of a text are those
    of its words one after the other, and full stops, commas and the like behind letters are words of their own.
    """

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(content)
        self._library.no_truncation()
        self._library.no_padding()
        self._words: dict[str, bytes] = {}

    @staticmethod
    def _stems(words: pa.Array) -> tuple[pa.Array, list[int], list[str]]:
        """Words without the signs behind them, ASCII letters in lower case; which words had signs, and those."""
        plain = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "<")))
        low = pc.if_else(plain, pc.ascii_lower(words), words)
        stems = pc.utf8_rtrim(low, characters=SIGNS)
        # Letters of Latin-1 stay single letters when the library normalises them, so a word ends behind them.
        stems = pc.if_else(pc.match_substring_regex(stems, "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]$"), stems, low)
        sizes = pc.subtract(pc.binary_length(low), pc.binary_length(stems)).to_numpy()
        at = np.flatnonzero(sizes)
        signs = [word[-n:] for word, n in zip(low.take(pa.array(at)).to_pylist(), sizes[at].tolist(), strict=True)]
        return stems, at.tolist(), signs

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Ids of single words, by the table or else by the library."""
        known = self._words
        found = list(map(known.get, words))
        lacking = list({word for word, ids in zip(words, found, strict=True) if ids is None})
        if lacking:
            encodings = self._library.encode_batch_fast(lacking, add_special_tokens=False)
            fresh = {word: array("I", e.ids).tobytes() for word, e in zip(lacking, encodings, strict=True)}
            found = [fresh[word] if ids is None else ids for word, ids in zip(words, found, strict=True)]
            if len(known) < WORDS:
                some = [(word, ids) for word, ids in fresh.items() if len(word) <= LONGEST]
                known.update(some[: WORDS - len(known)])
        return found

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all whole texts in a row, and where each text's ids begin and end; ``end`` stands behind each."""
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        borders = words.offsets.to_numpy() - words.offsets[0].as_py()
        coded = words.flatten().dictionary_encode()
        stems, at, signs = self._stems(coded.dictionary)
        found = self._encoded(stems.to_pylist())
        for k, ids in zip(at, self._encoded(signs), strict=True):
            found[k] += ids
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        ids = np.frombuffer(b"".join(found), dtype="<u4")
        at = coded.indices.to_numpy()
        counts = sizes[at]
        stops = np.cumsum(counts)
        # The ids of the distinct words, repeated as the words are.
        shift = (np.cumsum(sizes) - sizes)[at] - (stops - counts)
        every = ids[np.repeat(shift, counts) + np.arange(stops[-1] if len(stops) else 0)]
        borders = np.concatenate(([0], stops))[borders]
        if end is None:
            return every, borders
        return np.insert(every, borders[1:], np.uint32(end)), borders + np.arange(len(borders))


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Rows from and to, of about ``most`` bytes of text, one row at least."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    low = 0
    while low < len(sizes):
        before = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield low, high
        low = high


def _words_alone(content: str) -> bool:
    """Whether a tokenizer file drops white space before merging, so that words can be encoded one by one."""
    import json

    read = json.loads(content)
    first = ((read.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    pattern = first.get("pattern", {}).get("Regex", "")
    dropped = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    tokens = [t["content"] for t in read["added_tokens"]]
    plain = all(not (t["lstrip"] or t["rstrip"] or t["normalized"]) for t in read["added_tokens"])
    cuts = set(" \n" + SIGNS)
    return dropped and r"[^\s\p{L}\p{N}]+" in pattern and plain and not any(cuts & set(t) for t in tokens)


class _Cutter:
    """Chunks of one part of the sequence, out of its documents in order."""

    def __init__(self, part: int, size: int, kind: str, level: int):
        self.part, self.size, self.kind = part, size, kind
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.chunk = self.first = 0
        self._begin(0)

    def _begin(self, carried: int) -> None:
        self.held, self.docs, self.counts, self.n, self.carried = [], [], [], 0, carried

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        """Put a document's ids in; chunks come out as they fill."""
        placed = 0
        while placed < len(ids):
            taken = ids[placed : placed + self.size - self.n]
            self.held.append(taken)
            self.docs.append(doc_id)
            self.counts.append(len(taken))
            self.n += len(taken)
            placed += len(taken)
            if self.n == self.size:
                yield self._row(placed < len(ids))
                self._begin(placed if placed < len(ids) else 0)

    def rest(self) -> Iterator[tuple]:
        """The last chunk, if it is not empty."""
        if self.n:
            yield self._row(False)

    def _row(self, still_open: bool) -> tuple:
        ids = np.concatenate(self.held)
        planes = [self.compress(plane.tobytes()) for plane in to_planes(ids, self.kind)]
        check = crc32(ids.tobytes())
        row = (self.part, self.chunk, self.first, self.n, check, self.carried, still_open, self.docs, self.counts, planes)
        self.chunk += 1
        self.first += self.n
        return row


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    end: int = END,
    chunk: int = CHUNK,
    planes: str = "byte",
    level: int = LEVEL,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode every whole text and write the ids of all documents under ``path``, as the module describes.

    Ascending ``doc_id``, rows without one first; rows of equal id stand in order of their texts' hashes, repeated
    rows side by side. A null text counts as empty and has the end id alone. An empty table gives empty files;
    other columns are ignored, so their names may clash. Ids are unsigned 32-bit numbers.
    """
    spark = docs.sparkSession
    to_planes(np.zeros(0, dtype="<u4"), planes)
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    if not _words_alone(content):
        raise ValueError("the tokenizer must drop white space before it merges")
    shared = spark.sparkContext.broadcast(content.encode())
    target = arrow_schema(_CHUNKS)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        encoder = worker_tool(("words", crc32(vocabulary)), lambda: WordEncoder(vocabulary.decode()))
        cutter = _Cutter(TaskContext.get().partitionId(), chunk, planes, level)

        def rows() -> Iterator[tuple]:
            for part in parts:
                for low, high in _slices(part.column(1), SLICE):
                    some = part.slice(low, high - low)
                    ids, borders = encoder.encode(some.column(1), end)
                    for k, doc_id in enumerate(some.column(0).to_pylist()):
                        yield from cutter.add(doc_id, ids[borders[k] : borders[k + 1]])
            yield from cutter.rest()

        for row in rows():
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, target)], schema=target)

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    # Equal ids, and even a row repeated many times, can be cut between tasks by the minor keys.
    order = "doc_id", "text_hash", "row"
    texts = texts.withColumns({"text_hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.mapInArrow(batches, _CHUNKS).write.parquet(f"{path}/chunks")

    # One row per writing task, so one task may add them up.
    chunks = spark.read.schema(_CHUNKS).parquet(f"{path}/chunks")
    sizes = chunks.groupBy("part").agg(F.sum("n").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    located = chunks.select("part", "chunk", "first", "n", "carried", "open").join(F.broadcast(starts), "part")
    # ``first``: place of the chunk's first id in the whole sequence.
    located = located.withColumn("first", F.col("start") + F.col("first")).drop("start")
    located.write.parquet(f"{path}/index")


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """``part``, ``chunk``, ``first``, ``n``, ``carried`` (ids of its first document before it), ``open`` of every chunk."""
    return spark.read.parquet(f"{path}/index")


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """All chunks with the place of their first id in the whole sequence; only where parts begin is sent around."""
    chunks = spark.read.schema(_CHUNKS).parquet(f"{path}/chunks")
    starts = chunk_index(spark, path).where("chunk = 0").select("part", F.col("first").alias("start"))
    placed = chunks.join(F.broadcast(starts), "part").withColumn("first", F.col("start") + F.col("first"))
    return placed.drop("start")


def _ids_of(row: dict) -> np.ndarray:
    """Ids of a chunk, checked."""
    expand = zstandard.ZstdDecompressor().decompress
    ids = from_planes([expand(plane) for plane in row["planes"]], row["n"])
    if len(ids) != row["n"] or crc32(ids.tobytes()) != row["crc"]:
        raise ValueError(f"chunk {row['chunk']} of part {row['part']} is damaged")
    return ids


def _pieces(chunks: DataFrame, value, kind: str) -> DataFrame:
    """``doc_id``, ``start`` (of the whole document), ``at`` (of the piece), ``n``, ``whole``, ``value`` of its ids."""
    schema = f"doc_id long, start long, at long, n long, whole boolean, value {kind}"
    target = arrow_schema(schema)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k in range(part.num_rows):
                row = {name: part.column(name)[k].as_py() for name in part.schema.names}
                ids, counts = _ids_of(row), np.array(row["counts"], dtype=np.int64)
                stops = np.cumsum(counts)
                at = row["first"] + stops - counts
                start, whole = at.copy(), np.ones(len(counts), dtype=bool)
                start[0] -= row["carried"]
                whole[0] &= row["carried"] == 0
                whole[-1] &= not row["open"]
                values = [value(ids[low:high]) for low, high in zip((stops - counts).tolist(), stops.tolist())]
                columns = row["docs"], start, at, counts, whole, values
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    return chunks.select("part", "chunk", "first", "n", "crc", "carried", "open", "docs", "counts", "planes").mapInArrow(
        batches, schema
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids`` (32-bit numbers, end id included) of every document in the files."""
    pieces = _pieces(_chunks(spark, path), lambda ids: ids.tobytes(), "binary")
    whole = pieces.where("whole").select("doc_id", "start", "n", "value")
    parts = F.array_sort(F.collect_list(F.struct("at", "value")))
    cut = pieces.where("NOT whole").groupBy("start").agg(
        F.min("doc_id").alias("doc_id"), F.sum("n").alias("n"), F.transform(parts, lambda p: p["value"]).alias("values")
    )
    joined = F.aggregate("values", F.lit(b""), lambda held, one: F.concat(held, one))
    every = whole.union(cut.select("doc_id", "start", "n", joined))
    return every.select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("value").alias("ids"))


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """``at``, ``ids`` (32-bit numbers) of the chunks' shares of the places ``start`` to ``stop`` of the sequence.

    Only chunks are read that the index places there.
    """
    wanted = chunk_index(spark, path).where((F.col("first") < stop) & (F.col("first") + F.col("n") > start))
    target = arrow_schema("at long, ids binary")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                low = max(0, start - row["first"])
                ids = _ids_of(row)[low : stop - row["first"]]
                yield pa.RecordBatch.from_pydict({"at": [row["first"] + low], "ids": [ids.tobytes()]}, schema=target)

    chunks = _chunks(spark, path).join(wanted.select("part", "chunk"), ["part", "chunk"], "left_semi")
    return chunks.mapInArrow(batches, "at long, ids binary")


def joined_crc(crc: int, crc_next: int, size_next: int) -> int:
    """crc32 of two byte strings in a row, from theirs and the size of the second.

    The checksum is affine in its starting value, so zeros in the place of the second string carry the first on.
    """
    zeros = bytes(min(size_next, 2**20))
    carried, plain = crc, 0
    while size_next:
        some = zeros[:size_next]
        carried, plain = crc32(some, carried), crc32(some, plain)
        size_next -= len(some)
    return carried ^ plain ^ crc_next


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document in the files.

    A document that lies in several chunks is put together from their checksums, not from its ids.
    """
    schema = "doc_id long, start long, n long, value long"
    target = arrow_schema(schema)

    def joined(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents out of their pieces, which come in order."""
        held = None
        for part in parts:
            found = []
            for doc_id, start, n, value in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):
                if held is not None and held[1] == start:
                    held = doc_id, start, held[2] + n, joined_crc(held[3], value, 4 * n)
                    continue
                if held is not None:
                    found.append(held)
                held = doc_id, start, n, value
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), target)], schema=target)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(held, target)], schema=target)

    # Stored: they are read twice, and chunks are decoded once.
    pieces = store(_pieces(_chunks(spark, path), lambda ids: crc32(ids.tobytes()), "long"), "token-pieces")
    cut = pieces.where("NOT whole").repartition("start").sortWithinPartitions("start", "at")
    cut = cut.select("doc_id", "start", "n", "value").mapInArrow(joined, schema)
    every = pieces.where("whole").select("doc_id", "start", "n", "value").union(cut)
    return every.select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("value").alias("ids_crc32"))


def document_checksums(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write token files to a new folder of the shared storage, read them back, and give ``checksums``.

    One row per input row; nulls, ties, repeated rows and empty tables as in ``write_token_files``.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "token-planes")
    write_token_files(docs, path, tokenizer)
    return checksums(spark, path)
