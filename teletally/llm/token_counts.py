"""Token counts by a separator scan of flat token files.

A flat token file is a plain sequence of little-endian ids without any index: per document a header of five
values that spell its id, its tokens, and the end-of-document id. Reading finds the separators of a
block with one vectorised comparison. A document that lies within a block is counted there; the pieces at
block borders are stitched by a prefix scan: the number of separators before a piece, in file
order, names the document it belongs to, however many blocks that document spans. A task reads byte
ranges, not files, so a file of any size is shared by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from teletally.llm import bpe
from teletally.llm.common import arrow_schema, drop_tool, text_or_empty
from teletally.storage import shared_path

BLOCK = 2**20
# Blocks that are read at once, 32 MB; and how much of them a task takes when there is much to read.
RANGE_BLOCKS = 16
TASK_BYTES = 2**27
FILE_DOCUMENTS = 5_000
# Stores whose byte ranges Arrow reads.
RANGED = ("file", "hdfs", "viewfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")
HEADER = 5
# A header value holds 13 bits of the id; in the header of a row without an id all bits of the first are set.
BITS = 13
NO_ID = 2**14


def header(doc_id: int | None) -> list[int]:
    """The values that spell an id."""
    if doc_id is None:
        return [NO_ID] * HEADER
    bits = doc_id % 2**64
    return [bits >> BITS * k & 2**BITS - 1 for k in range(HEADER)]


def packed_form(encoder: bpe.Encoder, ids: list[int]) -> bytes:
    """A piece's ids as they stand in a file of 16-bit ids."""
    return np.array(ids, dtype="<u2").tobytes()


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    end: int = 50256,
    id_column: str = "doc_id",
    text_column: str = "text",
    file_documents: int = FILE_DOCUMENTS,
) -> None:
    """Encode every whole text and write flat token files of 16-bit ids under ``path``.

    The string of a special token in a text is ordinary text, so the end-of-document id stands at ends only. Null
    texts count as empty. A file holds at most ``file_documents`` documents, however long these are; for an
    empty table there may be no file. Spark's own writer puts down records and separators.
    """
    spark = docs.sparkSession
    shared = bpe.broadcast_vocabulary(spark, tokenizer)
    if end >= 2**16 or max(bpe.Vocabulary.read(tokenizer).tokens) >= 2**16:
        raise ValueError("ids must fit in 16 bits")
    target = arrow_schema("record binary")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.worker_encoder(shared, packed_form)
        for part in parts:
            found = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                pieces = encoder.pieces(text.as_py(), specials=False)
                found.append(b"".join([np.array(header(doc_id), dtype="<u2").tobytes(), *pieces]))
                if len(found) == 500:
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], schema=target)
                    found = []
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], schema=target)

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    records = texts.mapInArrow(batches, "record binary").select(F.col("record").cast("string").alias("value"))
    separator = end.to_bytes(2, "little").decode("latin-1")
    written = records.write.option("encoding", "ISO-8859-1").option("lineSep", separator)
    written.option("maxRecordsPerFile", file_documents).text(path)


def scan(
    tokens: np.ndarray, end: int, block: int = BLOCK, first: int = 0
) -> Iterator[tuple[int, int, int, bool, bool, np.ndarray]]:
    """Pieces of a token sequence: (block, number in it, tokens, whole, closed, first tokens).

    ``whole``: the piece is a document from start to end. ``closed``: a separator stands behind it. Blocks
    are numbered from ``first``.
    """
    for k in range(-(-len(tokens) // block)):
        held = tokens[k * block : (k + 1) * block]
        ends = np.flatnonzero(held == end)
        starts = np.concatenate(([0], ends + 1))
        stops = np.concatenate((ends, [len(held)]))
        for piece, (start, stop) in enumerate(zip(starts.tolist(), stops.tolist(), strict=True)):
            closed = piece < len(ends)
            if closed or stop > start:
                yield first + k, piece, stop - start, closed and piece > 0, closed, held[start : min(stop, start + HEADER)]


def opened(path: str) -> pa.NativeFile:
    """A file by the path that Spark's listing gives it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pa.fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    system, place = pa.fs.FileSystem.from_uri(quote(path.replace("s3a:", "s3:", 1), safe="/:@"))
    return system.open_input_file(place)


def byte_ranges(files: DataFrame, size: int) -> DataFrame:
    """``file``, ``range`` for every ``size`` bytes of every file, dealt to tasks. Only the listing is read."""
    spark = files.sparkSession
    listed = files.where("length > 1").select(F.col("path").alias("file"), F.expr(f"(length - 1) div {size}").alias("last"), "length")
    totals = listed.agg(F.sum("length").alias("bytes"), F.sum(F.col("last") + 1).alias("ranges")).first()
    shuffle_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, -(-(totals["bytes"] or 0) // TASK_BYTES), min(totals["ranges"] or 0, shuffle_partitions))
    return listed.select("file", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("range")).repartition(tasks)


def count_tokens(
    spark: SparkSession,
    path: str,
    *,
    end: int = 50256,
    block: int = BLOCK,
    range_blocks: int = RANGE_BLOCKS,
    ranged: bool | None = None,
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``closed`` for every document in the flat token files under ``path``.

    ``n_tokens`` leaves out header and separator. A document cut off at the end of a file is reported with
    ``closed`` false, in its header with no tokens; half an id at the end of a file is no token. A header without an id gives a null id.
    Repeated documents are reported one by one. Rows do not depend on ``block`` and ``range_blocks``, the
    blocks that are read at once. ``ranged`` false: files are read whole by Spark's reader, 2 GB each at
    most, for stores that Arrow doesn't open; by default that is decided by the path's scheme.
    """
    schema = "file string, block long, piece int, n long, whole boolean, closed boolean, head array<int>"
    target = arrow_schema(schema)

    def rows(pieces: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        found: list[list] = [[] for _ in target]
        for row in pieces:
            for column, value in zip(found, row, strict=True):
                column.append(value)
            if len(found[0]) >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, target)], schema=target)
                found = [[] for _ in target]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, target)], schema=target)

    def ids(content: bytes | pa.Buffer) -> np.ndarray:
        return np.frombuffer(content, dtype="<u2", count=len(content) // 2)

    def by_range(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tool()

        def pieces() -> Iterator[tuple]:
            for part in parts:
                for file, number in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    with opened(file) as source:
                        content = source.read_at(size, number * size)
                    for row in scan(ids(content), end, block, number * range_blocks):
                        yield file, *row

        yield from rows(pieces())

    def by_file(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tool()

        def pieces() -> Iterator[tuple]:
            for part in parts:
                for file, content in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    for row in scan(ids(content.as_buffer()), end, block):
                        yield file, *row

        yield from rows(pieces())

    size = 2 * block * range_blocks
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    if ranged is None:
        ranged = ":" not in path or path.partition(":")[0] in RANGED
    if ranged:
        pieces = byte_ranges(files.select("path", "length"), size).mapInArrow(by_range, schema)
    else:
        pieces = files.select("path", "content").mapInArrow(by_file, schema)
    inner = pieces.where("whole").select("head", "n", "closed")
    # Few pieces per block stand at its borders; those of a file are put in order.
    before = Window.partitionBy("file").orderBy("block", "piece").rowsBetween(Window.unboundedPreceding, -1)
    border = pieces.where("NOT whole")
    border = border.withColumn("document", F.coalesce(F.sum(F.col("closed").cast("int")).over(before), F.lit(0)))
    parts = F.array_sort(F.collect_list(F.struct("block", "piece", "head")))
    stitched = border.groupBy("file", "document").agg(
        F.flatten(F.transform(parts, lambda p: p["head"])).alias("head"),
        F.sum("n").alias("n"),
        F.max("closed").alias("closed"),
    )
    every = inner.union(stitched.select("head", "n", "closed"))
    bits = [F.shiftleft(F.get("head", F.lit(k)).cast("long"), BITS * k) for k in range(HEADER)]
    spelled = bits[0]
    for value in bits[1:]:
        spelled = spelled.bitwiseOR(value)
    doc_id = F.when((F.size("head") >= HEADER) & (F.get("head", F.lit(0)) < NO_ID), spelled)
    return every.select(doc_id.alias("doc_id"), F.greatest(F.col("n") - HEADER, F.lit(0)).alias("n_tokens"), "closed")


def document_token_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``closed`` of every row: flat token files are written and scanned.

    The files go to a new folder of the shared storage. Rows as in ``write_token_files`` and ``count_tokens``;
    an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "token-files")
    write_token_files(docs, path, tokenizer)
    return count_tokens(spark, path)
