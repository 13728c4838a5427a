"""What the operators of this subpackage share: tables, Arrow mapping, batches, the row key."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    Needed where workers share the driver's files but not its module path. On a cluster the package is
    shipped (``--py-files``), and a path that is not there does no harm.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table; the folder may lie in any store that Spark reads."""
    reach_workers(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of rows that the driver made, which must be few.

    They are handed over as Arrow. Python rows would first go through Python workers, and those are none of the
    workers that map Arrow batches but others, which then stay beside them for a minute.
    """
    target = arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) or [()] * len(target)
    arrays = [pa.array(values, field.type) for values, field in zip(columns, target, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=target))


def map_rows(
    df: DataFrame, schema: str, rows: Callable[[dict[str, list]], dict[str, list]], *, with_tool: bool = False
) -> DataFrame:
    """``mapInArrow`` over columns as Python lists; ``rows`` maps one batch to one batch.

    ``with_tool``: it uses ``worker_tool``; else the worker's tool of an earlier operator is dropped.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not with_tool:
            drop_tool()
        for part in parts:
            if part.num_rows:
                yield pa.RecordBatch.from_pydict(rows(part.to_pydict()), schema=target)

    target = arrow_schema(schema)
    return df.mapInArrow(batches, schema)


_tool: tuple[object, object] | None = None


def worker_tool(key: object, build: Callable[[], object]) -> object:
    """What a worker process built last, if it is for ``key``, else a new one in its place.

    Workers outlive their tasks. One tool at a time bounds their memory by the largest one.
    """
    global _tool
    if _tool is None or _tool[0] != key:
        drop_tool()
        _tool = key, build()
        give_back()
        # What was built holds no cycles; the collector need not look at it again.
        gc.freeze()
    return _tool[1]


def drop_tool() -> None:
    """Free the tool of an earlier operator in this worker process, and what its tasks took besides."""
    global _tool
    _tool = None
    give_back()


def give_back() -> None:
    """Return freed memory to the system.

    A worker lives through all stages, and its C library else keeps the most that any of them took.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries have none
    if trim:
        trim(0)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a Spark DDL string."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def text_or_empty(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def utf8(column: str = "text") -> Column:
    """The UTF-8 bytes of the text, empty where it is null."""
    return F.encode(text_or_empty(column), "UTF-8")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts).cast("long"))
