"""Helpers of several operators: reading, written cuts, text slices, row keys."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.operators.ordering import scratch_path

#: Stands for a missing id inside row keys; ordinary ids are never this small.
NO_ID = -(2**63)

#: Bytes of text that one numpy step works on; only the size of temporary arrays.
SLICE_BYTES = 8 << 20

#: Narrow rows that are worth a file of their own.
FILE_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: it outlives executors and is computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few_files(df: DataFrame, rows: int) -> DataFrame:
    """A frame of about ``rows`` narrow rows in as many partitions as they fill files: on a local folder each file that is
    written makes its executor start processes (chmod)."""
    return df.coalesce(max(1, -(-rows // FILE_ROWS)))


def row_key(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    """(k1, k2, text) of each row, and more columns of it: its id and a hash of its text. Rows with the same key are copies
    of each other, so whatever holds for one holds for all of them. A missing text is empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("k1"), F.xxhash64(text).alias("k2"), text.alias("text"), *more)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``limit`` bytes of text; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string column without nulls."""
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters them (the finaliser of MurmurHash3)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def partitions(spark: SparkSession) -> int:
    """How many parts an exchange of packed blocks has: what the session sets for shuffles."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def give_back() -> None:
    """Memory that this process has freed goes back to the system. A Python worker outlives its task, and what its
    allocators keep would stand beside all that the executor does next."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc
        pass


def lean(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The function for applyInArrow, with the memory given back that a group and the one before it have freed."""

    def freed(whole: pa.Table) -> pa.Table:
        give_back()
        out = run(whole)
        give_back()
        return out

    return freed


def lean_stream(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function for mapInArrow, with the memory given back at the end that a task has freed."""

    def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return freed
