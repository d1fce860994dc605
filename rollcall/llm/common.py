"""Helpers shared by the training-data operators.

Every operator takes the columns it names and ignores the rest, so extra or
clashing columns of the input never meet its own names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rollcall.session import materialize

#: White space that separates words in every contract of this package.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Row count up to which a side may be broadcast (ids and a few numbers a row).
BROADCAST_ROWS = 500_000

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; null ids belong to no held-out fold (fold -1)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1))


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a *written* table for broadcast when it has at most ``max_rows`` rows."""
    return F.broadcast(df) if df.count() <= max_rows else df


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` with a function from one batch to one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield out
    return df.mapInArrow(run, schema)


def text_slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``size`` bytes of ``text``; what a run left unused is given back."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size)))
        yield batch.slice(start, stop - start)
        start = stop
        pa.default_memory_pool().release_unused()


def with_fields(df: DataFrame, fields: str) -> StructType:
    """The schema of ``df`` and more fields (``StructType.add`` would change the DataFrame's own)."""
    return StructType([*df.schema.fields, *StructType.fromDDL(fields).fields])


__all__ = ["BROADCAST_ROWS", "DOCUMENT_COLUMNS", "WORD_PATTERN", "broadcast_checked", "fold", "map_batches",
           "materialize", "read_table",
           "text_slices", "with_fields"]
