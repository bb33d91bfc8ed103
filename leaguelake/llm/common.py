"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# characters handled at a time inside a task; a longer text is handled alone
SLICE_CHARS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The id and a hash of the text, which tell documents apart even when an id is repeated or NULL.

    Rows with the same id and the same text are one document to every operator that uses this key.
    """
    return F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("text_hash"))


def slices(lengths: Sequence[int], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose lengths add up to at most ``limit``, single longer items alone."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


Rows = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


# bytes of an Arrow batch, where the session has no setting of its own; whole texts make the usual batches large
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def mapped(df: DataFrame, work: Rows, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` with small batches, in tasks that leave no memory behind.

    A Python worker outlives its tasks, and what it has freed but not returned to the system would lie idle beside the
    next task.
    """

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from work(rows)
        finally:
            gc.collect()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    settings = df.sparkSession.conf
    if settings.get(BATCH_SETTING) == "67108864b":  # the default
        settings.set(BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def batches_of(rows: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple[pa.RecordBatch, list[list]]]:
    """Small pieces of Arrow batches with the named columns as Python lists, by the size of the last column.

    ``row.text`` names a field of a struct column.
    """

    def column(batch: pa.RecordBatch, name: str) -> pa.Array:
        first, *field = name.split(".")
        found = batch.column(batch.schema.get_field_index(first))
        return pa.compute.struct_field(found, field) if field else found

    for batch in rows:
        sizes = pa.compute.binary_length(column(batch, columns[-1])).to_pylist()
        for start, stop in slices([n or 0 for n in sizes]):
            piece = batch.slice(start, stop - start)
            yield piece, [column(piece, c).to_pylist() for c in columns]
        del batch


def starts_of(counts: Sequence[int]) -> np.ndarray:
    """Places where consecutive runs of the given lengths begin, and the end."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out

