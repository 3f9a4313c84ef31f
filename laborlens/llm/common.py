"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import pickle
from contextlib import contextmanager
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ..session import scratch_path

#: Upper- and lower-case ASCII letters.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: For UTF-8 bytes: A-Z to a-z, every ASCII byte that is neither a letter nor a digit to a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def other_columns(df: DataFrame, produced: Sequence[str]) -> list[str]:
    """The columns of ``df`` that keep their place; one with a produced name is replaced by the result."""
    taken = {c.lower() for c in produced}
    return [c for c in df.columns if c.lower() not in taken]


def widened(df: DataFrame, produced: StructType) -> StructType:
    """The schema of ``df`` followed by the produced columns."""
    kept = set(other_columns(df, produced.fieldNames()))
    return StructType([StructField(f.name, f.dataType, True) for f in df.schema if f.name in kept] + list(produced))


def numbered(df: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with its columns renamed by number, and how to get them back, so that results can have any name."""
    names = df.columns
    plain = [f"column {i}" for i in range(len(names))]
    return df.toDF(*plain), lambda found: found.select(*plain).toDF(*names)


def pieces_by_bytes(sizes: Sequence[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cut consecutive rows into ranges of about ``limit`` bytes; every range has a row at least."""
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if i > first and held + size > limit:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def chunks(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with about ``limit`` bytes in a text column, and their texts in UTF-8; null counts as empty."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for lo, hi in pieces_by_bytes(sizes, limit):
        part = batch.slice(lo, hi - lo)
        yield part, [t or b"" for t in utf8(part.column(column))]


def lean(run: Callable) -> Callable:
    """A task's function that gives its memory back in the end; workers live on and would keep what it took."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
            if trim:
                trim(0)

    return wrapped


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast a value together with the code of its class; the result gives it back inside tasks."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    if getattr(sent, "_path", None):  # the bytes are in a file; neither the driver nor a worker needs them again at hand
        vars(sent).pop("_value", None)

    def load() -> Any:
        found = pickle.loads(sent.value)
        if getattr(sent, "_path", None):
            vars(sent).pop("_value", None)
        return found

    return load


def utf8(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


@contextmanager
def rows_a_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for what is written inside, where rows are wide."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write below the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of ids (two longs at most) that a task may hold for a join; more are left to a shuffle.
SMALL_ROWS = 500_000


def small(written: DataFrame) -> DataFrame:
    """A written table of ids, to be broadcast if its counted size allows it."""
    return F.broadcast(written) if written.count() <= SMALL_ROWS else written


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; plain ASCII text takes Spark's fast path."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
