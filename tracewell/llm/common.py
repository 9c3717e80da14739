"""What the operators share: input, text pieces, one-row-per-row Arrow functions, tables between steps."""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell import session

T = TypeVar("T")


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def one_thread() -> None:
    """Native libraries get one thread: Spark has a task per core already."""
    for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS", "RAYON_NUM_THREADS"):
        os.environ[name] = "1"
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def pieces_of(batch: pa.RecordBatch, column: str, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `most_bytes` of text; a longer text is a slice of its own.

    Bounds what a task holds besides Spark's own batch, however long the texts are.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


_kept: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], T]) -> T:
    """What `make` gives, kept by this worker process between tasks.

    One thing at a time: a worker that goes on to another model or vocabulary lets go of the last one, so that a job of
    many steps holds no more than its largest step.
    """
    if key not in _kept:
        _kept.clear()
        release_memory()
        _kept[key] = make()
    return _kept[key]


def release_memory() -> None:
    """Give freed memory back to the system: a worker lives on, and its neighbours share the machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; no other character changes."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends at files that outlive executors."""
    spark = df.sparkSession
    path = session.new_table_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
