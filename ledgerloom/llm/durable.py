"""What the operators share: kept plans, tables, and tasks that leave no memory behind."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..durable import checkpoint_dir, cut, remove

__all__ = ["checkpoint_dir", "cut", "give_back", "read", "remove", "small_batches", "tidy"]

#: Texts that pass between the engine and Python at once.
BATCH_ROWS = 2000

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(rows: DataFrame) -> DataFrame:
    """``rows``, for whose texts the session's Arrow batches are set to ``BATCH_ROWS`` if they are larger."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(rows.sparkSession.conf.get(setting))
    if not 0 < now <= BATCH_ROWS:
        rows.sparkSession.conf.set(setting, str(BATCH_ROWS))
    return rows


def give_back() -> None:
    """Returns memory that this process no longer uses."""
    gc.unfreeze()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not the GNU C library: nothing to trim


def tidy(run: Run) -> Run:
    """``run`` for a task, after which the Python worker, which later stages use again, gives its memory back."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
