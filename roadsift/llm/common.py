"""Helpers that several training-data operators share."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsift.scratch import cut, forget, shared_checkpoints

__all__ = ["cut", "forget", "shared_checkpoints"]

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Arrow batches hold at most this many bytes, so that very long texts don't pile up in a worker.
ARROW_BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes and not by rows alone."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


#: Memory of its own from which a Python worker gives back what is free, in MB; one that has only loaded its libraries holds about 120.
WORKER_MB = 200


def is_heavy() -> bool:
    """Whether this worker holds more than WORKER_MB of its own."""
    try:
        with open("/proc/self/statm", encoding="ascii") as f:
            _, resident, shared = map(int, f.read().split()[:3])
    except OSError:  # another system
        return False
    return (resident - shared) * 4096 > WORKER_MB << 20


def settle() -> None:
    """Give free memory back to the system where it is much: Python workers wait for further tasks, with all that they have ever held otherwise. Small tasks, of which there may be very many, don't pay for it."""
    if not is_heavy():
        return
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def settled(fn: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """fn over the batches of a task, and settle() after the last one."""
    @functools.wraps(fn)
    def run(batches: Iterator) -> Iterator:
        yield from fn(batches)
        settle()

    return run


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    bound_batches(df.sparkSession)
    return df.mapInArrow(settled(fn), schema)


def utf8_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def sha256_text(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
