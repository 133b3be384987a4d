"""Helpers the operators share: reading tables, bounded Arrow batches, written steps."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TypeVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.session import scratch_dir

#: Fixed value: the characters counted as white space by the contracts, x20 and x09 to x0D.
BLANKS = " \t\n\x0b\x0c\r"

#: Upper bound of one Arrow batch sent to Python, unless the session sets its own.
BATCH_BYTES = 8 << 20


T = TypeVar("T")


def kept(key: tuple, make: Callable[[], T]) -> T:
    """What ``make`` gives, made once in the life of a worker process.

    The package travels to the workers by value, so its own modules start anew with every task;
    this is kept on the interpreter instead.
    """
    store = sys.__dict__.setdefault("_windrow_kept", {})
    if key not in store:
        store[key] = make()
    return store[key]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def in_batches(
    rows: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes, so that long texts can't fill a worker.

    A row is never split: a batch holds at least one row. The bound stays set in the session,
    because Spark reads it when the plan runs.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if rows.sparkSession.conf.get(key, None) in (None, str(2**31 - 1), f"{2**31 - 1}b"):
        rows.sparkSession.conf.set(key, str(BATCH_BYTES))
    return rows.mapInArrow(fn, schema)


def slices(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows whose values of a text column have about ``size`` bytes at most."""
    for batch in batches:
        start, have = 0, 0
        for row, length in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
            if row > start and have + length > size:
                yield batch.slice(start, row - start)
                start, have = row, 0
            have += length
        if batch.num_rows > start:
            yield batch.slice(start)


def written(rows: DataFrame, label: str, **options: str) -> DataFrame:
    """Write rows to the shared folder and read them back: lineage ends here, work is done once.

    ``options`` are those of the Parquet writer.
    """
    folder = scratch_dir(rows.sparkSession, label)
    rows.write.options(**options).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


@contextmanager
def short_reads(spark: SparkSession, size: int) -> Iterator[None]:
    """Within, Spark's Parquet reader decodes ``size`` rows at once, unless the session has its own number.

    The bound is read when a plan runs, so it holds for actions taken within.
    """
    key = "spark.sql.parquet.columnarReaderBatchSize"
    if spark.conf.get(key, None) not in (None, "4096"):
        yield
        return
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.unset(key)


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds
