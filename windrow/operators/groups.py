"""Python functions over groups, partitions and elements.

Native expressions come first; these wrappers are for logic Spark cannot express. They
exchange Arrow tables, hand pandas frames to the function and check what it returns
against the declared schema: a value that does not fit the declared type raises instead
of turning into a wrong number.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from windrow.session import scratch_dir

Frame = pd.DataFrame


class OutputMismatch(TypeError):
    """A function returned something else than its declared schema."""


def as_schema(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T.StructType.fromDDL(schema)


def to_frame(table: pa.Table) -> Frame:
    """Arrow to pandas, integers as nullable integers whether or not nulls occur."""
    kinds = {
        pa.int8(): pd.Int8Dtype(),
        pa.int16(): pd.Int16Dtype(),
        pa.int32(): pd.Int32Dtype(),
        pa.int64(): pd.Int64Dtype(),
    }
    return table.to_pandas(types_mapper=kinds.get)


def conform(frame: Frame, schema: pa.Schema, by_position: bool = False) -> pa.Table:
    """The returned frame as an Arrow table of exactly the declared schema."""
    names = [str(c) for c in frame.columns]
    if len(names) != len(schema.names):
        raise OutputMismatch(f"declared {schema.names}, returned {names}")
    if by_position:
        frame = frame.set_axis(schema.names, axis=1)
    elif set(names) != set(schema.names):
        raise OutputMismatch(f"declared {schema.names}, returned {names}")
    columns = []
    for field in schema:
        values = frame[field.name]
        numbers = pa.types.is_integer(field.type) or pa.types.is_floating(field.type)
        if numbers and values.dtype == object:
            values = values.infer_objects()
        try:
            columns.append(pa.array(values, type=field.type, from_pandas=True, safe=True))
        except (pa.ArrowInvalid, pa.ArrowTypeError) as error:
            raise OutputMismatch(f"column {field.name} does not fit {field.type}: {error}") from error
    return pa.Table.from_arrays(columns, schema=schema)


def _select(df: DataFrame, columns: Sequence[str] | None, keys: Sequence[str] = ()) -> DataFrame:
    """Only the columns the function needs: Spark cannot prune through Python."""
    if columns is None:
        return df
    return df.select(*dict.fromkeys([*keys, *columns]))


def apply_groups(
    df: DataFrame,
    keys: Sequence[str],
    fn: Callable[[tuple, Any], Any],
    schema: T.StructType | str,
    *,
    columns: Sequence[str] | None = None,
    prepend_key: bool = False,
    by_position: bool = False,
    batches: bool = False,
    order: Sequence[str] = (),
) -> DataFrame:
    """Call ``fn(key, frame)`` once per group with all its rows.

    The whole group meets in one task, as the meaning asks: it must fit there. With ``batches``
    the function is called ``fn(key, frames)`` instead, with an iterator over frames of bounded
    size, and yields frames or returns one: a group of any size streams through it, and what it
    holds on to is all that is held. Python then never sees more than a batch; Spark sorts the rows
    by group on disk where memory ends. ``order`` sorts the rows inside each group by further
    columns, among those given. For groups whose rows need not meet, use ``reduce_groups``.

    With ``prepend_key`` the function returns its own columns only and the key columns are
    put in front.
    """
    df = _select(df, columns, keys)
    declared = to_arrow_schema(as_schema(schema))
    key_fields = [declared.field(k) for k in keys] if prepend_key else []
    own = pa.schema([f for f in declared if f not in key_fields])

    def finished(key: tuple, frame: Frame) -> pa.Table:
        result = conform(frame, own, by_position)
        for i, f in enumerate(key_fields):
            result = result.add_column(i, f, pa.array([key[i]] * result.num_rows, type=f.type))
        return result.select(declared.names)

    def call(key: tuple, table: pa.Table) -> pa.Table:
        key = tuple(k.as_py() for k in key)
        return finished(key, fn(key, to_frame(table)))

    def stream(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = tuple(k.as_py() for k in key)
        given = (to_frame(pa.Table.from_batches([part])) for part in parts if part.num_rows)
        result = fn(key, given)
        for frame in [result] if isinstance(result, Frame) else result:
            yield from finished(key, frame).to_batches()

    if order and not batches:
        raise ValueError("order is for functions over batches")
    if not batches:
        return df.groupBy(*keys).applyInArrow(call, as_schema(schema))
    # Spark tells the two kinds of function apart by these.
    stream.__annotations__ = {
        "key": tuple[pa.Scalar, ...],
        "parts": Iterator[pa.RecordBatch],
        "return": Iterator[pa.RecordBatch],
    }
    if order:
        # Dealt and sorted here, by group first: the grouping needs neither again and keeps this order.
        df = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return df.groupBy(*keys).applyInArrow(stream, as_schema(schema))


def apply_partitions(
    df: DataFrame,
    fn: Callable[[Frame], Frame],
    schema: T.StructType | str,
    *,
    columns: Sequence[str] | None = None,
    whole: bool = False,
    first: bool = False,
    by_position: bool = False,
    batches: bool = False,
) -> DataFrame:
    """Call ``fn(frame)`` on the rows of each partition, batch by batch.

    With ``whole`` the function sees a partition at once, as its meaning may need; size the
    partitions for that by a repartition before, or see ``apply_partitions_twice``. With ``first`` it sees
    the first batch that has rows, and the rest of the partition is not held. With ``batches`` it is
    called once per partition with an iterator over its frames, and yields frames.
    """
    declared = to_arrow_schema(as_schema(schema))

    def stream(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in fn(to_frame(pa.Table.from_batches([part])) for part in parts if part.num_rows):
            yield from conform(frame, declared, by_position).to_batches()

    if batches:
        return _select(df, columns).mapInArrow(stream, as_schema(schema))

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = (batch for batch in batches if batch.num_rows)
        if first:
            tables = [[batch] for batch in itertools.islice(full, 1)]
        elif whole:
            tables = [held] if (held := list(full)) else []
        else:
            tables = ([batch] for batch in full)
        for table in tables:
            yield from conform(fn(to_frame(pa.Table.from_batches(table))), declared, by_position).to_batches()

    return _select(df, columns).mapInArrow(call, as_schema(schema))


def apply_partitions_twice(
    df: DataFrame,
    statistics: Callable[[DataFrame, str], DataFrame],
    fn: Callable[[Iterator[Frame]], Iterator[Frame]],
    schema: T.StructType | str,
    *,
    columns: Sequence[str] | None = None,
    part: str = "_part",
) -> DataFrame:
    """A function that needs statistics of its whole partition, for partitions of any size.

    The rows are stored with the number of their partition. ``statistics(rows, part)`` makes one row per
    partition from them, by aggregations; in the second pass ``fn(frames)`` gets the rows in
    batches, each with its partition's number and statistics as further columns. No partition is held
    in Python, and rows keep their partition however the second pass is laid out.
    """
    rows = _select(df, columns)
    folder = scratch_dir(df.sparkSession, "partitions")
    rows.withColumn(part, F.spark_partition_id()).write.parquet(folder)
    stored = df.sparkSession.read.schema(T.StructType([*rows.schema.fields, T.StructField(part, T.IntegerType())])).parquet(folder)
    known = statistics(stored, part)
    # One row per partition of the job before, as many as Spark has tasks.
    return apply_partitions(stored.join(F.broadcast(known), part), fn, schema, batches=True)


def reduce_groups(
    df: DataFrame,
    keys: Sequence[str],
    partial: Callable[[Frame], Frame],
    partial_schema: T.StructType | str,
    combine: Sequence[Column],
    finish: Callable[[Frame], Frame] | None = None,
    schema: T.StructType | str | None = None,
    *,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A function per group for groups of any size.

    ``partial`` summarises one batch of rows (one row per key in it), Spark merges the
    summaries with the native aggregates in ``combine``, and ``finish`` turns the merged
    rows, one per group, into the result. Only summaries are shuffled.
    """
    parts = apply_partitions(df, partial, partial_schema, columns=[*keys, *columns] if columns else None)
    merged = parts.groupBy(*keys).agg(*combine)
    return apply_partitions(merged, finish, schema) if finish else merged


def map_elements(
    elements: DataFrame | Iterable[Any],
    fn: Callable[[Any], Frame | dict],
    schema: T.StructType | str,
    *,
    spark: SparkSession | None = None,
    element_type: str = "string",
    spread: int | None = None,
) -> DataFrame:
    """Call ``fn(element)`` for every element of a one-column DataFrame or local list.

    Each call returns one row (a dict) or a small frame; the rows come back as one
    DataFrame, not as a list on the driver. ``spread`` sets the number of tasks; a local
    list is spread over as many as the session runs at once.
    """
    if not isinstance(elements, DataFrame):
        elements = spark.createDataFrame([(e,) for e in elements], f"element {element_type}")
        spread = spread or spark.sparkContext.defaultParallelism
    if len(elements.columns) != 1:
        raise ValueError("elements need exactly one column")
    if spread:
        elements = elements.repartition(spread)
    declared = to_arrow_schema(as_schema(schema))

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [fn(e) for e in batch.column(0).to_pylist()]
            # Rows in a row become one frame; frames stay as they are.
            runs = itertools.groupby(results, key=lambda r: isinstance(r, Frame))
            frames = [frame for whole, run in runs for frame in (run if whole else [Frame(list(run))])]
            if frames:
                yield from conform(pd.concat(frames, ignore_index=True), declared).to_batches()

    return elements.mapInArrow(call, as_schema(schema))


def infer_output_schema(fn: Callable[[Frame], Frame], df: DataFrame, n: int = 1000) -> T.StructType:
    """The schema ``fn`` returns on a sample of n rows. Declaring it is cheaper and safer."""
    sample = to_frame(df.limit(n).toArrow())
    return from_arrow_schema(pa.Schema.from_pandas(fn(sample), preserve_index=False))


def apply_with_context(
    df: DataFrame,
    fn: Callable[[Frame, Any], Frame],
    context: Any,
    schema: T.StructType | str,
    *,
    modules: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``apply_partitions`` with a context object sent to each executor once.

    The context is a small value of the caller's own; look up a table by a join instead.
    ``modules`` are Python files that travel with the job.
    """
    context_on_executor = df.sparkSession.sparkContext.broadcast(context)
    for module in modules:
        df.sparkSession.sparkContext.addPyFile(module)
    return apply_partitions(df, lambda frame: fn(frame, context_on_executor.value), schema, columns=columns)
