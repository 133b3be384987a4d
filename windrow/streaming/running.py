"""Running aggregates over streams, and streams written down batch by batch.

Results go to files through ``foreachBatch``, each batch into the folder of its number:
a batch that is run again after a failure replaces itself, and nothing is gathered on
the driver. State is bounded by the number of keys; a cluster with many of them sets
the RocksDB state store for its session.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from windrow.streaming.folders import names_in, remove_folder


def running_sum(stream: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Sum of a column per key over all rows so far."""
    return stream.groupBy(key).agg(F.sum(value).alias(name))


def run_available(
    df: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None], mode: str, timeout: int | None = None
) -> None:
    """Process what is there, then stop. The checkpoint lets the next run go on from here."""
    query = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(each_batch)
        .start()
    )
    try:
        if not query.awaitTermination(timeout) and timeout is not None:
            raise TimeoutError(f"the stream did not finish in {timeout} s")
    finally:
        query.stop()


def start_running(
    df: DataFrame, path: str, checkpoint: str, interval: str = "10 seconds", mode: str = "complete"
) -> StreamingQuery:
    """Keep results up to date while rows arrive, until the caller stops the query returned."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(processingTime=interval)
    return writer.foreachBatch(_into(path, 2 if mode == "complete" else None)).start()


def _number(name: str) -> int:
    return int(name.removeprefix("batch="))


def _into(path: str, kept: int | None) -> Callable[[DataFrame, int], None]:
    """Writes each batch into the folder of its number; of complete results, only the last are kept."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if kept:
            spark = batch.sparkSession
            for name in names_in(spark, path):
                if name.startswith("batch=") and _number(name) <= number - kept:
                    remove_folder(spark, f"{path}/{name}")

    return write


def refresh_result(df: DataFrame, path: str, checkpoint: str, timeout: int | None = None) -> DataFrame:
    """Bring a running aggregate up to date and return its complete result.

    What this returned before stays readable until the next call; older results are removed.
    """
    spark = df.sparkSession
    had = [name for name in names_in(spark, path) if name.startswith("batch=")]
    run_available(df, checkpoint, _into(path, None), "complete", timeout)
    names = sorted((n for n in names_in(spark, path) if n.startswith("batch=")), key=_number)
    before = max(had, key=_number, default=None)
    for name in names[:-1]:
        if name != before:
            remove_folder(spark, f"{path}/{name}")
    return latest_result(df, path)


def latest_result(df: DataFrame, path: str) -> DataFrame:
    """The result of the last batch written; no rows where there is none."""
    names = [name for name in names_in(df.sparkSession, path) if name.startswith("batch=")]
    if not names:
        return df.sparkSession.createDataFrame([], df.schema)
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{max(names, key=_number)}")


def _batches(spark: SparkSession, path: str, kind: str = "batch") -> list[int]:
    return sorted(int(name.split("=")[1]) for name in names_in(spark, path) if name.startswith(f"{kind}="))


def refresh_keyed(
    df: DataFrame, keys: Sequence[str], path: str, checkpoint: str, timeout: int | None = None, fold_after: int = 50
) -> DataFrame:
    """Bring a running aggregate up to date, writing only the keys that new rows touched.

    Every batch adds its changed keys under its number (update mode); the result takes the last
    row of each key, by one aggregation. When more than ``fold_after`` batches lie there, they are
    folded into one state, so that reading does not grow with the age of the stream. What
    this returned before stays readable until the next call.
    """
    if {"batch", "state"} & set(df.columns):
        raise ValueError("columns named batch or state are in the way of the result's folders")
    spark = df.sparkSession
    states = [n for n in _batches(spark, path, "state") if "_SUCCESS" in names_in(spark, f"{path}/state={n}")]
    for kind, upto in (("batch", states[-1] if states else -1), ("state", states[-1] - 1 if states else -1)):
        for number in _batches(spark, path, kind):
            if number <= upto:
                remove_folder(spark, f"{path}/{kind}={number}")
    run_available(df, checkpoint, _into(path, None), "update", timeout)
    numbers = _batches(spark, path)
    if len(numbers) > fold_after:
        # Without its _SUCCESS file, a state that was broken off is not read.
        latest_keyed(df, keys, path).write.mode("overwrite").parquet(f"{path}/state={numbers[-1]}")
    return latest_keyed(df, keys, path)


def latest_keyed(df: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """The last row of every key among the batches written; no rows where there are none."""
    spark = df.sparkSession
    whole = [n for n in _batches(spark, path, "state") if "_SUCCESS" in names_in(spark, f"{path}/state={n}")]
    base = whole[-1] if whole else -1
    rows = spark.createDataFrame([], df.schema).withColumn("batch", F.lit(0))
    if whole:
        rows = spark.read.schema(df.schema).parquet(f"{path}/state={base}").withColumn("batch", F.lit(base))
    later = [f"{path}/batch={n}" for n in _batches(spark, path) if n > base]
    if later:
        schema = T.StructType([*df.schema.fields, T.StructField("batch", T.IntegerType())])
        rows = rows.unionByName(spark.read.schema(schema).option("basePath", path).parquet(*later))
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), "batch").alias("_last"))
    return last.select("_last.*")


def write_stream(df: DataFrame, path: str, checkpoint: str, timeout: int | None = None) -> DataFrame:
    """Write a stream's rows to files, every row once, and return what is written."""

    run_available(df, checkpoint, _into(path, None), "append", timeout)
    schema = df.schema
    return df.sparkSession.read.schema(schema).option("basePath", path).parquet(path).select(*schema.names)
