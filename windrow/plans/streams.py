"""Streaming queries over folders that batches of rows are added to. Each stream ends when it has read what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators.summaries import agg_by_name
from windrow.plans.inputs import load, view_name
from windrow.plans.registry import query
from windrow.session import scratch_dir
from windrow.sources.readers import local_frame
from windrow.streaming.folders import add_batch, read_batches, stream_batches
from windrow.streaming.running import refresh_keyed, refresh_result, running_sum, write_stream


def event_folder(spark: SparkSession, sf_dir: str) -> str:
    """Events in a folder of two batches, every column and the value in whole cents."""
    events = load(spark, sf_dir, "events").withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    buys = F.col("event_type") == "purchase"
    folder = scratch_dir(spark, "events")
    add_batch(events.filter(~buys), folder, "others")
    add_batch(events.filter(buys), folder, "purchases")
    return folder


EVENT_SUMS = "SELECT {key}, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS {name} FROM events GROUP BY {key}"


def summed(spark: SparkSession, stream: DataFrame) -> DataFrame:
    root = scratch_dir(spark, "stream")
    return refresh_result(stream, f"{root}/result", f"{root}/checkpoint")


@query("stream_sum_by_key", EVENT_SUMS.format(key="user_id", name="cents"))
def stream_sum_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running sum per key over the stream of a folder."""
    stream = stream_batches(spark, event_folder(spark, sf_dir))
    return summed(spark, running_sum(stream, "user_id", "cents", "cents"))


@query("stream_keyed_updates", EVENT_SUMS.format(key="user_id", name="cents"))
def stream_keyed_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sums, kept up to date by writing only the users that each batch touches."""
    folder, root = scratch_dir(spark, "events"), scratch_dir(spark, "stream")
    events = load(spark, sf_dir, "events").withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    buys = F.col("event_type") == "purchase"
    add_batch(events.filter(~buys), folder, "others")
    sums = running_sum(stream_batches(spark, folder), "user_id", "cents", "cents")
    refresh_keyed(sums, ["user_id"], f"{root}/result", f"{root}/checkpoint")
    add_batch(events.filter(buys), folder, "purchases")
    return refresh_keyed(sums, ["user_id"], f"{root}/result", f"{root}/checkpoint")


@query("stream_sql_view", EVENT_SUMS.format(key="event_type", name="loans"))
def stream_sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream registered as a view and summed by SQL text."""
    view = view_name("stream")
    stream_batches(spark, event_folder(spark, sf_dir)).createOrReplaceTempView(view)
    sums = spark.sql(f"SELECT event_type, SUM(cents) AS loans FROM {view} GROUP BY event_type")
    spark.catalog.dropTempView(view)
    return summed(spark, sums)


# Six rows of 450 for the state whose stand-in key is 7.
INSERTS, AMOUNT, STATE = 6, 450, "7"


@query(
    "stream_incremental",
    f"""WITH spent AS (SELECT CAST(c_nationkey AS VARCHAR) AS addr_state, COUNT(*) AS loans FROM customer GROUP BY 1)
    SELECT 'before' AS step, addr_state, loans FROM spent UNION ALL
    SELECT 'after', addr_state, loans + CASE WHEN addr_state = '{STATE}' THEN {INSERTS * AMOUNT} ELSE 0 END FROM spent""",
)
def stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six inserts between two runs on one checkpoint: the second run goes on from the first."""
    folder, root = scratch_dir(spark, "loans"), scratch_dir(spark, "stream")
    customers = load(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("addr_state"), F.lit(1).cast("long").alias("count"))
    add_batch(customers, folder, "customers")
    sums = running_sum(stream_batches(spark, folder), "addr_state", "count", "loans")
    before = refresh_result(sums, f"{root}/result", f"{root}/checkpoint").withColumn("step", F.lit("before"))
    for number in range(INSERTS):
        add_batch(local_frame(spark, [(STATE, AMOUNT)], customers.schema), folder, f"insert-{number}")
    after = refresh_result(sums, f"{root}/result", f"{root}/checkpoint").withColumn("step", F.lit("after"))
    return before.unionByName(after)


@query(
    "stream_batch_agree",
    "SELECT COUNT(DISTINCT user_id) AS n_keys, CAST(0 AS BIGINT) AS n_different FROM events",
)
def stream_batch_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's sums are those of a batch read of the same folder."""
    folder = event_folder(spark, sf_dir)
    streamed = summed(spark, running_sum(stream_batches(spark, folder, files_per_batch=2), "user_id", "cents", "cents"))
    batch = agg_by_name(read_batches(spark, folder), ["user_id"], {"cents": "sum"}, {"cents": "cents"})
    sides = streamed.withColumn("sign", F.lit(1)).unionByName(batch.withColumn("sign", F.lit(-1)))
    per_key = sides.groupBy("user_id").agg(
        F.sum(F.col("cents") * F.col("sign")).alias("rest"), F.count(F.lit(1)).alias("n")
    )
    return per_key.agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_if((F.col("rest") != 0) | (F.col("n") != 2)).alias("n_different")
    )


@query("stream_sink", "SELECT event_id, user_id, CAST(ts AS VARCHAR) AS ts, event_type, value, props, CAST(round(value * 100) AS BIGINT) AS cents FROM events")
def stream_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream written to files, every row once."""
    root = scratch_dir(spark, "sink")
    stream = stream_batches(spark, event_folder(spark, sf_dir), files_per_batch=3)
    rows = write_stream(stream, f"{root}/rows", f"{root}/checkpoint")
    return rows.withColumn("ts", F.col("ts").cast("string"))
