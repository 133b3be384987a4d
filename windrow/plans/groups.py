"""Queries that run Python functions over groups, partitions and elements."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.functions.jitter import jitter_width, jitter_widths
from windrow.operators import groups
from windrow.operators.summaries import exact_sum
from windrow.plans.inputs import FLIGHTS_SQL, flights, load
from windrow.plans.registry import query
from windrow.sources.readers import sequence_ids

CARRIER_SQL = f"SELECT \"UniqueCarrier\", \"UniqueCarrier\" || '_new' AS newcol FROM ({FLIGHTS_SQL}) {{where}} GROUP BY 1"


def carriers_of(flights_frame: DataFrame) -> DataFrame:
    """Each carrier once: the function looks at distinct names only, so it needs no more,
    and a carrier with much of the table does not meet in one task."""
    return flights_frame.select("UniqueCarrier").distinct()


@query("carrier_newcol_udf", CARRIER_SQL.format(where=""))
def carrier_newcol_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function per group with a declared schema."""

    def rename(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        names = rows["UniqueCarrier"].unique()
        return pd.DataFrame({"UniqueCarrier": names, "newcol": [f"{n}_new" for n in names]})

    return groups.apply_groups(
        carriers_of(flights(spark, sf_dir)),
        ["UniqueCarrier"],
        rename,
        "UniqueCarrier string, newcol string",
    )


@query("carrier_newcol_prepend", CARRIER_SQL.format(where='WHERE "Month" = 12 AND "DayofMonth" = 24'))
def carrier_newcol_prepend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The function returns its own column only; the key is put in front."""
    eve = flights(spark, sf_dir).filter((F.col("Month") == 12) & (F.col("DayofMonth") == 24))

    def rename(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"newcol": [f"{n}_new" for n in rows["UniqueCarrier"].unique()]})

    return groups.apply_groups(
        carriers_of(eve),
        ["UniqueCarrier"],
        rename,
        "UniqueCarrier string, newcol string",
        prepend_key=True,
    )


def task_random() -> np.random.Generator:
    """Random numbers fixed by the partition, so that a task run again draws the same."""
    return np.random.default_rng([206, TaskContext.get().partitionId()])


@query(
    "jitter_partition",
    f"""SELECT COUNT(*) AS n_rows, CAST(SUM("DepDelay") AS BIGINT) AS delay, CAST(0 AS BIGINT) AS n_outside,
    true AS moved FROM ({FLIGHTS_SQL}) WHERE "DepDelay" IS NOT NULL""",
)
def jitter_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noise per partition, wide as the partition's values ask; any layout keeps the bounds."""
    delays = flights(spark, sf_dir).select("DepDelay").filter(F.col("DepDelay").isNotNull())

    def jitter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        random = task_random()
        for rows in frames:
            x, width = rows["DepDelay"].to_numpy(float), rows["width"].to_numpy(float)
            yield pd.DataFrame({"DepDelay": rows["DepDelay"], "jitteredDelay": x + random.uniform(-width, width), "width": width})

    # First the width of each partition, then the noise of its rows.
    jittered = groups.apply_partitions_twice(
        delays, lambda rows, part: jitter_widths(rows, part, "DepDelay"), jitter, "DepDelay int, jitteredDelay double, width double"
    )
    distance = F.abs(F.col("jitteredDelay") - F.col("DepDelay"))
    return jittered.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("DepDelay").alias("delay"),
        F.count_if(distance > F.col("width") + 1e-9).alias("n_outside"),
        (F.max(distance) > 0).alias("moved"),
    )


@query(
    "first_per_partition",
    "SELECT COUNT(*) AS n_rows, true AS one_each, true AS is_first, true AS within_bounds FROM orders",
)
def first_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per partition, its first: as many results as partitions hold rows."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    rows = orders.sortWithinPartitions("o_orderkey").withColumn("part", F.spark_partition_id())

    def first(frame: pd.DataFrame) -> pd.DataFrame:
        head = frame.head(1)
        x = head["o_orderkey"].to_numpy(float)
        width = jitter_width(x)
        moved = x + task_random().uniform(-width, width, 1)
        return head.assign(jittered=moved, width=width)

    firsts = groups.apply_partitions(
        rows, first, "o_orderkey long, part int, jittered double, width double", first=True
    ).withColumn("n", F.lit(0))
    counted = orders.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("low"))
    both = firsts.unionByName(counted, allowMissingColumns=True)
    per_part = both.groupBy("part").agg(
        F.sum("n").alias("n"),
        F.count("o_orderkey").alias("n_firsts"),
        (F.max("o_orderkey") == F.max("low")).alias("is_first"),
        (F.abs(F.max("jittered") - F.max("o_orderkey")) <= F.max("width") + 1e-9).alias("bounded"),
    )
    return per_part.agg(
        F.sum("n").alias("n_rows"),
        F.bool_and(F.col("n_firsts") == 1).alias("one_each"),
        F.bool_and("is_first").alias("is_first"),
        F.bool_and("bounded").alias("within_bounds"),
    )


@query(
    "udf_partition_half",
    """SELECT 'ids' AS series, COUNT(*) AS n, SUM(CAST(i AS DOUBLE) / 2) AS half
    FROM (SELECT row_number() OVER () AS i FROM orders)
    UNION ALL SELECT 'keys', COUNT(*), SUM(CAST(l_orderkey AS DOUBLE) / 2) FROM lineitem""",
)
def udf_partition_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x / 2 by a function per partition, over as many ids as there are orders, and over order keys."""
    ids = sequence_ids(spark, load(spark, sf_dir, "orders").count())
    keys = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    results = [half_summary(frame).withColumn("series", F.lit(name)) for name, frame in (("ids", ids), ("keys", keys))]
    return results[0].unionByName(results[1])


def half(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"id": rows["id"].to_numpy(float) / 2})


def half_summary(frame: DataFrame) -> DataFrame:
    halves = groups.apply_partitions(frame, half, "id double")
    return halves.agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("half"))


@query("map_elements", "SELECT s_name AS carrier, s_name || '_new' AS newcol FROM supplier GROUP BY s_name")
def map_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function per element; the small results come back as one DataFrame."""
    names = load(spark, sf_dir, "supplier").select("s_name").distinct()
    return groups.map_elements(
        names, lambda e: {"carrier": e, "newcol": f"{e}_new"}, "carrier string, newcol string"
    )


@query(
    "infer_udf_schema",
    "SELECT COUNT(*) AS n, SUM(l_quantity / 2) AS half, 'bigint' AS key_type, 'double' AS half_type FROM lineitem",
)
def infer_udf_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The output schema found on a sample of rows, then used for the whole table."""
    items = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")

    def halve(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": rows["l_orderkey"], "half": rows["l_quantity"] / 2})

    schema = groups.infer_output_schema(halve, items)
    return groups.apply_partitions(items, halve, schema).agg(
        F.count("key").alias("n"),
        F.sum("half").alias("half"),
        F.first(F.typeof("key")).alias("key_type"),
        F.first(F.typeof("half")).alias("half_type"),
    )


# The statuses of orders and what the query calls them.
STATUSES = {"F": "finished", "O": "open", "P": "in part"}


@query(
    "udf_with_context",
    "SELECT CASE o_orderstatus "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUSES.items())
    + " END AS status, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1",
)
def udf_with_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names from a small value that travels with the function."""

    def look_up(rows: pd.DataFrame, context: dict) -> pd.DataFrame:
        return pd.DataFrame({"status": rows["o_orderstatus"].map(context), "price": rows["o_totalprice"]})

    orders = load(spark, sf_dir, "orders")
    named = groups.apply_with_context(
        orders, look_up, STATUSES, "status string, price double", columns=["o_orderstatus", "o_totalprice"]
    )
    return named.groupBy("status").agg(F.count(F.lit(1)).alias("n"), exact_sum("price").alias("total"))


SUPPLIER_LINES_SQL = """SELECT l_suppkey, COUNT(*) AS n_lines, CAST(SUM(l_quantity) AS DOUBLE) AS quantity,
    MAX(l_extendedprice) AS dearest, arg_min(l_partkey, l_orderkey * 100 + l_linenumber) AS first_part
    FROM lineitem GROUP BY l_suppkey"""


def supplier_summary(frames: Iterator[pd.DataFrame]) -> dict[str, list]:
    """What the lines of one supplier come to, batch by batch: a supplier may have any number of them."""
    n, quantity, dearest, first = 0, 0.0, None, None
    for rows in frames:
        n += len(rows)
        quantity += rows["l_quantity"].sum()
        top = rows["l_extendedprice"].max()
        dearest = top if dearest is None else max(dearest, top)
        order, line, part = rows.sort_values(["l_orderkey", "l_linenumber"]).iloc[0][["l_orderkey", "l_linenumber", "l_partkey"]]
        first = min(filter(None, (first, (int(order), int(line), int(part)))))
    return {"n_lines": [n], "quantity": [quantity], "dearest": [dearest], "first_part": [first[2]]}


SUPPLIER_COLUMNS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_partkey"]
SUPPLIER_SCHEMA = "l_suppkey long, n_lines long, quantity double, dearest double, first_part long"


@query("supplier_lines_udf", SUPPLIER_LINES_SQL)
def supplier_lines_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function over all lines of each supplier, which stream through it."""
    items = load(spark, sf_dir, "lineitem")

    def summary(key: tuple, frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
        return pd.DataFrame({"l_suppkey": [key[0]], **supplier_summary(frames)})

    return groups.apply_groups(items, ["l_suppkey"], summary, SUPPLIER_SCHEMA, columns=SUPPLIER_COLUMNS, batches=True)


@query("supplier_lines_prepend", SUPPLIER_LINES_SQL)
def supplier_lines_prepend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, the function returning its own columns only."""
    items = load(spark, sf_dir, "lineitem")

    def summary(key: tuple, frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
        return pd.DataFrame(supplier_summary(frames))

    return groups.apply_groups(
        items, ["l_suppkey"], summary, SUPPLIER_SCHEMA, columns=SUPPLIER_COLUMNS, prepend_key=True, batches=True
    )


@query(
    "supplier_running_quantity",
    """SELECT l_suppkey, l_orderkey, l_linenumber,
        CAST(SUM(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity
            ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM lineitem""",
)
def supplier_running_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function that gives a row for every row: each supplier's quantity so far, its lines in order."""
    items = load(spark, sf_dir, "lineitem")

    def running(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        so_far = 0.0
        for rows in frames:
            total = so_far + rows["l_quantity"].cumsum()
            so_far = float(total.iloc[-1])
            yield rows[["l_orderkey", "l_linenumber"]].assign(running=total)

    return groups.apply_groups(
        items,
        ["l_suppkey"],
        running,
        "l_suppkey long, l_orderkey long, l_linenumber int, running double",
        columns=["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"],
        prepend_key=True,
        batches=True,
        order=["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"],
    )


@F.pandas_udf(T.DoubleType())
def half_by_batch(x: pd.Series) -> pd.Series:
    return x / 2


@F.udf(T.DoubleType(), useArrow=False)
def half_by_row(x):
    return x / 2


@query(
    "udf_variants_agree",
    "SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_different, SUM(l_quantity / 2) AS half FROM lineitem",
)
def udf_variants_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Native column, batch function and row function give the same halves."""
    halves = load(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") / 2).alias("native"),
        half_by_batch("l_quantity").alias("batch"),
        half_by_row("l_quantity").alias("row"),
    )
    differ = (F.col("native") != F.col("batch")) | (F.col("native") != F.col("row"))
    return halves.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(differ).alias("n_different"), F.sum("native").alias("half")
    )
