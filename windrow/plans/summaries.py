"""Queries that choose, count, sum, sort and pivot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.functions.numbers import to_number
from windrow.operators import sampling, shaping, summaries
from windrow.operators.summaries import count_by, count_by_desc, exact_sum
from windrow.plans.inputs import FLIGHTS_SQL, LOANS_SQL, flights, flights_file, fraction_sql, load, loans_by_state, view_name
from windrow.plans.registry import query
from windrow.sources import readers


@query("group_count_desc", "SELECT source, COUNT(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source")
def group_count_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_desc(load(spark, sf_dir, "documents"), "source")


@query("sql_group_count", "SELECT source, COUNT(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source")
def sql_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through SQL text over a registered view."""
    view = view_name("documents")
    readers.register(load(spark, sf_dir, "documents"), view)
    result = spark.sql(f"SELECT source, COUNT(*) AS n FROM {view} GROUP BY source ORDER BY n DESC, source")
    spark.catalog.dropTempView(view)
    return result


@query("loan_by_state", LOANS_SQL)
def loan_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loans_by_state(spark, sf_dir)


@query("count_by_month", 'SELECT CAST(month(o_orderdate) AS INTEGER) AS month, COUNT(*) AS "count" FROM orders GROUP BY 1')
def count_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(load(spark, sf_dir, "orders"), F.month("o_orderdate").alias("month"), name="count")


@query(
    "agg_by_name",
    f'SELECT addr_state, CAST(SUM("count") AS BIGINT) AS loans FROM ({LOANS_SQL} UNION ALL '
    "SELECT CAST(s_nationkey AS VARCHAR), COUNT(*) FROM supplier GROUP BY 1) GROUP BY addr_state",
)
def agg_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates given as column and function name."""
    suppliers = load(spark, sf_dir, "supplier")
    more = count_by(suppliers, F.col("s_nationkey").cast("string").alias("addr_state"), name="count")
    both = loans_by_state(spark, sf_dir).unionByName(more)
    return summaries.agg_by_name(both, ["addr_state"], {"count": "sum"}, {"count": "loans"})


@query(
    "distance_by_carrier_day",
    f"""SELECT *, distance_total / 1000000 AS distance_millions FROM (
    SELECT "UniqueCarrier", "DayOfWeek", CAST(SUM(CAST("Distance" AS DECIMAL(18,2))) AS DOUBLE) AS distance_total
    FROM ({FLIGHTS_SQL}) GROUP BY 1, 2)""",
)
def distance_by_carrier_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = flights(spark, sf_dir).groupBy("UniqueCarrier", "DayOfWeek").agg(exact_sum("Distance").alias("distance_total"))
    return totals.withColumn("distance_millions", F.col("distance_total") / 1e6)


@query(
    "chart_counts",
    f'SELECT "UniqueCarrier", "DayOfWeek", COUNT("DepDelay") AS delays FROM ({FLIGHTS_SQL}) GROUP BY 1, 2',
)
def chart_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts behind a grouped bar chart; nulls are not counted."""
    return flights(spark, sf_dir).groupBy("UniqueCarrier", "DayOfWeek").agg(F.count("DepDelay").alias("delays"))


# Return flag and line status of line items.
CARRIERS = ("AF", "AO", "NF", "NO", "RF", "RO")


@query(
    "pivot_count",
    'SELECT "DepDelay", '
    + ", ".join(f"NULLIF(COUNT(*) FILTER (\"UniqueCarrier\" = '{c}'), 0) AS \"{c}\"" for c in CARRIERS)
    + f' FROM ({FLIGHTS_SQL}) GROUP BY "DepDelay"',
)
def pivot_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delays by carriers, which are known; empty cells are null."""
    return summaries.pivot_count(flights(spark, sf_dir), "DepDelay", "UniqueCarrier", CARRIERS)


@query("carrier_newcol", f"SELECT \"UniqueCarrier\", \"UniqueCarrier\" || '_new' AS newcol FROM ({FLIGHTS_SQL}) GROUP BY 1")
def carrier_newcol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values with a suffix: the native form of the function per group."""
    carriers = flights(spark, sf_dir).select("UniqueCarrier").distinct()
    return carriers.withColumn("newcol", F.concat("UniqueCarrier", F.lit("_new")))


@query(
    "top10_sum",
    "SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders "
    "GROUP BY o_custkey ORDER BY amount DESC, o_custkey LIMIT 10",
)
def top10_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("amount"))
    return shaping.top_n(sums, 10, ["amount"], ["o_custkey"])


@query(
    "arrange_asc",
    "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer ORDER BY 2 NULLS FIRST, 1",
)
def arrange_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    balances = load(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance")
    )
    return shaping.ascending(balances, "balance", "c_custkey")


TOP_SQL = """SELECT "UniqueCarrier", {delay} AS "DepDelay", CAST("Origin" AS VARCHAR) AS "Origin"
    FROM ({flights}) WHERE "DepDelay" IS NOT NULL
    ORDER BY {delay} DESC, "UniqueCarrier", CAST("Origin" AS VARCHAR) LIMIT 10"""


@query("top10_delays", TOP_SQL.format(delay='CAST("DepDelay" AS VARCHAR)', flights=FLIGHTS_SQL))
def top10_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top ten in text order, as a column with NA in it gives: "9" is above "50"."""
    airlines = flights_file(spark, sf_dir)
    kept = airlines.filter(shaping.differs_from(F.col("DepDelay"), "NA"))
    return shaping.top_n(kept.select("UniqueCarrier", "DepDelay", "Origin"), 10, ["DepDelay"], ["UniqueCarrier", "Origin"])


@query("top10_delays_numeric", TOP_SQL.format(delay='"DepDelay"', flights=FLIGHTS_SQL))
def top10_delays_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by number."""
    delays = flights_file(spark, sf_dir).select(
        "UniqueCarrier", to_number(F.col("DepDelay"), "int").alias("DepDelay"), "Origin"
    )
    return shaping.top_n(delays.filter(F.col("DepDelay").isNotNull()), 10, ["DepDelay"], ["UniqueCarrier", "Origin"])


@query("select_columns", "SELECT p_size AS age, p_type AS workclass FROM part")
def select_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    return part.select(part.p_size.alias("age"), F.col("p_type").alias("workclass"))


@query(
    "filter_month",
    f'SELECT "UniqueCarrier", "FlightNum", "DayofMonth" FROM ({FLIGHTS_SQL}) WHERE "Month" = 12',
)
def filter_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights(spark, sf_dir).filter(F.col("Month") == 12).select("UniqueCarrier", "FlightNum", "DayofMonth")


@query(
    "filter_conjunction",
    f'SELECT "UniqueCarrier", "Origin", "ArrDelay" FROM ({FLIGHTS_SQL}) WHERE "Month" = 12 AND "DayofMonth" = 24',
)
def filter_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two conditions; column names do not mind their case."""
    eve = flights(spark, sf_dir).filter((F.col("Month") == 12) & (F.col("DayOfMonth") == 24))
    return eve.select("UniqueCarrier", "Origin", "ArrDelay")


@query("filter_not_null", f'SELECT "DepDelay" FROM ({FLIGHTS_SQL}) WHERE "DepDelay" IS NOT NULL')
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    delays = flights(spark, sf_dir).select("DepDelay")
    return delays.filter(F.col("DepDelay").isNotNull())


@query(
    "drop_any_null",
    f"""SELECT "Origin", "DepDelay", price AS "ArrDelay" FROM (
    SELECT "Origin", "DepDelay", CASE WHEN "ArrDelay" >= 20000 THEN "ArrDelay" END AS price FROM ({FLIGHTS_SQL}))
    WHERE "DepDelay" IS NOT NULL AND price IS NOT NULL""",
)
def drop_any_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    delays = flights(spark, sf_dir).withColumn("ArrDelay", F.when(F.col("ArrDelay") >= 20000, F.col("ArrDelay")))
    return shaping.complete_cases(delays, "Origin", "DepDelay", "ArrDelay")


@query("head_n", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey, o_custkey LIMIT 6")
def head_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first six rows."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return shaping.first_rows(orders, ["o_orderkey", "o_custkey"])


@query(
    "random_split",
    "SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_in_both, true AS both_used FROM orders",
)
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 2 : 98 random split is disjoint and complete."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    small, large = sampling.random_split(orders, [0.02, 0.98], 206)
    sides = small.withColumn("small", F.lit(1)).unionByName(large.withColumn("small", F.lit(0)))
    per_key = sides.groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("small").alias("n_small"),
    )
    return per_key.agg(
        F.sum("n").alias("n_rows"),
        F.count_if(F.col("n") > 1).alias("n_in_both"),
        ((F.sum("n_small") > 0) & (F.sum("n_small") < F.sum("n"))).alias("both_used"),
    )


@query(
    "hash_split",
    f"SELECT c_custkey, c_nationkey, {fraction_sql(206, 'c_custkey')} < 0.02 AS in_small FROM customer",
)
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cut by key: every run and layout gives the same rows."""
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    small, large = sampling.hash_split(customers, [0.02, 0.98], [F.col("c_custkey")], 206)
    return small.withColumn("in_small", F.lit(True)).unionByName(large.withColumn("in_small", F.lit(False)))


@query(
    "stratified_sample",
    f"""SELECT o_orderkey, o_orderstatus FROM (SELECT *, {fraction_sql(7, 'o_orderkey')} AS u FROM orders)
    WHERE (o_orderstatus = 'F' AND u < 0.1) OR (o_orderstatus = 'O' AND u < 0.05) OR (o_orderstatus = 'P' AND u < 0.5)""",
)
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.stratified_sample(orders, "o_orderstatus", {"F": 0.1, "O": 0.05, "P": 0.5}, [F.col("o_orderkey")], 7)


@query(
    "sample_per_stratum",
    f"""SELECT o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER (
        PARTITION BY o_orderpriority ORDER BY {fraction_sql(11, 'o_orderkey')}, o_orderkey) <= 25""",
)
def sample_per_stratum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty-five orders of each priority, e.g. ahead of a plot."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.sample_per_stratum(orders, "o_orderpriority", 25, [F.col("o_orderkey")], 11)


@query("param_projection", "SELECT l_extendedprice AS x, l_discount AS y FROM lineitem")
def param_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two user-chosen columns, passed as parameters of the SQL text."""
    view = view_name("cars")
    readers.register(load(spark, sf_dir, "lineitem"), view)
    result = readers.choose_columns(spark, view, x="l_extendedprice", y="l_discount")
    spark.catalog.dropTempView(view)
    return result
