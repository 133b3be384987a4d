"""Queries on dates, casts, text, random numbers and jitter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.functions.dates import add_date_parts, as_date
from windrow.functions.jitter import jitter_keyed as add_jitter
from windrow.functions.numbers import key_fraction, to_number
from windrow.plans.inputs import FLIGHTS_SQL, LOANS_SQL, flights, flights_file, fraction_sql, load, loans_by_state, view_name
from windrow.plans.registry import query
from windrow.sources import readers


@query(
    "mutate_date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(quarter(ts) AS INTEGER) AS q, CAST(month(ts) AS INTEGER) AS m,
    CAST(week(ts) AS INTEGER) AS w, CAST(day(ts) AS INTEGER) AS d, CAST(hour(ts) AS INTEGER) AS h,
    strftime(ts, '%Y-%m-%d') AS day_text, CAST(day(ts) AS INTEGER) AS day_of_date FROM events""",
)
def mutate_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns added one after the other; the date as text and as a date."""
    names = {"y": "year", "q": "quarter", "m": "month", "w": "week", "d": "day", "h": "hour"}
    parts = add_date_parts(load(spark, sf_dir, "events"), F.col("ts"), "stamp", "day_text", names)
    parts = parts.withColumn("day_of_date", F.dayofmonth(as_date(F.col("stamp"))))
    return parts.select("event_id", *names, "day_text", "day_of_date")


@query(
    "sql_date_parts",
    """SELECT event_id, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year,
    strftime(ts, '%Y-%m-%d') AS "current_date", CAST(day(ts) AS INTEGER) AS day_of_month FROM events""",
)
def sql_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in one SQL text over a table."""
    view = view_name("events")
    readers.register(load(spark, sf_dir, "events"), view)
    result = spark.sql(
        f"""SELECT event_id, month(ts) AS month, year(ts) AS year, date_format(ts, 'yyyy-MM-dd') AS `current_date`,
        dayofmonth(to_date(ts)) AS day_of_month FROM {view}"""
    )
    spark.catalog.dropTempView(view)
    return result


@query(
    "now_consistency",
    "SELECT COUNT(*) AS n_rows, CAST(1 AS BIGINT) AS n_clocks, true AS parts_agree, true AS date_agrees FROM orders",
)
def now_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clock stands still within one query and its parts agree."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    now = add_date_parts(orders, F.current_timestamp(), "stamp", "today", {"y": "year", "m": "month", "d": "day"})
    today = F.current_date()
    return now.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("stamp").alias("n_clocks"),
        F.bool_and(
            (F.col("m") == F.month(today)) & (F.col("y") == F.year(today)) & (F.col("d") == F.dayofmonth(today))
        ).alias("parts_agree"),
        F.bool_and(F.col("today") == today.cast("string")).alias("date_agrees"),
    )


U_LOANS = fraction_sql(10, "addr_state")


@query(
    "derived_amounts",
    f"""SELECT addr_state, CAST(trunc({U_LOANS} * "count") AS BIGINT) AS "count",
    {U_LOANS} * 10000 * "count" AS amount FROM ({LOANS_SQL})""",
)
def derived_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled counts: one as a whole number, cut off, one as a double."""
    return scaled_loans(loans_by_state(spark, sf_dir))


def scaled_loans(loans: DataFrame) -> DataFrame:
    share = key_fraction(10, F.col("addr_state"))
    return loans.select(
        "addr_state",
        (share * F.col("count")).cast("bigint").alias("count"),
        (share * 10000 * F.col("count")).cast("double").alias("amount"),
    )


@query(
    "to_number",
    f"""SELECT "UniqueCarrier", COUNT(*) AS n, COUNT("DepDelay") AS n_numbers,
    CAST(SUM("DepDelay") AS DOUBLE) AS delay FROM ({FLIGHTS_SQL}) GROUP BY 1""",
)
def to_number_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to number, missing where it is none."""
    delays = flights_file(spark, sf_dir).select("UniqueCarrier", to_number(F.col("DepDelay")).alias("delay"))
    return delays.groupBy("UniqueCarrier").agg(
        F.count(F.lit(1)).alias("n"), F.count("delay").alias("n_numbers"), F.sum("delay").alias("delay")
    )


@query(
    "rand_shared_seed",
    "SELECT COUNT(*) AS n_rows, COUNT(*) AS n_equal, COUNT(*) AS n_in_range, true AS varies FROM orders",
)
def rand_shared_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two draws with one seed are equal in every row."""
    view = view_name("orders")
    readers.register(load(spark, sf_dir, "orders"), view)
    draws = spark.sql(f"SELECT rand(10) AS a, rand(10) AS b FROM {view}")
    spark.catalog.dropTempView(view)
    return draws.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("a") == F.col("b")).alias("n_equal"),
        F.count_if((F.col("a") >= 0) & (F.col("a") < 1)).alias("n_in_range"),
        (F.min("a") < F.max("a")).alias("varies"),
    )


JITTER_SQL = f"""
WITH delays AS (
    SELECT "Origin", "FlightNum", "Leg", "Dest", "DepDelay", "Distance" FROM ({FLIGHTS_SQL}) WHERE "DepDelay" IS NOT NULL
), spread AS (
    SELECT "Origin", COALESCE(NULLIF(MAX("DepDelay") - MIN("DepDelay"), 0), NULLIF(ABS(MIN("DepDelay")), 0), 1) AS z
    FROM delays GROUP BY 1
), rounded AS (
    SELECT DISTINCT d."Origin", z,
        round("DepDelay" * pow(10.0, 3 - floor(log10(z)))) / pow(10.0, 3 - floor(log10(z))) AS x
    FROM delays d JOIN spread s ON d."Origin" = s."Origin"
), gaps AS (
    SELECT "Origin", z, x, x - lag(x) OVER (PARTITION BY "Origin" ORDER BY x) AS gap FROM rounded
), widths AS (
    SELECT "Origin", COALESCE(MIN(gap) / 5, ABS(NULLIF(MIN(x), 0)) / 50, MIN(z) / 50.0) AS width FROM gaps GROUP BY 1
)
SELECT d."Origin", "FlightNum", "Leg", "Dest", "DepDelay",
    round("DepDelay" + (CAST(concat('0x', substr(md5('10|' || "FlightNum" || '|' || "Leg" || '|' || "Dest"), 1, 8)) AS BIGINT)
        / 4294967296.0 * 2 - 1) * width, 9) AS jittered
FROM delays d JOIN widths w ON d."Origin" = w."Origin"
"""


@query("jitter_keyed", JITTER_SQL)
def jitter_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noise around each delay that depends on the row's key, wide as its origin asks."""
    delays = flights(spark, sf_dir).filter(F.col("DepDelay").isNotNull())
    rows = delays.select("Origin", "FlightNum", "Leg", "Dest", "DepDelay")
    key = [F.col("FlightNum"), F.col("Leg"), F.col("Dest")]
    return add_jitter(rows, "Origin", "DepDelay", key, 10).withColumn("jittered", F.round("jittered", 9))
