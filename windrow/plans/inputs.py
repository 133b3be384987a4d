"""The given tables, and the shapes the queries need made from them.

Flights are line items: the carrier is return flag and line status, the origin the
supplier, delays are quantity and price, the distance the price. Loans by state are
customers by nation, books are documents with their source as author.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.functions.dates import weekday_from_monday

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Field names and types of the flights file, in file order.
FLIGHT_FIELDS = (
    "year int, Month int, DayofMonth int, DayOfWeek int, DepTime int, CRSDepTime int, ArrTime int, "
    "CRSArrTime int, UniqueCarrier string, FlightNum int, TailNum string, ActualElapsedTime int, "
    "CRSElapsedTime int, AirTime int, ArrDelay int, DepDelay int, Origin string, Dest string, "
    "Distance int, TaxiIn int, TaxiOut int, Cancelled int, CancellationCode string, Diverted int, "
    "CarrierDelay string, WeatherDelay string, NASDelay string"
)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def view_name(label: str) -> str:
    """A view or table name no other run uses."""
    return f"windrow_{label}_{uuid.uuid4().hex[:12]}"


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items under the names of the flights data; the third line has no delay."""
    items = load(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate")
    return items.select(
        F.year(day).alias("year"),
        F.month(day).alias("Month"),
        F.dayofmonth(day).alias("DayofMonth"),
        weekday_from_monday(day).alias("DayOfWeek"),
        F.concat("l_returnflag", "l_linestatus").alias("UniqueCarrier"),
        F.col("l_orderkey").alias("FlightNum"),
        F.col("l_linenumber").alias("Leg"),
        F.col("l_suppkey").alias("Origin"),
        F.col("l_partkey").alias("Dest"),
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity").cast("int")).alias("DepDelay"),
        F.col("l_extendedprice").alias("ArrDelay"),
        F.col("l_extendedprice").alias("Distance"),
    )


def flights_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights as text columns for a 27-field file; missing values are NA."""
    rows = flights(spark, sf_dir)
    have = {
        "ArrDelay": F.col("ArrDelay").cast("int"),
        "Distance": F.col("Distance").cast("int"),
        "Cancelled": F.lit(0),
    }
    columns = []
    for item in FLIGHT_FIELDS.split(", "):
        name = item.split()[0]
        value = have.get(name, F.col(name) if name in rows.columns else F.lit(None))
        columns.append(F.coalesce(value.cast("string"), F.lit("NA")).alias(name))
    return rows.select(*columns)


def loans_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer")
    return customers.groupBy(F.col("c_nationkey").cast("string").alias("addr_state")).count()


# The same shapes as SQL, for the answers.
LOANS_SQL = "SELECT CAST(c_nationkey AS VARCHAR) AS addr_state, COUNT(*) AS \"count\" FROM customer GROUP BY 1"

FLIGHTS_SQL = """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS "Month",
           CAST(day(l_shipdate) AS INTEGER) AS "DayofMonth", CAST(isodow(l_shipdate) AS INTEGER) AS "DayOfWeek",
           l_returnflag || l_linestatus AS "UniqueCarrier", l_orderkey AS "FlightNum",
           l_linenumber AS "Leg", l_suppkey AS "Origin", l_partkey AS "Dest",
           CASE WHEN l_linenumber <> 3 THEN CAST(trunc(l_quantity) AS INTEGER) END AS "DepDelay",
           l_extendedprice AS "ArrDelay", l_extendedprice AS "Distance"
    FROM lineitem"""


def fraction_sql(seed: int, key: str) -> str:
    """SQL of ``key_fraction``."""
    return f"(CAST(concat('0x', substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0)"
