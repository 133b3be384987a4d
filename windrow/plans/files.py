"""Queries over file formats: written from the given tables, read back whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators.summaries import exact_sum
from windrow.plans.inputs import FLIGHT_FIELDS, FLIGHTS_SQL, flights_file, load, view_name
from windrow.plans.registry import query
from windrow.session import scratch_dir
from windrow.sources import readers, writers
from windrow.sources.catalog import list_files


@query(
    "read_json",
    "SELECT source, COUNT(*) AS n, CAST(SUM(length(text)) AS BIGINT) AS text_chars, "
    "CAST(SUM(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY source",
)
def read_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines, whole texts, registered under a name and read by format name."""
    path, view = scratch_dir(spark, "json"), view_name("books")
    documents = load(spark, sf_dir, "documents")
    documents.write.json(path)
    readers.read_json(spark, path, view, documents.schema)
    books = spark.table(view)
    spark.catalog.dropTempView(view)
    return books.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("text_chars"), F.sum("n_chars").alias("n_chars")
    )


@query(
    "read_json_inferred",
    "SELECT author, COUNT(*) AS n, MAX(doc_id) AS last_id, 'bigint' AS id_type, CAST(SUM(length(text)) AS BIGINT) AS text_chars, "
    "MAX(lang) AS last_lang, CAST(SUM(n_chars) AS BIGINT) AS n_chars "
    "FROM (SELECT * RENAME (source AS author) FROM documents) GROUP BY author",
)
def read_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines by format name, types found by Spark."""
    path = scratch_dir(spark, "json")
    load(spark, sf_dir, "documents").withColumnRenamed("source", "author").write.json(path)
    books = readers.read_path(spark, path, "json")
    return books.groupBy("author").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("doc_id").alias("last_id"),
        F.first(F.typeof("doc_id")).alias("id_type"),
        F.sum(F.length("text")).alias("text_chars"),
        F.max("lang").alias("last_lang"),
        F.sum("n_chars").alias("n_chars"),
    )


@query(
    "read_csv_inferred",
    f"""SELECT "UniqueCarrier", COUNT(*) AS n, COUNT(*) - COUNT("DepDelay") AS n_missing_text,
    CAST(SUM(trunc("Distance")) AS BIGINT) AS distance, 'string' AS delay_type, 'int' AS distance_type
    FROM ({FLIGHTS_SQL}) GROUP BY 1""",
)
def read_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header and inferred types: the column that holds NA becomes text."""
    path, view = scratch_dir(spark, "csv"), view_name("airlines")
    writers.write_csv(flights_file(spark, sf_dir), path)
    readers.read_csv(spark, path, view, infer=True)
    airlines = spark.table(view)
    spark.catalog.dropTempView(view)
    return airlines.groupBy("UniqueCarrier").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("DepDelay") == "NA").alias("n_missing_text"),
        F.sum("Distance").alias("distance"),
        F.first(F.typeof("DepDelay")).alias("delay_type"),
        F.first(F.typeof("Distance")).alias("distance_type"),
    )


@query(
    "read_csv_schema",
    f"""SELECT "UniqueCarrier", "Month", COUNT(*) AS n, COUNT("DepDelay") AS n_delays,
    CAST(SUM("DepDelay") AS BIGINT) AS delay, CAST(SUM(trunc("Distance")) AS BIGINT) AS distance,
    CAST(0 AS BIGINT) AS n_tail_numbers FROM ({FLIGHTS_SQL}) GROUP BY 1, 2""",
)
def read_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed 27-field schema, NA read as null."""
    path = scratch_dir(spark, "csv")
    writers.write_csv(flights_file(spark, sf_dir), path)
    airlines = readers.read_csv(spark, path, schema=FLIGHT_FIELDS, missing="NA")
    return airlines.groupBy("UniqueCarrier", "Month").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("DepDelay").alias("n_delays"),
        F.sum("DepDelay").alias("delay"),
        F.sum("Distance").alias("distance"),
        F.count("TailNum").alias("n_tail_numbers"),
    )


@query(
    "read_csv_raw",
    "SELECT CAST(c_nationkey AS VARCHAR) AS nation, COUNT(*) AS n, MAX(c_name) AS last_name, MAX(c_mktsegment) AS last_segment, "
    "CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance, MAX(CAST(c_custkey AS VARCHAR)) AS last_key "
    "FROM customer GROUP BY 1",
)
def read_csv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No options: every column is text with a name from its position."""
    path = scratch_dir(spark, "csv")
    order = ["c_custkey", "c_nationkey", "c_name", "c_mktsegment", "c_acctbal"]
    writers.write_csv(load(spark, sf_dir, "customer").select(order), path, header=False)
    return readers.read_csv_raw(spark, path).groupBy(F.col("_c1").alias("nation")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max("_c2").alias("last_name"),
        F.max("_c3").alias("last_segment"),
        exact_sum("_c4").alias("balance"),
        F.max("_c0").alias("last_key"),
    )


@query("read_parquet", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def read_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By path with the session's default format."""
    return readers.read_path(spark, f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@query(
    "read_orc",
    "SELECT o_orderpriority, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total "
    "FROM orders GROUP BY o_orderpriority",
)
def read_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "orc")
    load(spark, sf_dir, "orders").write.orc(path)
    return readers.read_orc(spark, path).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("total")
    )


@query(
    "read_delimited",
    "SELECT sep, p_brand, COUNT(*) AS n, CAST(SUM(p_size) AS BIGINT) AS sizes, MAX(p_type) AS last_type, "
    "MAX(p_name) AS last_name, CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS prices, MAX(p_partkey) AS last_key "
    "FROM part, (VALUES ('tab'), ('pipe')) AS s(sep) GROUP BY sep, p_brand",
)
def read_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab- and pipe-separated text."""
    parts = load(spark, sf_dir, "part")
    results = []
    for label, sep in (("tab", "\t"), ("pipe", "|")):
        path = scratch_dir(spark, label)
        writers.write_csv(parts, path, sep=sep)
        back = readers.read_csv(spark, path, schema=parts.schema, sep=sep)
        results.append(
            back.groupBy("p_brand").agg(
                F.count(F.lit(1)).alias("n"),
                F.sum("p_size").alias("sizes"),
                F.max("p_type").alias("last_type"),
                F.max("p_name").alias("last_name"),
                exact_sum("p_retailprice").alias("prices"),
                F.max("p_partkey").alias("last_key"),
            ).withColumn("sep", F.lit(label))
        )
    return results[0].unionByName(results[1])


@query(
    "csv_roundtrip",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, "
    "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders",
)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
    )
    writers.write_csv(orders, path)
    return readers.read_csv(spark, path, schema=orders.schema)


# Rows that a task deals to its small files at most, beyond the first sixteen tasks.
SMALL_ROWS = 500_000


@query(
    "compact_files",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
    CAST(NULL AS DOUBLE) AS discount, true AS fewer_files FROM orders UNION ALL
    SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(o_orderdate AS VARCHAR),
    o_totalprice / 2, true FROM orders""",
)
def compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small files in partition folders, a second batch with one more column, copied into few files."""
    small, packed = scratch_dir(spark, "small"), scratch_dir(spark, "packed")
    orders = load(spark, sf_dir, "orders")
    # Dealt by key and place: to deal in turn, Spark would sort every input split first.
    place, tasks = ["o_orderkey", F.col("_metadata.row_index")], orders.count() // SMALL_ROWS
    orders.repartition(max(16, tasks), *place).write.partitionBy("o_orderstatus").parquet(small)
    wider = orders.withColumn("o_orderkey", -F.col("o_orderkey") - 1).withColumn("discount", F.col("o_totalprice") / 2)
    wider.repartition(max(8, tasks), *place).write.mode("append").partitionBy("o_orderstatus").parquet(small)
    rows = writers.compact_files(spark, small, packed)
    fewer = list_files(spark, packed).count() < list_files(spark, small).count()
    return rows.withColumn("o_orderdate", F.col("o_orderdate").cast("string")).withColumn("fewer_files", F.lit(fewer))
