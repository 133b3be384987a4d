"""Queries over the catalog: databases, tables, views, files behind them, schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators.summaries import count_by_desc
from windrow.operators.history import as_changes, state_at
from windrow.plans.inputs import TABLES, load, view_name
from windrow.plans.registry import query
from windrow.session import scratch_dir
from windrow.sources import catalog, readers, writers


@query("table_roundtrip", "SELECT source, COUNT(*) AS n FROM documents GROUP BY source")
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Database at a location, switch to it, save counts as a table, read it by name."""
    database, root = view_name("db"), scratch_dir(spark, "db")
    catalog.create_database(spark, database, root)
    try:
        with catalog.use_database(spark, database):
            counts = count_by_desc(load(spark, sf_dir, "documents"), "source")
            writers.write_table(counts, "persistentTable", scratch_dir(spark, "persistenttable"))
            return readers.read_table(spark, "persistentTable").select("source", "n")
    finally:
        # the table's folder lies outside, so its files stay for the result
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query(
    "ctas_location",
    "SELECT c_mktsegment, COUNT(*) AS n, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance "
    "FROM customer GROUP BY c_mktsegment",
)
def ctas_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop if there, create from a SELECT at a location, read back."""
    view, table, path = view_name("customers"), view_name("segments"), scratch_dir(spark, "ctas")
    load(spark, sf_dir, "customer").createOrReplaceTempView(view)
    text = (
        "SELECT c_mktsegment, COUNT(*) AS n, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance "
        f"FROM {view} GROUP BY c_mktsegment"
    )
    result = writers.create_table_as(spark, table, path, text)
    spark.sql(f"DROP TABLE {table}")
    spark.catalog.dropTempView(view)
    return result


@query(
    "list_tables",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in TABLES),
)
def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given tables registered in a database, listed, with their row counts."""
    database, root = view_name("db"), scratch_dir(spark, "db")
    catalog.create_database(spark, database, root)
    try:
        for table in TABLES:
            spark.sql(f"CREATE TABLE {database}.{table} USING parquet LOCATION '{sf_dir}/{table}.parquet'")
        names = [r["tableName"] for r in catalog.list_tables(spark, database).collect()]
        counts = [
            spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
            for name in names
        ]
        return reduce(DataFrame.unionByName, counts)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query(
    "table_detail",
    "SELECT 'parquet' AS format, 4 AS num_files, true AS has_bytes, COUNT(*) AS n_rows FROM orders",
)
def table_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format, number of files and size behind a table."""
    path = scratch_dir(spark, "detail")
    load(spark, sf_dir, "orders").repartition(4).write.parquet(path)
    detail = catalog.table_detail(spark, path)
    rows = readers.read_parquet(spark, path).agg(F.count(F.lit(1)).alias("n_rows"))
    return (
        detail.select(
            "format",
            F.col("num_files").cast("int").alias("num_files"),
            (F.col("size_bytes") > 0).alias("has_bytes"),
            F.lit(None).cast("long").alias("n_rows"),
        )
        .unionByName(rows, allowMissingColumns=True)
        .agg(*[F.max(c).alias(c) for c in ("format", "num_files", "has_bytes", "n_rows")])
    )


@query(
    "schema_frame",
    """SELECT column_name AS name, true AS nullable, CASE column_type WHEN 'BIGINT' THEN 'bigint'
    WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
    WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS type FROM (DESCRIBE lineitem)""",
)
def schema_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.schema_frame(load(spark, sf_dir, "lineitem"))


@query("table_dim", "SELECT COUNT(*) AS n_rows, 11 AS n_cols FROM lineitem")
def table_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.table_dim(load(spark, sf_dir, "lineitem"))


@query(
    "partition_profile",
    "SELECT COUNT(*) AS n_rows, true AS within_partitions, true AS none_empty FROM lineitem",
)
def partition_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition; the layout may be any, the totals not."""
    items = load(spark, sf_dir, "lineitem").select("l_orderkey")
    partitions = catalog.num_partitions(items)
    return catalog.partition_profile(items).agg(
        F.sum("n_rows").alias("n_rows"),
        F.bool_and(F.col("partition") < partitions).alias("within_partitions"),
        F.bool_and(F.col("n_rows") > 0).alias("none_empty"),
    )


@query("parquet_handoff", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def parquet_handoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table, parquet, read by path, table of changes, state, as one pipeline."""
    table, root = view_name("adult"), scratch_dir(spark, "handoff")
    writers.write_table(load(spark, sf_dir, "part"), table, f"{root}/table")
    writers.write_parquet(readers.read_table(spark, table), f"{root}/between")
    spark.sql(f"DROP TABLE {table}")
    between = readers.read_path(spark, f"{root}/between")
    writers.write_parquet(as_changes(between, "insert", 0, F.current_timestamp()), f"{root}/changes", "overwrite")
    return state_at(readers.read_path(spark, f"{root}/changes"), ["p_partkey"])
