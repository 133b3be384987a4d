"""Databases, tables, files and schemas, all as small DataFrames."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_database(spark: SparkSession, name: str, path: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{path}'")


@contextmanager
def use_database(spark: SparkSession, name: str) -> Iterator[None]:
    """Switch the current database for a block and switch back after it."""
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(name)
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables of a database (temporary views left out)."""
    return spark.sql(f"SHOW TABLES IN {database}").filter(~F.col("isTemporary")).select("namespace", "tableName")


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per data file. Only the listing is used: no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return files.select(
        F.col("path").alias("file_path"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def table_detail(spark: SparkSession, path: str, source: str = "parquet") -> DataFrame:
    """One row: format, location, number of files, bytes, first and last change."""
    return list_files(spark, path, f"*.{source}").agg(
        F.lit(source).alias("format"),
        F.lit(path).alias("location"),
        F.count(F.lit(1)).alias("num_files"),
        F.sum("size_bytes").alias("size_bytes"),
        F.min("modified_at").alias("created_at"),
        F.max("modified_at").alias("last_modified"),
    )


def schema_frame(df: DataFrame) -> DataFrame:
    """Name, type and nullability of each column."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "name string, type string, nullable boolean")


def table_dim(df: DataFrame) -> DataFrame:
    """Rows by columns, as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def num_partitions(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows in each partition that holds any."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n_rows"))
