"""Readers. Each returns a lazy DataFrame; ``name`` also registers it as a view.

Give a schema wherever one is known: inference reads the whole input once more.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def register(df: DataFrame, name: str | None) -> DataFrame:
    """Register ``df`` as a session view, so that SQL text can name it."""
    if name:
        df.createOrReplaceTempView(name)
    return df


def read_json(
    spark: SparkSession, path: str, name: str | None = None, schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON lines."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return register(reader.json(path), name)


def read_csv(
    spark: SparkSession,
    path: str,
    name: str | None = None,
    *,
    schema: T.StructType | str | None = None,
    header: bool = True,
    infer: bool = False,
    missing: str | None = None,
    sep: str = ",",
    multiline: bool = False,
) -> DataFrame:
    """Separated text. ``missing`` is the text that stands for null.

    Quotes inside values are doubled, as ``write_csv`` and most programs do. Values with
    line breaks need ``multiline``; such files cannot be split among tasks.

    Under inference, a column that holds a missing marker which was not declared turns
    into text as a whole. Under a schema, names are given by position.
    """
    options = {"header": header, "sep": sep, "escape": '"', "multiLine": multiline}
    if schema is None:
        options["inferSchema"] = infer
    if missing is not None:
        options["nullValue"] = missing
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return register(reader.csv(path), name)


def read_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """Separated text without any option: text columns ``_c0``, ``_c1``, ..."""
    return spark.read.format("csv").load(path)


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """Parquet files. ``merge_schema`` gives the columns of all files, where they differ."""
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def read_path(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """Read by path; without a format name the session's default source is used."""
    return spark.read.load(path, format=source)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def jdbc_ranges(
    column: str | None, lower: int | None, upper: int | None, partitions: int | None
) -> dict[str, object]:
    """Arguments that split a JDBC read into ranges of ``column``; all or none."""
    given = {"column": column, "lowerBound": lower, "upperBound": upper, "numPartitions": partitions}
    missing = [key for key, value in given.items() if value is None]
    if len(missing) == len(given):
        return {}
    if missing:
        raise ValueError(f"a partitioned JDBC read also needs {missing}")
    if lower >= upper or partitions < 1:
        raise ValueError("need lower < upper and at least one partition")
    return given


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table. With ``column`` the read is split into parallel ranges.

    The bounds only place the cuts; rows outside them are read too. Without them
    Spark reads the whole table in one task, so large tables need the split.
    """
    ranges = jdbc_ranges(column, lower, upper, partitions)
    return spark.read.jdbc(url, table, properties=properties, **ranges)


def sequence_ids(spark: SparkSession, n: int) -> DataFrame:
    """Ids 1 to n in a column ``id``."""
    return spark.range(1, n + 1)


def local_frame(
    spark: SparkSession, rows: Iterable[Sequence[object]], schema: T.StructType | str
) -> DataFrame:
    """A small driver-side list of rows as a DataFrame.

    Sent as one Arrow table, so Spark knows its size and can choose joins by it.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [() for _ in schema.fields]
    kinds = to_arrow_schema(schema)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)
    return spark.createDataFrame(table, schema)


def choose_columns(spark: SparkSession, table: str, **choices: str) -> DataFrame:
    """Project a catalog table on user-chosen columns: ``choose_columns(s, t, x="a", y="b")``.

    Names are passed as parameters, never pasted into the text, and must be columns of
    the table.
    """
    known = {c.lower() for c in spark.table(table).columns}
    for role, column in choices.items():
        if column.lower() not in known:
            raise ValueError(f"{role}={column!r} is not a column of {table}")
    chosen = ", ".join(f"identifier(:{role}) AS {role}" for role in choices)
    return spark.sql(f"SELECT {chosen} FROM identifier(:source_table)", args={**choices, "source_table": table})
