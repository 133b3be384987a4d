"""Grouped summaries. All are partial-then-final aggregations inside Spark, so one
group that holds much of the table reaches the shuffle as one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_by_desc(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Counts per group, largest first; equal counts in key order."""
    return count_by(df, *keys, name=name).orderBy(F.desc(name), *keys)


def agg_by_name(df: DataFrame, keys: Sequence[str], functions: dict[str, str], names: dict[str, str] | None = None) -> DataFrame:
    """Aggregates given as column -> function name; ``names`` renames the results."""
    columns = []
    for column, function in functions.items():
        value = F.count(F.lit(1)) if column == "*" else F.call_function(function, F.col(f"`{column}`"))
        columns.append(value.alias((names or {}).get(column, f"{function}({column})")))
    return df.groupBy(*keys).agg(*columns)


def exact_sum(column: Column | str) -> Column:
    """Sum of amounts with two decimals that does not depend on the order of rows."""
    column = F.col(column) if isinstance(column, str) else column
    return F.sum(column.cast("decimal(18,2)")).cast("double")


def pivot_count(df: DataFrame, row: str, column: str, values: Sequence[object] | None = None) -> DataFrame:
    """Rows by columns with counts; cells without rows are null.

    ``values`` fixes the columns and saves the pass that looks for them.
    """
    grouped = df.groupBy(row)
    pivoted = grouped.pivot(column, list(values)) if values is not None else grouped.pivot(column)
    return pivoted.agg(F.count(F.lit(1)))
