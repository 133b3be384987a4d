"""Row selection and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def complete_cases(df: DataFrame, *columns: str) -> DataFrame:
    """The given columns, only rows without any null in them."""
    chosen = df.select(*columns) if columns else df
    return chosen.dropna(how="any")


def differs_from(column: Column, text: str) -> Column:
    """NOT LIKE without wildcards: true where the text differs; null stays null."""
    return ~column.like(text)


def ascending(df: DataFrame, *columns: str) -> DataFrame:
    """Sort ascending, nulls first."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in columns])


def top_n(df: DataFrame, n: int, by: list[str], ties: list[str] | None = None) -> DataFrame:
    """The n largest rows. ``ties`` names the columns that settle equal values.

    Spark keeps n rows per task and merges those: no full sort, no full shuffle.
    """
    order = [F.col(c).desc_nulls_last() for c in by]
    order += [F.col(c).asc_nulls_first() for c in ties or []]
    return df.orderBy(*order).limit(n)


def first_rows(df: DataFrame, order: list[str], n: int = 6) -> DataFrame:
    """The first n rows in a stated order (tables have none of their own)."""
    return ascending(df, *order).limit(n)
