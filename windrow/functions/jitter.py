"""Jitter: add a little uniform noise to numbers.

The width follows the public description of R's ``jitter``: a fifth of the smallest
gap between neighbouring distinct values, after rounding to three digits below the
range's magnitude; a fiftieth of the value where there is only one, and of 1 where
that is zero.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.numbers import key_fraction


def jitter_width(values: np.ndarray) -> float:
    """Half width of the noise for a local array."""
    spread = float(values.max() - values.min()) or abs(float(values[0])) or 1.0
    digits = 3 - int(np.floor(np.log10(spread)))
    distinct = np.unique(np.round(values, digits))
    if len(distinct) > 1:
        gap = float(np.diff(distinct).min())
    else:
        gap = (float(distinct[0]) or spread) / 10.0
    return abs(gap) / 5.0


def jitter_widths(df: DataFrame, group: str, x: str) -> DataFrame:
    """Half width per group: columns ``group`` and ``width``.

    A group may hold most of the table, yet rounding to three digits below the magnitude of its
    range leaves at most ten thousand and one distinct values, which one aggregation gathers
    and sorts. Groupings by one struct keep joins from reusing their shuffle, which would keep
    adaptive execution from splitting such a group.
    """
    whole = F.struct(group).alias("_group")
    values = df.select(F.col(group), F.col(x).cast("double").alias("_x")).dropna()
    spread = F.nullif(F.max("_x") - F.min("_x"), F.lit(0.0))
    magnitude = (
        values.groupBy(whole)
        .agg(F.coalesce(spread, F.nullif(F.abs(F.min("_x")), F.lit(0.0)), F.lit(1.0)).alias("_z"))
        .select("_group.*", "_z", F.pow(F.lit(10.0), 3 - F.floor(F.log10("_z"))).alias("_scale"))
    )
    rounded = F.round(F.col("_x") * F.col("_scale")) / F.col("_scale")
    found = (
        values.join(magnitude, group)
        .groupBy(whole)
        .agg(F.array_sort(F.collect_set(rounded)).alias("_values"), F.first("_z").alias("_z"))
    )
    steps = F.transform(F.sequence(F.lit(1), F.size("_values") - 1), lambda i: F.get("_values", i) - F.get("_values", i - 1))
    gap = F.when(F.size("_values") > 1, F.array_min(steps))
    lowest = F.get("_values", F.lit(0))
    width = F.coalesce(gap / 5, F.abs(F.nullif(lowest, F.lit(0.0))) / 50, F.col("_z") / 50)
    return found.select("_group.*", width.alias("width"))


def jitter_keyed(df: DataFrame, group: str, x: str, key: list[Column], seed: int, name: str = "jittered") -> DataFrame:
    """Add ``name``: x moved by a fraction of the group's width that the row key fixes.

    Rows without a group or without x are kept, with a null in ``name``.
    """
    move = (key_fraction(seed, *key) * 2 - 1) * F.col("width")
    return (
        df.join(jitter_widths(df, group, x), group, "left")
        .withColumn(name, F.col(x).cast("double") + move)
        .drop("width")
    )
