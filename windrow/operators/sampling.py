"""Cutting and sampling data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from windrow.functions.numbers import key_fraction


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Spark's own split: disjoint and complete, but it depends on the layout of the data."""
    return df.randomSplit(weights, seed)


def hash_split(df: DataFrame, weights: list[float], key: list[Column], seed: int) -> list[DataFrame]:
    """Split by key: the same rows in every run and layout, by a filter only."""
    total = float(sum(weights))
    share = key_fraction(seed, *key)
    parts, low = [], 0.0
    for i, weight in enumerate(weights):
        high = low + weight / total
        test = share >= low
        if i < len(weights) - 1:
            test = test & (share < high)
        parts.append(df.filter(test))
        low = high
    return parts


def stratified_sample(df: DataFrame, stratum: str, fractions: dict[object, float], key: list[Column], seed: int) -> DataFrame:
    """Keep the given fraction of each stratum by key; strata not named are left out.

    A null stratum is named by None.
    """
    share = key_fraction(seed, *key)
    cases = [(F.col(stratum).eqNullSafe(F.lit(s)) & (share < f)) for s, f in fractions.items()]
    return df.filter(reduce(lambda a, b: a | b, cases, F.lit(False)))


def sample_per_stratum(df: DataFrame, stratum: str, size: int, key: list[Column], seed: int) -> DataFrame:
    """``size`` rows of each stratum, or all where it has fewer, the null stratum too.

    The rows with the smallest fractions of their keys: the same in every run and layout, and every row
    is as likely as any other. Each task keeps ``size`` rows of a stratum before the shuffle, so a
    stratum with most of the table is cut where it lies. Equal fractions go by key.
    """
    # Up to this size Spark cuts in each task; it is looked up when the plan is optimised.
    bound = "spark.sql.optimizer.windowGroupLimitThreshold"
    if size > int(df.sparkSession.conf.get(bound)):
        df.sparkSession.conf.set(bound, str(size))
    order = Window.partitionBy(stratum).orderBy(key_fraction(seed, *key), *key)
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= size).drop("_rank")


def simple_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Spark's own row sample, e.g. ahead of a plot."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
