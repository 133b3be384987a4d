import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from windrow.functions import dates, jitter, numbers
from windrow.operators import sampling, shaping, summaries
from windrow.sources.readers import local_frame


def test_key_fraction_fixed_value(spark):
    got = spark.range(1).select((numbers.key_fraction("a", F.lit(1)) * 2**32).cast("long")).first()[0]
    assert got == 225584429


def test_hash_split_is_disjoint_complete_and_fixed(spark, medium):
    customers = spark.read.parquet(f"{medium}/customer.parquet").select("c_custkey")
    parts = sampling.hash_split(customers, [0.02, 0.98], [F.col("c_custkey")], 206)
    again = sampling.hash_split(customers.repartition(5), [2, 98], [F.col("c_custkey")], 206)
    keys = [sorted(r[0] for r in p.collect()) for p in parts]
    assert len(keys[0]) == 36 and sorted(keys[0] + keys[1]) == list(range(1500))
    assert keys == [sorted(r[0] for r in p.collect()) for p in again]
    thirds = sampling.hash_split(customers, [1, 1, 1], [F.col("c_custkey")], 1)
    assert sum(p.count() for p in thirds) == 1500


def test_random_samples(spark):
    df = spark.range(10000)
    assert 700 < sampling.simple_sample(df, 0.1, 3).count() < 1300
    parts = sampling.random_split(df, [0.02, 0.98], 206)
    assert sum(p.count() for p in parts) == 10000 and 100 < parts[0].count() < 320


def test_text_to_number(spark):
    df = local_frame(spark, [("1.5",), ("NA",), (None,), (" 7 ",)], "t string")
    assert [r[0] for r in df.select(numbers.to_number(F.col("t"))).collect()] == [1.5, None, None, 7.0]


def test_not_like_leaves_nulls_out(spark):
    df = local_frame(spark, [("NA",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.filter(shaping.differs_from(F.col("t"), "NA")).collect()] == ["x"]


def test_month_as_ranges_is_the_same_month(spark, medium):
    items = spark.read.parquet(f"{medium}/lineitem.parquet")
    years = range(*[r + i for i, r in enumerate(items.agg(F.min(F.year("l_shipdate")), F.max(F.year("l_shipdate"))).first())])
    for month in (1, 12):
        plain = items.filter(dates.in_month(F.col("l_shipdate"), month))
        ranges = items.filter(dates.in_month(F.col("l_shipdate"), month, years))
        assert plain.exceptAll(ranges).count() == 0 and plain.count() == ranges.count() > 0
        assert "GreaterThanOrEqual(l_shipdate" in ranges._jdf.queryExecution().executedPlan().toString()


def test_pivot_leaves_empty_cells_null(spark):
    df = local_frame(spark, [(1, "a"), (1, "a"), (2, "b")], "r int, c string")
    assert sorted(map(tuple, summaries.pivot_count(df, "r", "c").collect())) == [(1, 2, None), (2, None, 1)]
    assert summaries.pivot_count(df, "r", "c", ["b"]).columns == ["r", "b"]


def test_sort_puts_nulls_first_ascending_and_last_in_top(spark):
    df = local_frame(spark, [(2,), (None,), (1,)], "v int")
    assert [r[0] for r in shaping.ascending(df, "v").collect()] == [None, 1, 2]
    assert [r[0] for r in shaping.top_n(df, 2, ["v"]).collect()] == [2, 1]


def width_of(values):
    """The public description, value by value."""
    spread = (max(values) - min(values)) or abs(values[0]) or 1.0
    digits = 3 - int(np.floor(np.log10(spread)))
    xs = sorted({round(v, digits) for v in values})
    gap = min(b - a for a, b in zip(xs, xs[1:])) if len(xs) > 1 else (xs[0] or spread) / 10
    return abs(gap) / 5


@pytest.mark.parametrize("seed", range(3))
def test_widths_of_groups_by_brute_force(spark, seed):
    """One group holds most distinct values; others have one value, or only zeros."""
    pick = random.Random(seed)
    groups = {
        "hot": [pick.randrange(10**6) / 64 for _ in range(600)],
        "one": [7.25] * 5,
        "zero": [0.0] * 3,
        "minus": [-4.0],
        "few": [1.0, 1.5, 9.0],
    }
    data = [(g, v) for g, vs in groups.items() for v in vs] + [("few", None), (None, 3.0)]
    pick.shuffle(data)
    df = local_frame(spark, data, "g string, x double")
    got = {r["g"]: r["width"] for r in jitter.jitter_widths(df, "g", "x").collect()}
    assert got == {g: pytest.approx(width_of(vs)) for g, vs in groups.items()}
    for vs in groups.values():
        assert jitter.jitter_width(np.array(vs)) == pytest.approx(width_of(vs))


def test_keyed_jitter_is_bounded_whole_and_fixed(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("g"), (F.col("id") % 13).alias("x"))
    df = df.unionByName(spark.createDataFrame([(1000, None, 5), (1001, 0, None)], df.schema))
    moved = jitter.jitter_keyed(df, "g", "x", [F.col("id")], 1)
    again = jitter.jitter_keyed(df.repartition(5), "g", "x", [F.col("id")], 1)
    a, b = (sorted(map(tuple, d.select("id", "jittered").collect())) for d in (moved, again))
    assert a == b and len(a) == 502
    assert moved.filter(F.abs(F.col("jittered") - F.col("x")) > 0.2).count() == 0
    assert moved.filter("jittered is null").count() == 2
