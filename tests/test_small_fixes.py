"""Cases that once went wrong without a word."""

from pyspark.sql import functions as F

from windrow.operators import changes, sampling, summaries
from windrow.sources.readers import local_frame


def test_aggregates_are_named_whatever_spark_calls_them(spark):
    df = local_frame(spark, [("a", 1), ("a", 3), ("b", 5)], "k string, id long")
    got = summaries.agg_by_name(df, ["k"], {"id": "mean", "*": "count"}, {"id": "average", "*": "n"})
    assert sorted(map(tuple, got.collect())) == [("a", 2.0, 2), ("b", 5.0, 1)] and got.columns == ["k", "average", "n"]
    assert summaries.agg_by_name(df, ["k"], {"id": "sum"}).columns == ["k", "sum(id)"]


def test_a_null_stratum_can_be_named(spark):
    df = local_frame(spark, [("a", i) for i in range(5)] + [(None, i) for i in range(5, 10)], "s string, id long")
    key = [F.col("id")]
    assert sampling.stratified_sample(df, "s", {"a": 1.0, None: 1.0}, key, 1).count() == 10
    assert sampling.stratified_sample(df, "s", {None: 1.0}, key, 1).count() == 5


def test_updates_name_columns_in_any_case(spark):
    df = local_frame(spark, [(1, 10), (2, 20)], "Id long, Value long")
    got = changes.update_where(df, "id = 2", {"VALUE": F.col("value") + 1})
    assert sorted(map(tuple, got.collect())) == [(1, 10), (2, 21)] and got.columns == ["Id", "Value"]


def test_a_source_that_changes_is_seen_once(spark):
    target = spark.range(100).withColumn("v", F.lit(0.0))
    source = spark.range(50, 150).withColumn("v", F.rand())
    merged = changes.merge_upsert(target, source, ["id"])
    assert merged.orderBy("id").collect() == merged.orderBy("id").collect()
    assert merged.count() == 150
