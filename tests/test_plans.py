"""Shapes of plans that must hold at scale."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from windrow.functions.jitter import jitter_keyed
from windrow.operators import changes, history, models, sampling, shaping, summaries
from windrow.plans import QUERIES
from windrow.plans.models import december
from windrow.sources.readers import local_frame


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_filters_reach_the_scan(spark, medium):
    items = spark.read.parquet(f"{medium}/lineitem.parquet")
    text = plan(items.filter((F.col("l_linenumber") == 3) & (F.col("l_quantity") > 10)).select("l_orderkey"))
    assert "EqualTo(l_linenumber,3)" in text and "GreaterThan(l_quantity,10.0)" in text
    assert "l_comment" not in text and "l_extendedprice" not in text


def test_top_n_is_no_full_sort(spark, medium):
    orders = spark.read.parquet(f"{medium}/orders.parquet")
    text = plan(shaping.top_n(orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s")), 10, ["s"], ["o_custkey"]))
    assert "TakeOrderedAndProject" in text


def test_regression_is_one_shuffle_and_python_only_after_it(spark, medium):
    text = plan(models.group_ols(december(spark, medium), "origin", "arr_delay", "dep_delay"))
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 1
    assert tree.index("ArrowEvalPython") < tree.index("Exchange")  # above it in the tree, so after it
    moments = plan(models.group_moments(december(spark, medium), "origin", "arr_delay", "dep_delay"))
    assert "Python" not in moments


def test_summaries_shuffle_partial_results(spark, medium):
    documents = spark.read.parquet(f"{medium}/documents.parquet")
    text = plan(summaries.count_by(documents, "source"))
    assert "partial_count" in text and "ReadSchema: struct<source:string>" in text


def test_states_are_partial_aggregations(spark, medium):
    orders = spark.read.parquet(f"{medium}/orders.parquet")
    versions = history.as_changes(orders, "insert", 0, F.current_timestamp())
    tree = plan(history.state_at(versions, ["o_orderkey"], 3)).split("\n\n")[0]
    assert tree.count("Exchange") == 1 and "Window" not in tree


def test_merge_with_a_small_source_does_not_shuffle_the_table(spark, medium):
    orders = spark.read.parquet(f"{medium}/orders.parquet").select("o_orderkey", "o_totalprice")
    source = local_frame(spark, [(1, 5.0), (-1, 6.0)], "o_orderkey bigint, o_totalprice double")
    text = plan(changes.merge_upsert(orders, source, ["o_orderkey"]))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin LeftOuter" in text


def test_upserts_never_use_a_full_outer_join(spark, medium):
    orders = spark.read.parquet(f"{medium}/orders.parquet")
    batch = orders.withColumn("o_orderkey", F.col("o_orderkey") + 5)
    text = plan(changes.merge_upsert(orders, batch, ["o_orderkey"]))
    assert "FullOuter" not in text


@pytest.mark.parametrize("name", ["jitter_keyed", "carrier_newcol", "hash_split", "pivot_count", "distance_by_carrier_day"])
def test_no_cross_join_and_no_single_task_window(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "SinglePartition" not in text


def test_splits_are_filters(spark, small):
    assert "Exchange" not in plan(QUERIES["hash_split"](spark, small))
    assert "Exchange" not in plan(QUERIES["stratified_sample"](spark, small))


@pytest.fixture
def small_partitions(spark):
    """Settings under which small test data counts as skewed, and nothing is broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "32",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_frames(spark, n=60000):
    """A target with a third of its rows in one key, spread over many tasks, and a source."""
    target = spark.range(0, n, 1, 16).select(
        F.when(F.col("id") % 3 == 0, -5).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    source = spark.range(0, 30000, 1, 4).select((F.col("id") * 7 - 5).alias("k"), (-F.col("id")).alias("v"))
    return target, source


def final_tree(df) -> list[str]:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()


def final_joins(df) -> list[str]:
    return [line for line in final_tree(df) if "SortMergeJoin" in line]


def test_hot_keys_of_a_merge_are_split(spark, small_partitions):
    target, source = hot_frames(spark)
    tree = final_tree(changes.merge_upsert(target, source, ["k"]))
    joins = [line for line in tree if "SortMergeJoin" in line]
    assert any("skew=true" in j and "LeftOuter" in j for j in joins), joins


def test_merge_scans_the_source_once_and_the_table_twice(spark, medium):
    orders = spark.read.parquet(f"{medium}/orders.parquet").select("o_orderkey", "o_totalprice")
    batch = orders.withColumn("o_orderkey", F.col("o_orderkey") + 5)
    text = plan(changes.merge_upsert(orders, batch, ["o_orderkey"]))
    tree = text.split("\n\n")[0]
    assert text.count("orders.parquet]") == 2  # the batch is read from its working files
    assert tree.count("Scan parquet") == 4


def test_hot_new_keys_of_a_source_are_split(spark, small_partitions):
    source, target = hot_frames(spark)
    joins = final_joins(changes.new_rows(target, source, ["k"]))
    assert any("skew=true" in j and "LeftAnti" in j for j in joins), joins


def test_hot_groups_of_a_jitter_are_split(spark, small_partitions):
    target, _ = hot_frames(spark, 600000)
    joins = final_joins(jitter_keyed(target, "k", "v", [F.col("v")], 1).agg(F.sum("jittered")))
    assert len(joins) == 2 and all("skew=true" in j for j in joins), joins


@pytest.mark.parametrize("size", [3, 1500])
def test_samples_per_stratum_are_cut_before_the_shuffle(spark, size):
    rows = spark.range(0, 9000, 1, 6).select("id", F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 9 > 0, F.lit("rare")).alias("s"))
    bound = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(bound)
    try:
        sample = sampling.sample_per_stratum(rows, "s", size, [F.col("id")], 4)
        tree = plan(sample).split("\n\n")[0]
        got = {r["s"]: r["n"] for r in sample.groupBy("s").agg(F.count("id").alias("n")).collect()}
        again = sample.collect()
    finally:
        spark.conf.set(bound, before)
    assert tree.count("WindowGroupLimit") == 2 and tree.rindex("WindowGroupLimit") > tree.index("Exchange")
    assert got == {"hot": size, "rare": min(size, 2000), None: min(size, 1000)}
    assert sorted(map(str, again)) == sorted(map(str, sampling.sample_per_stratum(rows.repartition(2), "s", size, [F.col("id")], 4).collect()))
