import random

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from windrow.operators import changes
from windrow.sources.readers import local_frame

KV = "k string, v bigint"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_delete_and_update_act_only_where_the_test_is_true(spark):
    df = local_frame(spark, [("a", 1), ("b", None), ("c", 3)], KV)
    assert rows(changes.delete_where(df, "v = 1")) == [("b", None), ("c", 3)]
    assert rows(changes.update_where(df, "v > 2", {"v": 0})) == [("a", 1), ("b", None), ("c", 0)]
    with pytest.raises(changes.SchemaMismatch):
        changes.update_where(df, "v > 2", {"n": 0})


def test_update_sees_the_row_as_it_was(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(changes.update_where(df, F.lit(True), {"a": F.col("b"), "b": F.col("a")})) == [(2, 1)]


def test_merge_with_nulls_and_repeated_target_keys(spark):
    target = local_frame(spark, [("a", 1), ("a", 2), ("b", 3), (None, 4)], KV)
    source = local_frame(spark, [("a", 9), ("c", 5), (None, 6), ("d", None)], KV)
    assert rows(changes.merge_upsert(target, source, ["k"])) == sorted(
        [("a", 9), ("a", 9), ("b", 3), (None, 4), ("c", 5), (None, 6), ("d", None)], key=repr
    )


def test_merge_writes_nulls_of_a_matching_row(spark):
    target = local_frame(spark, [("a", 1)], KV)
    source = local_frame(spark, [("a", None)], KV)
    assert rows(changes.merge_upsert(target, source, ["k"])) == [("a", None)]


def test_merge_refuses_two_rows_for_one(spark):
    target = local_frame(spark, [("a", 1), ("b", 2)], KV)
    twice = local_frame(spark, [("a", 2), ("a", 3)], KV)
    merged = changes.merge_upsert(target, twice, ["k"])
    for action in (merged.collect, merged.count):
        with pytest.raises(SparkRuntimeException, match="several source rows"):
            action()
    with pytest.raises(changes.AmbiguousMerge):
        changes.check_merge_source(target, twice, ["k"])
    unmatched = local_frame(spark, [("z", 2), ("z", 3)], KV)
    assert rows(changes.merge_upsert(target, unmatched, ["k"])) == [("a", 1), ("b", 2), ("z", 2), ("z", 3)]


def test_merge_twice_is_merge_once(spark):
    target = local_frame(spark, [(str(i), i) for i in range(50)], KV)
    source = local_frame(spark, [(str(i), -i) for i in range(25, 75)], KV)
    once = changes.merge_upsert(target, source, ["k"])
    assert rows(changes.merge_upsert(once, source, ["k"])) == rows(once)


@pytest.mark.parametrize("seed", range(3))
def test_merge_against_a_dictionary(spark, seed):
    """A third of the target shares one key; a third of the source another, new one."""
    pick = random.Random(seed)
    target = [("hot" if i % 3 == 0 else str(pick.randrange(60)), i) for i in range(300)]
    keys = pick.sample(range(90), 40)
    source = [(str(k), -k) for k in keys] + [("hot", -1000)] + [("fresh", -i) for i in range(20)]
    change = {k: v for k, v in source if k != "fresh"}
    have = {k for k, _ in target}
    want = [(k, change.get(k, v)) for k, v in target] + [(k, v) for k, v in source if k not in have]
    got = changes.merge_upsert(local_frame(spark, target, KV), local_frame(spark, source, KV), ["k"])
    assert rows(got) == sorted(want, key=repr)


def test_merge_in_sort_merge_form(spark):
    """With broadcasts off, the joins shuffle: the result is the same."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_merge_against_a_dictionary(spark, 7)
        test_merge_with_nulls_and_repeated_target_keys(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_upsert_parts_make_up_the_whole(spark):
    target = local_frame(spark, [(str(i), i) for i in range(30)], KV)
    source = local_frame(spark, [(str(i), -i) for i in range(20, 40)], KV)
    assert changes.new_rows(target, source, ["k"]).count() == 10
    assert changes.replaced_rows(target, source, ["k"]).count() == 10
    assert changes.unaffected_rows(target, source, ["k"]).count() == 20


def test_append_checks_the_schema(spark):
    df = local_frame(spark, [("a", 1)], KV)
    with pytest.raises(changes.SchemaMismatch):
        changes.append_strict(df, df.withColumn("amount", F.lit(1.0)))
    with pytest.raises(changes.SchemaMismatch):
        changes.append_strict(df, df.withColumn("v", F.lit(1.0)))
    with pytest.raises(changes.SchemaMismatch):
        changes.append_merge_schema(df, df.withColumn("v", F.lit("x")))
    wide = changes.append_merge_schema(df, df.select("k", F.lit(2.5).alias("amount")))
    assert rows(wide) == sorted([("a", 1, None), ("a", None, 2.5)], key=repr)


@pytest.fixture
def stored(spark, tmp_path):
    """Stores rows as a laid-out table; the tables go after the test."""
    names = []

    def store(df, keys, buckets=4):
        names.append(f"laid_out_{tmp_path.name.replace('-', '_')}_{len(names)}")
        return changes.lay_out(df, names[-1], str(tmp_path / names[-1]), keys, buckets)

    yield store
    for name in names:
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("seed", range(3))
def test_laid_out_merge_is_the_merge(spark, stored, seed):
    """Random tables with repeated and null keys, a third of the rows in one key; values of matches may be null."""
    pick = random.Random(seed)
    keys = [None, "hot", *(f"k{i}" for i in range(40))]
    target = [("hot" if i % 3 == 0 else pick.choice(keys), pick.randrange(9)) for i in range(200)]
    matched = [(k, pick.choice([None, 100])) for k in pick.sample(keys[1:], 15)]
    source = matched + [(None, 1), (None, 1), ("new", 5), ("new", 5), ("other", None)]
    a, b = (local_frame(spark, r, KV).repartition(3) for r in (target, source))
    assert rows(changes.merge_laid_out(stored(a, ["k"]), b, ["k"], 4)) == rows(changes.merge_upsert(a, b, ["k"]))
    empty = b.limit(0)
    assert rows(changes.merge_laid_out(stored(a, ["k"]), empty, ["k"], 4)) == rows(a)
    assert rows(changes.merge_laid_out(stored(a.limit(0), ["k"]), b, ["k"], 4)) == rows(b)


def test_laid_out_merge_over_two_keys_refuses_two_rows_for_one(spark, stored):
    schema = "v bigint, k string, j int"
    target = stored(local_frame(spark, [(1, "a", 1), (2, "a", 2), (3, "b", 1)], schema), ["k", "j"])
    once = local_frame(spark, [(9, "a", 2), (8, "b", 2), (7, "b", 2)], schema)
    assert rows(changes.merge_laid_out(target, once, ["k", "j"], 4)) == [(1, "a", 1), (3, "b", 1), (7, "b", 2), (8, "b", 2), (9, "a", 2)]
    merged = changes.merge_laid_out(target, once.unionByName(once), ["k", "j"], 4)
    for action in (merged.collect, merged.count):
        with pytest.raises(SparkRuntimeException, match="several source rows"):
            action()


def test_laid_out_merge_reads_the_table_once_and_shuffles_only_the_source(spark, stored, medium):
    orders = spark.read.parquet(f"{medium}/orders.parquet").select("o_orderkey", "o_totalprice")
    table = stored(orders, ["o_orderkey"])
    assert len({r[0] for r in table.select(F.input_file_name()).distinct().collect()}) == 4
    batch = orders.withColumn("o_orderkey", F.col("o_orderkey") + 5)
    merged = changes.merge_laid_out(table, batch, ["o_orderkey"], 4)
    tree = merged._jdf.queryExecution().executedPlan().toString()
    left, right = tree.split("SortMergeJoin")[1].split("Window", 1)
    assert "Exchange" not in left and "Bucketed: true" in left
    assert tree.count("Exchange hashpartitioning") == 1 and right.count("Exchange hashpartitioning") == 1
    assert tree.count("FileScan") == 2
