import pandas as pd
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from windrow.operators import groups
from windrow.sources.readers import local_frame


def test_whole_group_in_one_call(spark):
    df = spark.range(60).select((F.col("id") % 3).alias("k"), "id")

    def middle(key, rows):
        return pd.DataFrame({"k": [key[0]], "n": [len(rows)], "total": [rows["id"].sum()]})

    got = groups.apply_groups(df, ["k"], middle, "k long, n long, total long", columns=["id"])
    assert sorted(map(tuple, got.collect())) == [(0, 20, 570), (1, 20, 590), (2, 20, 610)]


def test_key_is_put_in_front(spark):
    df = local_frame(spark, [("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    got = groups.apply_groups(df, ["k"], lambda key, rows: pd.DataFrame({"s": [int(rows["v"].sum())]}), "k string, s int", prepend_key=True)
    assert sorted(map(tuple, got.collect())) == [("a", 3), ("b", 3)]


def test_names_may_be_given_by_position(spark):
    df = local_frame(spark, [("a", 1.0)], "k string, v double")

    def dotted(key, rows):
        return pd.DataFrame({"term": ["x"], "std.error": [0.5]})

    with pytest.raises(PythonException, match="OutputMismatch"):
        groups.apply_groups(df, ["k"], dotted, "term string, std_error double").collect()
    got = groups.apply_groups(df, ["k"], dotted, "term string, std_error double", by_position=True)
    assert [tuple(r) for r in got.collect()] == [("x", 0.5)]


@pytest.mark.parametrize("values", [[1.5], ["x"]])
def test_wrong_types_raise_instead_of_turning_into_wrong_numbers(spark, values):
    with pytest.raises(PythonException, match="OutputMismatch"):
        groups.apply_partitions(spark.range(1), lambda rows: pd.DataFrame({"v": values}), "v int").collect()


def test_whole_partition_and_batches(spark):
    df = spark.range(0, 50000, 1, 2)
    count = lambda rows: pd.DataFrame({"n": [len(rows)]})
    assert [r["n"] for r in groups.apply_partitions(df, count, "n long", whole=True).collect()] == [25000, 25000]
    batches = [r["n"] for r in groups.apply_partitions(df, count, "n long").collect()]
    assert sum(batches) == 50000 and max(batches) <= 10000
    assert [r["n"] for r in groups.apply_partitions(df, count, "n long", first=True).collect()] == [10000, 10000]


def test_integers_keep_their_type_with_and_without_nulls(spark):
    df = spark.range(0, 30000, 1, 1).select(F.when(F.col("id") >= 10000, F.col("id").cast("int")).alias("v"))
    kinds = groups.apply_partitions(df, lambda rows: pd.DataFrame({"t": [str(rows["v"].dtype)]}), "t string")
    assert {r["t"] for r in kinds.collect()} == {"Int32"}
    same = groups.apply_partitions(df, lambda rows: rows, "v int")
    assert same.filter("v is null").count() == 10000


def test_elements_from_a_list_or_a_column(spark):
    carriers = [f"carrier {i}" for i in range(20)]
    one = lambda e: pd.DataFrame({"carrier": [e], "newcol": [f"{e}_new"]})
    got = groups.map_elements(carriers, one, "carrier string, newcol string", spark=spark, spread=4)
    assert sorted(map(tuple, got.collect())) == sorted((c, f"{c}_new") for c in carriers)
    assert got.rdd.getNumPartitions() == 4


def test_schema_is_found_on_a_sample(spark):
    schema = groups.infer_output_schema(lambda rows: rows.assign(half=rows["id"] / 2, name="x"), spark.range(10))
    assert [(f.name, f.dataType.simpleString()) for f in schema.fields] == [("id", "bigint"), ("half", "double"), ("name", "string")]


def test_elements_give_rows_and_frames_in_order(spark):
    both = lambda e: {"v": e} if e % 2 else pd.DataFrame({"v": [e, -e]})
    df = spark.range(0, 1000, 1, 1).select(F.col("id").alias("e"))
    got = [r["v"] for r in groups.map_elements(df, both, "v long").collect()]
    assert got == [v for e in range(1000) for v in ([e] if e % 2 else [e, -e])]


def test_modules_travel_with_the_job(spark, tmp_path):
    module = tmp_path / "carried_along.py"
    module.write_text("def triple(x):\n    return x * 3\n")

    def use(rows, context):
        import carried_along

        return pd.DataFrame({"v": carried_along.triple(rows["id"]) + context})

    got = groups.apply_with_context(spark.range(3), use, 1, "v long", modules=[str(module)])
    assert sorted(r["v"] for r in got.collect()) == [1, 4, 7]


def test_reduced_groups_equal_whole_groups(spark):
    """A third of the rows in one group: summaries are shuffled, never its rows."""
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), (F.col("id") % 101).cast("double").alias("v")
    )

    def partial(rows):
        return rows.assign(n=1).groupby("k", as_index=False).sum()

    merged = groups.reduce_groups(
        df, ["k"], partial, "k long, v double, n long", [F.sum("v").alias("v"), F.sum("n").alias("n")],
        lambda rows: pd.DataFrame({"k": rows["k"], "mean": rows["v"] / rows["n"]}), "k long, mean double",
    )
    whole = groups.apply_groups(
        df, ["k"], lambda key, rows: pd.DataFrame({"k": [key[0]], "mean": [rows["v"].mean()]}), "k long, mean double"
    )
    a, b = (dict(map(tuple, d.collect())) for d in (merged, whole))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_every_type_goes_there_and_back(spark):
    df = spark.sql(
        """SELECT id, cast(id as int) i, cast(id as double) d, cast(id as string) s, id % 2 = 0 b,
        timestamp'2024-03-01 12:00:00' + make_interval(0, 0, 0, cast(id as int)) ts,
        timestamp_ntz'2024-03-01 12:00:00' ntz, date'2024-02-29' day, cast(id as decimal(18,2)) m,
        array(id, null) a, named_struct('x', id, 'y', 'z') st, map('k', id) mp, cast('ab' as binary) bin FROM range(5)"""
    )
    holes = df.select(*[F.when(F.col("id") != 3, F.col(c)).alias(c) for c in df.columns])
    for frame in (df, holes):
        back = groups.apply_partitions(frame, lambda rows: rows, frame.schema)
        assert sorted(map(str, back.collect())) == sorted(map(str, frame.collect()))


def test_a_hot_group_streams_in_little_memory(spark):
    """A third of three million rows in one group, 300 MB of it: the function's worker grows by far less."""
    rows = spark.range(0, 3_000_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("k"), "id", F.repeat(F.lit("x"), 300).alias("text")
    )

    def resident_mb():
        with open("/proc/self/status") as status:
            return next(int(line.split()[1]) for line in status if line.startswith("VmRSS")) / 1024

    def watch(key, frames):
        n, most, start, largest = 0, 0.0, resident_mb(), 0
        for frame in frames:
            n, largest = n + len(frame), max(largest, len(frame))
            most = max(most, resident_mb())
        return pd.DataFrame({"n": [n], "largest": [largest], "grown": [most - start]})

    got = groups.apply_groups(rows, ["k"], watch, "k long, n long, largest long, grown double", prepend_key=True, batches=True)
    by_key = {r["k"]: r for r in got.collect()}
    assert by_key[0]["n"] == 1_000_000 + 2000 and by_key[0]["largest"] <= 10_000 and by_key[0]["grown"] < 100
    assert sum(r["n"] for r in by_key.values()) == 3_000_000


def test_streamed_groups_yield_any_number_of_frames_in_order(spark):
    rows = spark.range(0, 50_000, 1, 4).select((F.col("id") % 3).alias("k"), (-F.col("id")).alias("v"))

    def parts(key, frames):
        last = None
        for frame in frames:
            sorted_in = frame["v"].is_monotonic_increasing and (last is None or frame["v"].iloc[0] >= last)
            last = frame["v"].iloc[-1]
            yield pd.DataFrame({"n": [len(frame)], "sorted_in": [bool(sorted_in)]})

    got = groups.apply_groups(
        rows, ["k"], parts, "k long, n long, sorted_in boolean", prepend_key=True, batches=True, order=["v"]
    ).collect()
    assert all(r["sorted_in"] for r in got) and sum(r["n"] for r in got) == 50_000 and len(got) >= 6
    nothing = groups.apply_groups(rows.limit(0), ["k"], parts, "k long, n long, sorted_in boolean", prepend_key=True, batches=True)
    assert nothing.count() == 0
    with pytest.raises(ValueError, match="batches"):
        groups.apply_groups(rows, ["k"], parts, "k long", order=["v"])


def test_streamed_groups_are_dealt_and_sorted_once(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    ordered = groups.apply_groups(rows, ["k"], lambda key, frames: next(frames), "k long, id long", batches=True, order=["id"])
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[-1]
    assert final.count("Exchange hashpartitioning") == 1 and final.count("Sort [") == 1, plan


def test_partition_functions_in_two_passes(spark):
    """Each row less the mean of its partition; a partition is far larger than a batch, and none is held."""
    rows = spark.range(0, 90_000, 1, 3).select("id")

    def centred(frames):
        for frame in frames:
            yield pd.DataFrame({"id": frame["id"], "off": frame["id"] - frame["mean"], "n": frame["n"], "batch": len(frame)})

    got = groups.apply_partitions_twice(
        rows, lambda stored, part: stored.groupBy(part).agg(F.avg("id").alias("mean"), F.count("id").alias("n")), centred,
        "id long, off double, n long, batch long",
    )
    summary = got.agg(F.count("id"), F.sum("off"), F.min("n"), F.max("n"), F.max("batch"), F.max(F.abs("off"))).first()
    assert tuple(summary) == (90_000, 0.0, 30_000, 30_000, 10_000, 14999.5)
