import random
import time

import pytest
from pyspark.sql import functions as F

from windrow.sources.readers import local_frame
from windrow.streaming import folders
from windrow.streaming.folders import add_batch, names_in, read_batches, stream_batches
from windrow.streaming.running import latest_result, refresh_keyed, refresh_result, running_sum, start_running, write_stream

KV = "k string, v bigint"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_any_cut_into_batches_gives_the_batch_result(spark, tmp_path, seed):
    pick = random.Random(seed)
    data = [("hot" if pick.random() < 0.4 else pick.choice("abc"), pick.randrange(100)) for _ in range(60)]
    cuts = sorted(pick.sample(range(1, 60), 3))
    folder = str(tmp_path / "t")
    add_batch(local_frame(spark, data[: cuts[0]], KV), folder, "first")
    sums = running_sum(stream_batches(spark, folder, files_per_batch=pick.choice([1, 100])), "k", "v", "total")
    where = (str(tmp_path / "result"), str(tmp_path / "checkpoint"))
    streamed = refresh_result(sums, *where, timeout=120)
    for a, b in zip(cuts, [*cuts[1:], 60]):
        add_batch(local_frame(spark, data[a:b], KV), folder, f"from-{a}")
        earlier = rows_of(streamed)
        kept = streamed
        streamed = refresh_result(sums, *where, timeout=120)
        assert rows_of(kept) == earlier  # stays readable until the next run
        assert rows_of(streamed) == rows_of(read_batches(spark, folder).groupBy("k").agg(F.sum("v").alias("total")))
    assert len(names_in(spark, where[0])) <= 2  # older results are gone
    assert rows_of(refresh_result(sums, *where, timeout=120)) == rows_of(streamed)  # nothing new


def test_golden_restart(spark, medium, tmp_path):
    from windrow.plans import QUERIES

    got = {(r["step"], r["addr_state"]): r["loans"] for r in QUERIES["stream_incremental"](spark, medium).collect()}
    assert (got["before", "7"], got["after", "7"]) == (73, 2773)


def test_a_broken_off_batch_is_not_seen_and_its_repetition_counts_once(spark, tmp_path):
    folder = str(tmp_path / "t")
    add_batch(local_frame(spark, [("a", 1), ("b", 2)], KV), folder, "one")
    rows = local_frame(spark, [("c", i) for i in range(5)], KV)
    rows.write.parquet(f"{folder}/_aside/two")  # a writer that ended here
    sums = running_sum(stream_batches(spark, folder), "k", "v", "total")
    where = (str(tmp_path / "result"), str(tmp_path / "checkpoint"))
    assert rows_of(refresh_result(sums, *where, timeout=120)) == [("a", 1), ("b", 2)]
    assert add_batch(rows, folder, "two") and not add_batch(rows, folder, "two")
    assert rows_of(refresh_result(sums, *where, timeout=120)) == [("a", 1), ("b", 2), ("c", 10)]
    assert read_batches(spark, folder).count() == 7


def test_a_running_stream_follows_until_it_is_stopped(spark, tmp_path):
    folder, where = str(tmp_path / "t"), (str(tmp_path / "result"), str(tmp_path / "checkpoint"))
    add_batch(local_frame(spark, [("a", 1)], KV), folder, "0")
    sums = running_sum(stream_batches(spark, folder), "k", "v", "total")
    running = start_running(sums, *where, interval="0 seconds")
    try:
        running.processAllAvailable()
        for number in range(1, 5):
            add_batch(local_frame(spark, [("a", number)], KV), folder, str(number))
            running.processAllAvailable()
            assert rows_of(latest_result(sums, where[0])) == [("a", sum(range(number + 1)) + 1)]
    finally:
        running.stop()
    assert not running.isActive and len(names_in(spark, where[0])) <= 2
    time.sleep(0.1)


def test_sink_writes_each_row_once_across_runs(spark, tmp_path):
    folder, where = str(tmp_path / "t"), (str(tmp_path / "rows"), str(tmp_path / "checkpoint"))
    add_batch(local_frame(spark, [("a", 1), ("b", 2)], KV), folder, "0")
    write_stream(stream_batches(spark, folder), *where, timeout=120)
    add_batch(local_frame(spark, [("c", 3)], KV), folder, "1")
    written = write_stream(stream_batches(spark, folder), *where, timeout=120)
    assert rows_of(written) == [("a", 1), ("b", 2), ("c", 3)]
    assert write_stream(stream_batches(spark, folder), *where, timeout=120).count() == 3


def test_two_writers_that_both_looked_first_count_once(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    rows = local_frame(spark, [("c", i) for i in range(5)], KV)
    assert add_batch(rows, folder, "one")
    monkeypatch.setattr(folders, "names_in", lambda *_: [])  # as the other writer saw it
    assert not add_batch(rows, folder, "one")
    monkeypatch.undo()
    assert read_batches(spark, folder).count() == 5
    assert names_in(spark, f"{folder}/_aside") == []


def test_keyed_results_write_what_changed_and_survive_restarts_and_folds(spark, tmp_path):
    folder = str(tmp_path / "t")
    where = (str(tmp_path / "result"), str(tmp_path / "checkpoint"))
    data = [(f"k{i}", i) for i in range(300)]
    add_batch(local_frame(spark, data, KV), folder, "first")
    sums = running_sum(stream_batches(spark, folder), "k", "v", "total")
    result = refresh_keyed(sums, ["k"], *where, timeout=120, fold_after=2)
    for number in range(4):
        more = [("k1", 10 + number), (f"new{number}", 1), ("k1", 5), (None, number)]
        add_batch(local_frame(spark, more, KV), folder, f"more-{number}")
        earlier, kept = rows_of(result), result
        result = refresh_keyed(sums, ["k"], *where, timeout=120, fold_after=2)
        assert sorted(map(str, rows_of(kept))) == sorted(map(str, earlier))
        want = read_batches(spark, folder).groupBy("k").agg(F.sum("v").alias("total"))
        assert sorted(map(str, result.collect())) == sorted(map(str, want.collect()))
        written = spark.read.parquet(f"{where[0]}/batch={number + 1}").count()
        assert written == 3  # of more than 300 keys
    assert len([n for n in names_in(spark, where[0]) if n.startswith("batch=")]) <= 4
    assert sorted(map(str, refresh_keyed(sums, ["k"], *where, timeout=120, fold_after=2).collect())) == sorted(map(str, result.collect()))
    with pytest.raises(ValueError, match="batch"):
        refresh_keyed(sums.withColumnRenamed("total", "batch"), ["k"], *where)
