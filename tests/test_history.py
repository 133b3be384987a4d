"""Histories of changes against a replay in Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from windrow.operators import history
from windrow.operators.changes import SchemaMismatch
from windrow.sources.readers import local_frame

START = datetime(2024, 1, 1)
SCHEMA = "version long, committed_at timestamp_ntz, operation string, k string, v long"


def walk(seed: int, commits: int = 12):
    """Change rows of a random walk, and the table after every commit. One key is changed very often."""
    pick, state, rows, states = random.Random(seed), {}, [], []
    for version in range(commits):
        for key in {"hot", *(pick.choice("abcdefgh") for _ in range(4))}:
            if key in state and pick.random() < 0.3:
                rows.append((version, START + timedelta(minutes=version), "delete", key, None))
                del state[key]
            else:
                kind = "update" if key in state else "insert"
                state[key] = pick.randrange(100) if pick.random() < 0.9 else None
                rows.append((version, START + timedelta(minutes=version), kind, key, state[key]))
        states.append(dict(state))
    return rows, states


def table(df):
    return {r["k"]: r["v"] for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_every_version_and_moment(spark, seed):
    rows, states = walk(seed)
    changes = local_frame(spark, rows, SCHEMA).repartition(5)
    for version in (0, 4, 11):
        assert table(history.state_at(changes, ["k"], version)) == states[version]
        moment = F.lit(START + timedelta(minutes=version, seconds=30)).cast("timestamp_ntz")
        assert table(history.state_at_time(changes, ["k"], moment)) == states[version]
    assert table(history.state_at(changes, ["k"])) == states[-1]


@pytest.mark.parametrize("seed", range(3))
def test_rollback_is_a_new_version(spark, seed):
    rows, states = walk(seed)
    changes = local_frame(spark, rows, SCHEMA)
    for to in (0, 5):
        back = history.rollback_changes(changes, ["k"], to, 12, F.lit(START).cast("timestamp_ntz"))
        changes_after = changes.unionByName(back)
        assert table(history.state_at(changes_after, ["k"])) == states[to]
        assert table(history.state_at(changes_after, ["k"], 11)) == states[11]


def test_many_rollbacks_in_a_row(spark):
    rows, states = walk(9, 4)
    changes = local_frame(spark, rows, SCHEMA)
    for version in range(4, 10):
        back = history.rollback_changes(changes, ["k"], version - 2, version, F.lit(START).cast("timestamp_ntz"))
        changes = local_frame(spark, [tuple(r) for r in changes.unionByName(back).collect()], SCHEMA)
        states.append(states[version - 2])
        assert table(history.state_at(changes, ["k"])) == states[-1]


def test_changes_between_versions(spark):
    rows, states = walk(4)
    got = [tuple(r) for r in history.changes_between(local_frame(spark, rows, SCHEMA), ["k"], 3, 9).collect()]
    want = []
    for version, _, _, key, value in rows:
        if not 3 < version <= 9:
            continue
        old, new = states[version - 1], states[version]
        if key not in new:
            want.append((version, "delete", key, old[key]))
        elif key in old:
            want += [(version, "update_before", key, old[key]), (version, "update_after", key, value)]
        else:
            want.append((version, "insert", key, value))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_history_and_ranges(spark):
    rows, states = walk(6)
    changes = local_frame(spark, rows, SCHEMA)
    got = {r["version"]: (r["rows_inserted"], r["rows_updated"], r["rows_deleted"]) for r in history.history_of(changes).collect()}
    for version in range(12):
        kinds = [r[2] for r in rows if r[0] == version]
        assert got[version] == tuple(kinds.count(k) for k in ("insert", "update", "delete"))
    ranges = history.valid_ranges(changes, ["k"]).collect()
    for version in range(12):
        valid = {r["k"]: r["v"] for r in ranges if r["version"] <= version and (r["until"] is None or version < r["until"])}
        assert valid == states[version]


def test_plain_rows_are_refused(spark):
    with pytest.raises(SchemaMismatch):
        history.state_at(spark.range(3), ["id"])


@pytest.mark.parametrize("span", [10_000, 3])
def test_spans_of_versions_change_nothing(spark, monkeypatch, span):
    """One key has a change in almost every version; in small spans no task sees all of them."""
    monkeypatch.setattr(history, "SPAN", span)
    rows, states = walk(11, 20)
    rows += [(v, START, "insert" if v == 0 else "update", None, v) for v in range(20)]  # a null key is a key
    states = [{**s, None: v} for v, s in enumerate(states)]
    changes = local_frame(spark, rows, SCHEMA).repartition(4)
    ranges = history.valid_ranges(changes, ["k"]).collect()
    for version in range(20):
        valid = {r["k"]: r["v"] for r in ranges if r["version"] <= version and (r["until"] is None or version < r["until"])}
        assert valid == states[version]
    got = [tuple(r) for r in history.changes_between(changes, ["k"], 2, 17).collect()]
    want = []
    for version, _, operation, key, value in rows:
        if 2 < version <= 17:
            old = states[version - 1]
            if operation == "delete":
                want.append((version, "delete", key, old[key]))
            elif key in old:
                want += [(version, "update_before", key, old[key]), (version, "update_after", key, value)]
            else:
                want.append((version, "insert", key, value))
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("span", [10_000, 4])
def test_totals_at_every_version(spark, monkeypatch, span):
    monkeypatch.setattr(history, "SPAN", span)
    rows, states = walk(13, 16)
    changes = local_frame(spark, rows, SCHEMA).repartition(4)
    totals = history.totals_by_version(changes, ["k"], {"total": F.col("v"), "squares": F.col("v") * F.col("v")}, {"n_values": "v"})
    got = {r["version"]: (r["n_rows"], r["total"], r["squares"], r["n_values"]) for r in totals.collect()}
    for version, state in enumerate(states):
        known = [v for v in state.values() if v is not None]
        assert got[version] == (len(state), sum(known), sum(v * v for v in known), len(set(known)))


def test_totals_shuffle_changes_and_not_the_versions_they_live(spark):
    rows = local_frame(spark, [(0, START, "insert", "a", 1), (1_000_000, START, "delete", "a", None)], SCHEMA)
    totals = history.totals_by_version(rows, ["k"], {"total": F.col("v")}, {"n": "v"})
    assert sorted(map(tuple, totals.collect())) == [(0, 1, 1, 1), (1_000_000, 0, 0, 0)]
    assert "sequence(" not in totals._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("a", "b"), [(2, 15), (15, 2), (7, 7), (-1, 9)])
def test_net_changes_with_a_third_of_the_changes_in_one_key(spark, a, b):
    rows, states = walk(17, 16)
    old, new = (states[v] if v >= 0 else {} for v in (a, b))
    want = [("delete", k, old[k]) for k in old.keys() - new.keys()] + [("insert", k, new[k]) for k in new.keys() - old.keys()]
    for k in old.keys() & new.keys():
        if old[k] != new[k]:
            want += [("update_before", k, old[k]), ("update_after", k, new[k])]
    net = history.net_changes(local_frame(spark, rows, SCHEMA).repartition(4), ["k"], a, b)
    assert sorted(map(tuple, net.collect()), key=str) == sorted(want, key=str)
    assert "Window" not in net._jdf.queryExecution().executedPlan().toString()


def test_the_last_of_a_thousand_versions_needs_no_change_before_the_snapshot(spark, tmp_path):
    changes = spark.range(4000).select(
        (F.col("id") / 4).cast("long").alias("version"), F.lit(START).cast("timestamp_ntz").alias("committed_at"),
        F.lit("update").alias("operation"), (F.col("id") % 37).cast("string").alias("k"), F.col("id").alias("v"),
    )
    old, new = changes.where("version <= 990"), changes.where("version > 990")
    for name, part in (("old", old), ("new", new)):
        part.coalesce(1).write.parquet(str(tmp_path / "changes" / f"part={name}"))
    stored = spark.read.schema(changes.schema).parquet(str(tmp_path / "changes"))
    for version in (400, 990):
        history.take_snapshot(stored, ["k"], version, str(tmp_path / "states"))
    states = spark.read.parquet(str(tmp_path / "states"))
    want = table(history.state_at(changes, ["k"], 999))
    state = history.state_from_snapshot(states, stored, ["k"], version=999)
    scans = state._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(version,990)" in scans and "LessThanOrEqual(version,999)" in scans
    assert table(state) == want
    # Readable with the old changes gone, but for a version before every snapshot.
    kept = spark.read.schema(changes.schema).parquet(str(tmp_path / "changes" / "part=new"))
    assert table(history.state_from_snapshot(states, kept, ["k"], version=999)) == want
    assert table(history.state_from_snapshot(states, stored, ["k"], version=10)) == table(history.state_at(changes, ["k"], 10))
    at = history.state_from_snapshot(states, stored, ["k"], moment=F.lit(START).cast("timestamp_ntz"))
    assert table(at) == want


def test_a_state_partitioned_by_version_is_pruned(spark, medium, tmp_path):
    orders = spark.read.parquet(f"{medium}/orders.parquet").select("o_orderkey", "o_totalprice")
    for version in range(3):
        history.as_changes(orders, "update", version, F.lit(START)).drop("version").write.parquet(str(tmp_path / f"c/version={version}"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    history.take_snapshot(stored, ["o_orderkey"], 1, str(tmp_path / "s"))
    state = history.state_from_snapshot(spark.read.parquet(str(tmp_path / "s")), stored, ["o_orderkey"], version=2)
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan and "> 1)" in plan
    assert state.count() == orders.count()
