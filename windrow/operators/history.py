"""Tables that keep every version, as functions over an ordinary table of changes.

A row of the change table says what happened to one row of the table: ``version`` and
``committed_at`` of the commit, ``operation`` (insert, update or delete), the row's key, and
the row as it is from then on; a delete needs its key only. A commit changes a row once at most.
Adding to the table's history is appending to the change table, in whatever format holds it.
Any state is one aggregation by key, in partial steps, so a row changed very often is no hot key.
Where changes of a key are set beside one another, they meet in spans of versions: a key has at most
``SPAN`` changes in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from windrow.operators.changes import SchemaMismatch

META = ("version", "committed_at", "operation")

# Versions whose changes of one key are looked at in one task.
SPAN = 10_000


def as_changes(rows: DataFrame, operation: str, version: int, committed_at: Column) -> DataFrame:
    """Rows as the changes of one commit."""
    return rows.select(
        F.lit(version).cast("long").alias("version"), committed_at.alias("committed_at"), F.lit(operation).alias("operation"), "*"
    )


def check_changes(changes: DataFrame, keys: Sequence[str]) -> None:
    """Refuse a frame that keeps no versions: plain rows can't be asked for an old state."""
    lacking = [c for c in (*META, *keys) if c not in changes.columns]
    if lacking:
        raise SchemaMismatch(f"a change table needs the columns {lacking}")


def _latest(changes: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    payload = [c for c in changes.columns if c not in (*META, *keys)]
    last = F.max_by(F.struct("operation", *payload), order).alias("_last")
    live = changes.groupBy(*keys).agg(last).where(F.col("_last.operation") != "delete")
    return live.select(*keys, *[F.col(f"_last.`{c}`").alias(c) for c in payload])


def state_at(changes: DataFrame, keys: Sequence[str], version: int | None = None) -> DataFrame:
    """The table as of a version, or as it is now."""
    check_changes(changes, keys)
    known = changes if version is None else changes.where(F.col("version") <= version)
    return _latest(known, keys, "version")


def state_at_time(changes: DataFrame, keys: Sequence[str], moment: datetime | Column) -> DataFrame:
    """The table as of the last commit at or before a moment."""
    check_changes(changes, keys)
    return _latest(changes.where(F.col("committed_at") <= moment), keys, "version")


def payload_of(changes: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in changes.columns if c not in (*META, *keys)]


def _row(names: Sequence[str], of: str = "") -> Column:
    return F.struct(*[F.col(f"{of}`{c}`").alias(c) for c in names])


def neighbour(
    changes: DataFrame, keys: Sequence[str], value: Column, name: str, *, back: bool = True, bounds: tuple[int, int] | None = None
) -> DataFrame:
    """Each change with a value of the change of its key before it (or after it); null where there is none.

    ``bounds`` are the first and the last version, looked up where they are not given. Within a span
    of versions this is one window; of every span, one value per key goes on to the next one.
    """
    if bounds is None:
        bounds = changes.agg(F.min("version"), F.max("version")).first()
    order = F.col("version") if back else F.col("version").desc()
    if bounds[0] is None or bounds[1] - bounds[0] < SPAN:
        return changes.withColumn(name, F.lag(value).over(Window.partitionBy(*keys).orderBy(order)))
    spans = changes.withColumn("_span", F.floor((F.col("version") - bounds[0]) / SPAN))
    inside = spans.withColumn(name, F.lag(value).over(Window.partitionBy(*keys, "_span").orderBy(order)))
    pick = F.max_by if back else F.min_by
    ends = spans.groupBy(F.struct(*keys).alias("_key"), F.col("_span").alias("_of")).agg(pick(value, "version").alias("_end"))
    span_order = F.col("_of") if back else F.col("_of").desc()
    beyond = ends.withColumn("_beyond", F.lag("_end").over(Window.partitionBy("_key").orderBy(span_order)))
    same = (F.struct(*keys) == F.col("_key")) & (F.col("_span") == F.col("_of"))
    both = inside.join(beyond.where(F.col("_beyond").isNotNull()), same, "left")
    return both.withColumn(name, F.coalesce(name, "_beyond")).select(*changes.columns, name)


def _said(change: str, row: Column) -> Column:
    return F.struct(F.lit(change).alias("change"), row.alias("row"))


def _transition(held: Column, old: Column, holds: Column, new: Column) -> Column:
    """What became of a row: insert, delete, or how an updated row was before and after."""
    return (
        F.when(~holds & held, F.array(_said("delete", old)))
        .when(holds & held, F.array(_said("update_before", old), _said("update_after", new)))
        .when(holds, F.array(_said("insert", new)))
    )


def changes_between(changes: DataFrame, keys: Sequence[str], after: int, upto: int) -> DataFrame:
    """What commits after one version up to another did to each row, rows before and after.

    Every change has its ``change``: insert, delete, update_before or update_after. The row
    before a change is the row that the last commit on its key left.
    """
    check_changes(changes, keys)
    payload = payload_of(changes, keys)
    columns = ["version", "operation", *keys, *payload]
    now = F.struct("operation", *[F.col(f"`{c}`") for c in payload])
    # One row per key for all that was before, in partial steps.
    start = changes.where(F.col("version") <= after).groupBy(*keys).agg(F.max_by(now, "version").alias("_now"))
    start = start.select(F.lit(after).cast("long").alias("version"), "_now.operation", *keys, *[F.col(f"_now.`{c}`") for c in payload])
    later = changes.where((F.col("version") > after) & (F.col("version") <= upto)).select(columns)
    steps = neighbour(start.unionByName(later), keys, now, "_before", bounds=(after, upto)).where(F.col("version") > after)
    held = F.coalesce(F.col("_before.operation") != "delete", F.lit(False))
    parts = _transition(held, _row(payload, "_before."), F.col("operation") != "delete", _row(payload))
    return steps.select("version", *keys, F.explode(parts).alias("_said")).select(
        "version", "_said.change", *keys, *[F.col(f"_said.row.`{c}`").alias(c) for c in payload]
    )


def net_changes(changes: DataFrame, keys: Sequence[str], a: int, b: int) -> DataFrame:
    """What differs between the states of two versions, however often a row changed in between.

    Rows are insert, delete, update_before or update_after, as seen from ``a``; ``a`` may be the later
    one. One aggregation in partial steps: of each key, two rows are kept. A row that is the
    same in both states is not told.
    """
    check_changes(changes, keys)
    payload = payload_of(changes, keys)
    now = F.struct("operation", *[F.col(f"`{c}`") for c in payload])

    def last(version: int) -> Column:
        known = F.col("version") <= version
        return F.max_by(F.when(known, now), F.when(known, F.col("version")))

    ends = changes.where(F.col("version") <= max(a, b)).groupBy(*keys).agg(last(a).alias("_a"), last(b).alias("_b"))
    held, holds = (F.coalesce(F.col(f"{c}.operation") != "delete", F.lit(False)) for c in ("_a", "_b"))
    old, new = _row(payload, "_a."), _row(payload, "_b.")
    told = ends.where(~(held & holds & old.eqNullSafe(new))).select(*keys, F.explode(_transition(held, old, holds, new)).alias("_said"))
    return told.select("_said.change", *keys, *[F.col(f"_said.row.`{c}`").alias(c) for c in payload])


def totals_by_version(
    changes: DataFrame, keys: Sequence[str], sums: Mapping[str, Column], distinct: Mapping[str, str] | None = None
) -> DataFrame:
    """Per version: ``n_rows``, sums of expressions over the rows, and numbers of distinct values of columns.

    Every change adds its row and takes away the one before it, so what is shuffled follows the
    changes, not how long rows lived. Sums are exact for integers and decimals; nulls count as 0 and,
    in distinct values, not at all. Values that appear and go are counted from one row per value
    and version. The running totals are taken over one row per version.
    """
    check_changes(changes, keys)
    distinct = distinct or {}
    terms = {f"_sum{i}": term for i, term in enumerate(sums.values())}
    values = {f"_value{i}": F.col(column) for i, column in enumerate(distinct.values())}
    narrow = changes.select("version", "operation", *keys, *[c.alias(n) for n, c in {**terms, **values}.items()])
    now = F.struct("operation", *terms, *values)
    steps = neighbour(narrow, keys, now, "_before")
    live = F.col("operation") != "delete"
    was = F.coalesce(F.col("_before.operation") != "delete", F.lit(False))
    zero = F.lit(0)

    def change(column: str) -> Column:
        return F.coalesce(F.when(live, F.col(column)), zero) - F.coalesce(F.when(was, F.col(f"_before.{column}")), zero)

    deltas = steps.groupBy("version").agg(
        F.sum(live.cast("long") - was.cast("long")).alias("n_rows"), *[F.sum(change(c)).alias(n) for n, c in zip(sums, terms)]
    )
    names = ["n_rows", *sums, *distinct]
    for name, column in zip(distinct, values):
        pair = F.array(
            F.struct(F.when(live, F.col(column)).alias("value"), F.lit(1).alias("sign")),
            F.struct(F.when(was, F.col(f"_before.{column}")).alias("value"), F.lit(-1).alias("sign")),
        )
        moved = steps.select("version", F.explode(pair).alias("_m")).where(F.col("_m.value").isNotNull())
        moves = moved.groupBy(F.col("_m.value").alias("value"), "version").agg(F.sum("_m.sign").alias("sign")).where("sign != 0")
        by_value = Window.partitionBy("value").orderBy("version")
        held = F.sum("sign").over(by_value.rowsBetween(Window.unboundedPreceding, 0))
        seen = moves.withColumn("held", held)
        turn = F.when(F.col("held") == F.col("sign"), 1).when(F.col("held") == 0, -1)  # the first of its rows, or the last gone
        turns = seen.select("version", turn.alias("turn")).where("turn is not null")
        deltas = deltas.join(turns.groupBy("version").agg(F.sum("turn").alias(name)), "version", "left")
    so_far = Window.orderBy("version").rowsBetween(Window.unboundedPreceding, 0)
    return deltas.select("version", *[F.sum(F.coalesce(F.col(n), zero)).over(so_far).alias(n) for n in names])


# Snapshots -------------------------------------------------------------------------------


def take_snapshot(changes: DataFrame, keys: Sequence[str], version: int, folder: str) -> None:
    """Store the state of a version in a folder of snapshots, as the folder ``version=N`` there.

    The rows keep their version and its time, so they can stand for all changes up to it.
    """
    known = changes.where(F.col("version") <= version)
    last = known.agg(F.max("committed_at")).first()[0]
    kind = changes.schema["committed_at"].dataType
    rows = state_at(changes, keys, version).withColumn("committed_at", F.lit(last).cast(kind))
    rows.write.parquet(f"{folder.rstrip('/')}/version={version}")


def state_from_snapshot(
    snapshots: DataFrame, changes: DataFrame, keys: Sequence[str], *, version: int | None = None, moment: datetime | Column | None = None
) -> DataFrame:
    """The table as of a version or moment, from the nearest snapshot before it and the changes after that.

    ``snapshots`` is the folder of snapshots, read. Changes up to the snapshot are not read where the
    change table is partitioned by version or has its statistics. Without a snapshot that is old
    enough, the state comes from the changes alone.
    """
    check_changes(changes, keys)

    def upto(rows: DataFrame) -> DataFrame:
        if version is not None:
            rows = rows.where(F.col("version") <= version)
        return rows if moment is None else rows.where(F.col("committed_at") <= moment)

    nearest = upto(snapshots).agg(F.max("version")).first()[0]
    if nearest is None:
        return _latest(upto(changes), keys, "version")
    base = snapshots.where(F.col("version") == nearest).withColumn("operation", F.lit("insert"))
    later = upto(changes.where(F.col("version") > nearest))
    return _latest(base.select([F.col(f"`{f.name}`").cast(f.dataType) for f in changes.schema]).unionByName(later), keys, "version")


def rollback_changes(changes: DataFrame, keys: Sequence[str], to: int, version: int, committed_at: Column) -> DataFrame:
    """The changes that, appended as a new version, bring back the state of an old one.

    Only keys changed since are written: as they were then, or as deleted.
    """
    check_changes(changes, keys)
    since = changes.groupBy(F.struct(*keys).alias("_key")).agg(F.max("version").alias("_last")).where(F.col("_last") > to)
    touched = since.select("_key.*", F.lit(True).alias("_touched"))
    then = state_at(changes, keys, to).withColumn("_held", F.lit(True))
    rows = touched.join(then, list(keys), "left").drop("_touched")
    operation = F.when(F.col("_held"), F.lit("update")).otherwise(F.lit("delete"))
    back = as_changes(rows, "update", version, committed_at).withColumn("operation", operation).drop("_held")
    return back.select(*changes.columns)


def history_of(changes: DataFrame) -> DataFrame:
    """One row per commit: when, and the rows inserted, updated and deleted."""
    counts = [F.count_if(F.col("operation") == o).alias(f"rows_{o}d") for o in ("update", "delete")]
    return changes.groupBy("version").agg(
        F.min("committed_at").alias("committed_at"), F.count_if(F.col("operation") == "insert").alias("rows_inserted"), *counts
    )


def valid_ranges(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row with the versions it was valid in: from ``version`` to before ``until`` (null: now)."""
    check_changes(changes, keys)
    ranged = neighbour(changes, keys, F.col("version"), "until", back=False)
    return ranged.where(F.col("operation") != "delete").drop("operation", "committed_at")
