"""Queries over orders that keep every version, and over events as changes of their users."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators import history
from windrow.operators.changes import SchemaMismatch, append_merge_schema, append_strict
from windrow.operators.summaries import exact_sum
from windrow.plans.inputs import load
from windrow.plans.registry import query
from windrow.session import scratch_dir
from windrow.sources.writers import write_parquet

KEY = ["o_orderkey"]

# The walk: orders are created; five commits add copies of the orders of one priority, one those
# of status P; cheap orders are deleted; open ones change; a batch is merged; rows with a new
# column are appended.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SHIFT, CHEAP, NEW_PRICE, RAISE = 10_000_000_000, 50_000, 2700, 1000
COMMITS = 11


def _commit_time(version: int):
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.expr(f"INTERVAL {version} MINUTES")


def _copies(orders: DataFrame, number: int, test) -> DataFrame:
    return orders.where(test).withColumn("o_orderkey", F.col("o_orderkey") + number * SHIFT)


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The walk over all orders as one change table."""
    orders = load(spark, sf_dir, "orders")
    commits = [(0, "insert", orders)]
    for number, priority in enumerate(PRIORITIES, 1):
        commits.append((number, "insert", _copies(orders, number, F.col("o_orderpriority") == priority)))
    commits.append((6, "insert", _copies(orders, 6, F.col("o_orderstatus") == "P")))
    inserted = reduce(DataFrame.unionByName, [rows for _, _, rows in commits])
    cheap = F.col("o_totalprice") < CHEAP
    commits.append((7, "delete", inserted.where(cheap)))
    left = inserted.where(~cheap)
    commits.append((8, "update", left.where(F.col("o_orderstatus") == "P").withColumn("o_totalprice", F.lit(float(NEW_PRICE)))))
    raised = orders.where(F.col("o_orderstatus") == "O").withColumn("o_totalprice", F.col("o_totalprice") + RAISE)
    commits.append((9, "update", raised.where(F.col("o_totalprice") >= CHEAP + RAISE)))
    commits.append((9, "insert", raised.where(F.col("o_totalprice") < CHEAP + RAISE)))
    again = orders.where(F.col("o_orderstatus") == "F").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    commits.append((9, "insert", again))
    changes = reduce(
        DataFrame.unionByName, [history.as_changes(rows, kind, v, _commit_time(v)) for v, kind, rows in commits]
    )
    wider = _copies(orders, 10, F.col("o_orderstatus") == "P").withColumn("amount", F.col("o_totalprice") / 2)
    return append_merge_schema(changes, history.as_changes(wider, "insert", 10, _commit_time(10)))


COLUMNS = "o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def shown(orders: DataFrame) -> DataFrame:
    """Orders with the date as text, as the answers have it."""
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


NO_AMOUNT = "CAST(NULL AS DOUBLE) AS amount"
_ADDED = " UNION ALL ".join(
    f"SELECT o_orderkey + {n} * {SHIFT} AS o_orderkey, {COLUMNS}, {n} AS added FROM orders WHERE "
    + (f"o_orderpriority = '{PRIORITIES[n - 1]}'" if n < 6 else "o_orderstatus = 'P'")
    for n in range(1, 7)
)

# The walk as SQL: one relation per version.
WALK = f"""ins AS (SELECT o_orderkey, {COLUMNS}, 0 AS added FROM orders UNION ALL {_ADDED}),
v6 AS (SELECT o_orderkey, {COLUMNS} FROM ins),
v7 AS (SELECT * FROM v6 WHERE NOT o_totalprice < {CHEAP}),
v8 AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN {NEW_PRICE}.0 ELSE o_totalprice END
    AS o_totalprice, o_orderdate, o_orderpriority FROM v7),
batch AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + {RAISE} AS o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT -o_orderkey - 1, {COLUMNS} FROM orders WHERE o_orderstatus = 'F'),
v9 AS (SELECT * FROM v8 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch) UNION ALL SELECT * FROM batch),
v10 AS (SELECT *, {NO_AMOUNT} FROM v9 UNION ALL
    SELECT o_orderkey + 10 * {SHIFT}, {COLUMNS}, o_totalprice / 2 FROM orders WHERE o_orderstatus = 'P')"""


def _version_sql(version: int) -> str:
    if version < 6:
        return f"SELECT o_orderkey, {COLUMNS} FROM ins WHERE added <= {version}"
    return f"SELECT * FROM v{version}"


# Answers show dates as text.
SHOWN = "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate)"


@query("clog_read_current", f"WITH {WALK} {SHOWN} FROM v10")
def clog_read_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change table stored as files and read by its path: the table as it is now."""
    path = scratch_dir(spark, "changes")
    write_parquet(order_changes(spark, sf_dir), path)
    return shown(history.state_at(spark.read.parquet(path), KEY))


@query("clog_overwrite", f"SELECT c_custkey + {SHIFT} AS o_orderkey, c_acctbal AS o_totalprice FROM customer")
def clog_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other rows in place of all: a commit that deletes every key and inserts the new rows."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    new = load(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + SHIFT).alias("o_orderkey"), F.col("c_acctbal").alias("o_totalprice")
    )
    first = history.as_changes(orders, "insert", 0, _commit_time(0))
    gone = history.as_changes(history.state_at(first, KEY), "delete", 1, _commit_time(1))
    return history.state_at(first.unionByName(gone).unionByName(history.as_changes(new, "insert", 1, _commit_time(1))), KEY)


@query("append_strict", "SELECT true AS refused, CAST(1 AS BIGINT) AS last_version, COUNT(*) * 2 AS n_rows FROM orders")
def append_strict_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with another schema are refused and make no version; fitting rows are added."""
    orders = load(spark, sf_dir, "orders")
    changes = history.as_changes(orders, "insert", 0, _commit_time(0))
    more = _copies(orders, 1, F.lit(True))
    changes = append_strict(changes, history.as_changes(more, "insert", 1, _commit_time(1)))
    try:
        changes = append_strict(changes, history.as_changes(more.withColumn("amount", F.lit(1.0)), "insert", 2, _commit_time(2)))
        refused = False
    except SchemaMismatch:
        refused = True
    last = changes.agg(F.max("version").alias("last_version"))
    rows = history.state_at(changes, KEY).agg(F.count(F.lit(1)).alias("n_rows"))
    return last.select(F.lit(refused).alias("refused"), "last_version", F.lit(None).cast("long").alias("n_rows")).unionByName(
        rows, allowMissingColumns=True
    ).agg(*[F.max(c).alias(c) for c in ("refused", "last_version", "n_rows")])


@query("reject_plain_change", "SELECT COUNT(*) AS n_rows, true AS refused FROM customer")
def reject_plain_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that keep no versions can't be asked for an old one."""
    customers = load(spark, sf_dir, "customer")
    try:
        history.state_at(customers, ["c_custkey"], 0)
        refused = False
    except SchemaMismatch:
        refused = True
    return customers.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(refused).alias("refused"))


@query("time_travel_v0", f"{SHOWN} FROM (SELECT o_orderkey, {COLUMNS}, {NO_AMOUNT} FROM orders)")
def time_travel_v0(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was created."""
    return shown(history.state_at(order_changes(spark, sf_dir), KEY, 0))


@query("time_travel_v9", f"WITH {WALK} {SHOWN}, {NO_AMOUNT} FROM v9")
def time_travel_v9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table just before its last commit, after deletes, updates and a merge."""
    return shown(history.state_at(order_changes(spark, sf_dir), KEY, 9))


# Fixed by the data: events of January 2024. Users are rows, signup to view change them, an error removes them.
EVENT_MOMENT = "2024-01-16 00:00:00"


@query(
    "time_travel_ts",
    f"""WITH last AS (SELECT user_id, max(event_id) AS event_id FROM events WHERE ts <= TIMESTAMP '{EVENT_MOMENT}' GROUP BY 1)
    SELECT e.user_id, e.value, e.props FROM events e JOIN last l ON e.event_id = l.event_id WHERE e.event_type <> 'error'""",
)
def time_travel_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as their events had left them at a moment."""
    gone = F.col("event_type") == "error"
    changes = load(spark, sf_dir, "events").select(
        F.col("event_id").alias("version"),
        F.col("ts").alias("committed_at"),
        F.when(gone, F.lit("delete")).otherwise(F.lit("update")).alias("operation"),
        "user_id", "value", "props",
    )
    return history.state_at_time(changes, ["user_id"], F.lit(EVENT_MOMENT).cast("timestamp_ntz"))


@query(
    "clog_history",
    f"""WITH {WALK}, cheap AS (SELECT o_orderkey FROM batch WHERE o_orderkey NOT IN (SELECT o_orderkey FROM v8))
    SELECT CAST(added AS BIGINT) AS version, COUNT(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
        CAST(0 AS BIGINT) AS rows_deleted FROM ins GROUP BY added
    UNION ALL SELECT 7, 0, 0, (SELECT COUNT(*) FROM v6) - (SELECT COUNT(*) FROM v7)
    UNION ALL SELECT 8, 0, (SELECT COUNT(*) FROM v7 WHERE o_orderstatus = 'P'), 0
    UNION ALL SELECT 9, (SELECT COUNT(*) FROM cheap), (SELECT COUNT(*) FROM batch) - (SELECT COUNT(*) FROM cheap), 0
    UNION ALL SELECT 10, (SELECT COUNT(*) FROM v10) - (SELECT COUNT(*) FROM v9), 0, 0""",
)
def clog_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per commit."""
    return history.history_of(order_changes(spark, sf_dir)).drop("committed_at")


@query(
    "clog_changes",
    f"""WITH {WALK}
    SELECT CAST(7 AS BIGINT) AS version, 'delete' AS change, o_orderkey, o_totalprice FROM v6 WHERE o_totalprice < {CHEAP}
    UNION ALL SELECT 8, 'update_before', o_orderkey, o_totalprice FROM v7 WHERE o_orderstatus = 'P'
    UNION ALL SELECT 8, 'update_after', o_orderkey, o_totalprice FROM v8 WHERE o_orderstatus = 'P'
    UNION ALL SELECT 9, 'update_before', o_orderkey, o_totalprice FROM v8 WHERE o_orderkey IN (SELECT o_orderkey FROM batch)
    UNION ALL SELECT 9, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM v8) THEN 'update_after' ELSE 'insert' END,
        o_orderkey, o_totalprice FROM batch""",
)
def clog_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the delete, the update and the merge did, row by row."""
    changes = history.changes_between(order_changes(spark, sf_dir), KEY, 6, 9)
    return changes.select("version", "change", "o_orderkey", "o_totalprice")


@query("clog_rollback", f"WITH {WALK} {SHOWN}, {NO_AMOUNT} FROM v6")
def clog_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back to the state before the delete, as a new version."""
    changes = order_changes(spark, sf_dir)
    back = history.rollback_changes(changes, KEY, 6, COMMITS, _commit_time(COMMITS))
    return shown(history.state_at(changes.unionByName(back), KEY))


@query(
    "report_at_version",
    f"WITH {WALK} SELECT o_orderpriority, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM v7 GROUP BY 1",
)
def report_at_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An old report from the version it was made of."""
    old = history.state_at(order_changes(spark, sf_dir), KEY, 7)
    return old.groupBy("o_orderpriority").agg(exact_sum("o_totalprice").alias("total"))


@query(
    "clog_full_chain",
    f"WITH {WALK} "
    + " UNION ALL ".join(
        f"SELECT CAST({v} AS BIGINT) AS version, COUNT(*) AS n_rows, COUNT(DISTINCT o_custkey) AS n_customers, "
        f"CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM ({_version_sql(v)})"
        for v in range(COMMITS)
    ),
)
def clog_full_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals at every version of the walk, from what each change adds and takes away."""
    totals = history.totals_by_version(
        order_changes(spark, sf_dir), KEY, {"total": F.col("o_totalprice").cast("decimal(18,2)")}, {"n_customers": "o_custkey"}
    )
    return totals.withColumn("total", F.col("total").cast("double"))


@query(
    "clog_net_changes",
    f"""WITH {WALK}, pairs AS (
        SELECT a.o_orderkey AS before_key, b.o_orderkey AS after_key, a.o_totalprice AS before_price, b.o_totalprice AS after_price,
            a.o_orderstatus AS before_status, b.o_orderstatus AS after_status,
            ({", ".join("a." + c.strip() for c in COLUMNS.split(","))}) IS DISTINCT FROM
            ({", ".join("b." + c.strip() for c in COLUMNS.split(","))}) AS other
        FROM v6 AS a FULL JOIN v10 AS b ON a.o_orderkey = b.o_orderkey)
    SELECT 'delete' AS change, before_key AS o_orderkey, before_price AS o_totalprice, before_status AS o_orderstatus
    FROM pairs WHERE after_key IS NULL
    UNION ALL SELECT 'insert', after_key, after_price, after_status FROM pairs WHERE before_key IS NULL
    UNION ALL SELECT 'update_before', before_key, before_price, before_status FROM pairs
        WHERE before_key IS NOT NULL AND after_key IS NOT NULL AND other
    UNION ALL SELECT 'update_after', after_key, after_price, after_status FROM pairs
        WHERE before_key IS NOT NULL AND after_key IS NOT NULL AND other""",
)
def clog_net_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the last state differs from the one before the delete, whatever happened in between."""
    net = history.net_changes(order_changes(spark, sf_dir), KEY, 6, 10)
    return net.select("change", "o_orderkey", "o_totalprice", "o_orderstatus")


@query("time_travel_snapshot", f"WITH {WALK} {SHOWN}, {NO_AMOUNT} FROM v9")
def time_travel_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version read from the nearest of two snapshots and the changes after it."""
    folder = scratch_dir(spark, "snapshots")
    changes = order_changes(spark, sf_dir)
    changes.write.partitionBy("version").parquet(f"{folder}/changes")
    stored = spark.read.parquet(f"{folder}/changes").withColumn("version", F.col("version").cast("long"))
    for version in (3, 7):
        history.take_snapshot(stored, KEY, version, f"{folder}/states")
    states = spark.read.parquet(f"{folder}/states")
    return shown(history.state_from_snapshot(states, stored, KEY, version=9))


@query(
    "versioned_orders",
    """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END
    AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders WHERE NOT o_totalprice < 50000""",
)
def versioned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large table through delete and update, each commit made from the state before it."""
    orders = load(spark, sf_dir, "orders")
    changes = history.as_changes(orders, "insert", 0, _commit_time(0))
    cheap = history.state_at(changes, KEY).where(F.col("o_totalprice") < 50_000)
    changes = changes.unionByName(history.as_changes(cheap, "delete", 1, _commit_time(1)))
    path = scratch_dir(spark, "changes")
    write_parquet(changes, path)
    changes = spark.read.parquet(path)
    dearer = history.state_at(changes, KEY).where(F.col("o_orderstatus") == "P").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return shown(history.state_at(changes.unionByName(history.as_changes(dearer, "update", 2, _commit_time(2))), KEY))
