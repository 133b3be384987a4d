"""Queries that insert, delete, update and merge on plain DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators import changes
from windrow.plans.functions import scaled_loans
from windrow.plans.inputs import LOANS_SQL, fraction_sql, load, loans_by_state, view_name
from windrow.plans.registry import query
from windrow.session import scratch_dir
from windrow.sources.readers import local_frame

# The rows merged into the loans, with the states' stand-in keys.
MERGE_ROWS = [("7", 0.0), ("3", 2500.0), ("99", 0.0)]
MERGE_SQL = "SELECT * FROM (VALUES ('7', 0), ('3', 2500), ('99', 0)) AS m(addr_state, \"count\")"


def merge_source(spark: SparkSession) -> DataFrame:
    return local_frame(spark, MERGE_ROWS, "addr_state string, count double")


def order_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders, and a batch that raises the price of open ones and adds the finished ones anew."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    raised = orders.filter(F.col("o_orderstatus") == "O").withColumn("o_totalprice", F.col("o_totalprice") + 1000)
    again = orders.filter(F.col("o_orderstatus") == "F").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return orders, raised.unionByName(again)


ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
ORDER_BATCH = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1000 AS o_totalprice FROM orders
    WHERE o_orderstatus = 'O' UNION ALL
    SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'"""


@query("upsert_new_rows", f"SELECT * FROM ({ORDER_BATCH}) WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def upsert_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.new_rows(*order_batch(spark, sf_dir), ["o_orderkey"])


@query("upsert_replaced_rows", f"{ORDERS} WHERE o_orderkey IN (SELECT o_orderkey FROM ({ORDER_BATCH}))")
def upsert_replaced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.replaced_rows(*order_batch(spark, sf_dir), ["o_orderkey"])


@query("upsert_unaffected_rows", f"{ORDERS} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({ORDER_BATCH}))")
def upsert_unaffected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.unaffected_rows(*order_batch(spark, sf_dir), ["o_orderkey"])


@query(
    "upsert_rewrite",
    f"{ORDERS} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({ORDER_BATCH})) UNION ALL ({ORDER_BATCH})",
)
def upsert_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert for plain files: parts, union, new folder, swapped name."""
    view = view_name("orders")
    orders, batch = order_batch(spark, sf_dir)
    changes.upsert_rewrite(orders, batch, ["o_orderkey"], scratch_dir(spark, "upsert"), view)
    result = spark.table(view)
    spark.catalog.dropTempView(view)
    return result


@query(
    "merge_upsert",
    f"""SELECT addr_state, "count" FROM ({LOANS_SQL}) WHERE addr_state NOT IN ('7', '3', '99')
    UNION ALL SELECT addr_state, CAST("count" AS BIGINT) FROM ({MERGE_SQL})""",
)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update on a matching key, insert otherwise; the source's doubles become the target's type."""
    return changes.merge_upsert(loans_by_state(spark, sf_dir), merge_source(spark), ["addr_state"])


@query(
    "merge_upsert_orders",
    f"{ORDERS} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({ORDER_BATCH})) UNION ALL ({ORDER_BATCH})",
)
def merge_upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a large source."""
    orders, batch = order_batch(spark, sf_dir)
    return changes.merge_upsert(orders, batch, ["o_orderkey"])


@query(
    "merge_laid_out",
    f"{ORDERS} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({ORDER_BATCH})) UNION ALL ({ORDER_BATCH})",
)
def merge_laid_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into orders laid out by key, which the merge does not shuffle."""
    orders, batch = order_batch(spark, sf_dir)
    name = view_name("orders")
    stored = changes.lay_out(orders, name, scratch_dir(spark, "laid-out"), ["o_orderkey"], 8)
    merged = changes.merge_laid_out(stored, batch, ["o_orderkey"], 8)
    spark.sql(f"DROP TABLE {name}")  # its files stay, and the result reads them
    return merged


@query(
    "insert_values",
    f"""{LOANS_SQL} UNION ALL SELECT '7', 450 FROM range(6)""",
)
def insert_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six equal literal rows: all are kept."""
    return changes.insert_rows(loans_by_state(spark, sf_dir), [("7", 450)] * 6)


@query(
    "delete_where",
    "SELECT o_orderkey, balance FROM (SELECT o_orderkey, CASE WHEN o_totalprice >= 50000 THEN o_totalprice END AS balance "
    "FROM orders) WHERE balance IS NULL OR NOT balance < 150000",
)
def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows go where the test is true; a null keeps its row."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("balance")
    )
    return changes.delete_where(orders, F.col("balance") < 150000)


@query(
    "update_where",
    """SELECT o_orderkey, CASE WHEN balance < 150000 THEN 2700.0 ELSE balance END AS balance,
    CASE WHEN balance < 150000 THEN balance * 2 ELSE before END AS before FROM (
    SELECT o_orderkey, CASE WHEN o_totalprice >= 50000 THEN o_totalprice END AS balance, o_totalprice AS before FROM orders)""",
)
def update_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every new value sees the row as it was."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("balance"),
        F.col("o_totalprice").alias("before"),
    )
    return changes.update_where(
        orders, F.col("balance") < 150000, {"balance": F.lit(2700), "before": F.col("balance") * 2}
    )


U = fraction_sql(10, "addr_state")


@query(
    "append_merge_schema",
    f"""SELECT addr_state, "count", CAST(NULL AS DOUBLE) AS amount FROM ({LOANS_SQL}) UNION ALL
    SELECT addr_state, CAST(trunc({U} * "count") AS BIGINT), {U} * 10000 * "count" FROM ({LOANS_SQL})""",
)
def append_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a new column: the old rows have null there."""
    loans = loans_by_state(spark, sf_dir)
    return changes.append_merge_schema(loans, scaled_loans(loans))
