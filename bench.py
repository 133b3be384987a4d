"""

``BENCH_SF_DIR`` names the tables (default /root/testdata/sf0.1), ``BENCH_CPUS`` the
cores. One warm-up, then the median of ``BENCH_RUNS`` runs (5), alike for every job; results are forced with a
``noop`` write, so no column is pruned away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from windrow.operators import changes, groups, history, models  # noqa: E402
from windrow.operators.sampling import hash_split  # noqa: E402
from windrow.plans import QUERIES  # noqa: E402
from windrow.plans.groups import half, half_by_row  # noqa: E402
from windrow.plans.inputs import FLIGHT_FIELDS, flights_file, load  # noqa: E402
from windrow.plans.models import december  # noqa: E402
from windrow.session import open_session, scratch_dir  # noqa: E402
from windrow.sources import writers  # noqa: E402
from windrow.sources.readers import read_csv, sequence_ids  # noqa: E402
from windrow.streaming.folders import add_batch, read_batches, stream_batches  # noqa: E402
from windrow.streaming.running import refresh_result, running_sum  # noqa: E402

HEADLINE = (
    "group_count_desc distance_by_carrier_day chart_counts pivot_count top10_sum top10_delays arrange_asc "
    "filter_conjunction hash_split stratified_sample read_json csv_roundtrip mutate_date_parts "
    "jitter_keyed carrier_newcol carrier_newcol_udf supplier_lines_udf udf_partition_half udf_variants_agree map_elements "
    "group_ols_tidy group_ols_udf global_ols upsert_rewrite merge_upsert_orders delete_where update_where "
    "versioned_orders clog_full_chain stream_sum_by_key stream_sink"
).split()


def force(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(job: Callable[[], object], runs: int) -> float:
    job()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        job()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def half_jobs(spark: SparkSession) -> dict[str, Callable[[], object]]:
    """P1: x / 2 and a count of the results, three ways. The results are compared."""

    def variants(n: int) -> dict[str, DataFrame]:
        ids = sequence_ids(spark, n)
        return {
            "native": ids.select((F.col("id") / 2).alias("id")),
            "arrow": groups.apply_partitions(ids, half, "id double"),
            "row": ids.select(half_by_row(F.col("id").cast("double")).alias("id")),
        }

    sums = {k: tuple(v.agg(F.count("id"), F.sum("id")).first()) for k, v in variants(100_000).items()}
    assert len(set(sums.values())) == 1, sums
    jobs = {}
    for n in (100_000, 1_000_000, 10_000_000):
        for kind, df in variants(n).items():
            jobs[f"p1_half_{kind}_{n}"] = lambda df=df: force(df)
    return jobs


def table_jobs(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], object]]:
    """P2 regression, P3 states after many commits, P4 stream and batch, P5 merges, text files."""
    jobs: dict[str, Callable[[], object]] = {}
    fit = ("origin", "arr_delay", "dep_delay")
    smaller = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    for name, folder in (("", sf_dir), ("_sf0.01", smaller)):
        jobs[f"p2_group_ols_native{name}"] = lambda d=folder: force(models.group_ols(december(spark, d), *fit))
        jobs[f"p2_group_ols_function{name}"] = lambda d=folder: force(models.group_ols_by_function(december(spark, d), *fit))

    customers = load(spark, sf_dir, "customer")
    first = history.as_changes(customers, "insert", 0, F.current_timestamp())
    for commits in (10, 100):
        folder = scratch_dir(spark, "p3")
        first.write.parquet(folder)
        raised = customers.withColumn("version", F.pmod(F.xxhash64("c_custkey"), F.lit(commits)) + 1)
        raised = raised.withColumns({"c_acctbal": F.col("c_acctbal") + 1, "operation": F.lit("update"), "committed_at": F.current_timestamp()})
        raised.select(first.columns).repartition(commits, "version").write.mode("append").parquet(folder)
        stored = spark.read.parquet(folder)
        jobs[f"p3_state_after_{commits}_commits"] = lambda t=stored: force(history.state_at(t, ["c_custkey"]))
    packed = scratch_dir(spark, "p3-packed")
    writers.compact_files(spark, folder, packed)
    jobs["p3_state_compacted"] = lambda: force(history.state_at(spark.read.parquet(packed), ["c_custkey"]))

    events = load(spark, sf_dir, "events").select("user_id", F.round(F.col("value") * 100).cast("long").alias("cents"))
    for files in (10, 100):
        folder = scratch_dir(spark, "p4")
        add_batch(events.repartition(files), folder, "all")

        def streamed(folder=folder) -> None:
            root = scratch_dir(spark, "p4-run")
            sums = running_sum(stream_batches(spark, folder), "user_id", "cents", "cents")
            force(refresh_result(sums, f"{root}/r", f"{root}/c"))

        jobs[f"p4_stream_{files}_files"] = streamed
        jobs[f"p4_batch_{files}_files"] = lambda f=folder: force(running_sum(read_batches(spark, f), "user_id", "cents", "cents"))

    csv = scratch_dir(spark, "csv")
    jobs["csv_write_27_columns"] = lambda: writers.write_csv(flights_file(spark, sf_dir), scratch_dir(spark, "csv"))
    writers.write_csv(flights_file(spark, sf_dir), csv)
    jobs["csv_read_27_columns"] = lambda: force(read_csv(spark, csv, schema=FLIGHT_FIELDS, missing="NA"))

    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    for percent in (1, 50):
        part, _ = hash_split(orders, [percent, 100 - percent], [F.col("o_orderkey")], 1)
        staged = scratch_dir(spark, "p5")
        part.withColumn("o_totalprice", F.col("o_totalprice") + 1).write.parquet(staged)
        source = spark.read.parquet(staged)
        flagged = source.withColumnsRenamed({"o_custkey": "c", "o_totalprice": "p"}).withColumn("hit", F.lit(True))
        outer = orders.join(flagged, "o_orderkey", "full").select(
            "o_orderkey",
            F.when(F.col("hit"), F.col("c")).otherwise(F.col("o_custkey")).alias("o_custkey"),
            F.when(F.col("hit"), F.col("p")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        )
        name = f"windrow_bench_{percent}"
        stored = changes.lay_out(orders, name, scratch_dir(spark, "p5-laid-out"), ["o_orderkey"], 8)
        spark.sql(f"DROP TABLE {name}")
        jobs[f"p5_merge_laid_out_{percent}pc"] = lambda t=stored, s=source: force(changes.merge_laid_out(t, s, ["o_orderkey"], 8))
        jobs[f"p5_merge_{percent}pc"] = lambda s=source: force(changes.merge_upsert(orders, s, ["o_orderkey"]))
        jobs[f"p5_full_outer_{percent}pc"] = lambda o=outer: force(o)
    return jobs


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = open_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: seconds(lambda name=name: force(QUERIES[name](spark, sf_dir)), runs) for name in HEADLINE}
    total = round(sum(times.values()), 3)
    for name, job in {**half_jobs(spark), **table_jobs(spark, sf_dir)}.items():
        times[name] = seconds(job, runs)
    print(
        json.dumps(
            {
                "metric": "sum of the headline queries' median times",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": cpus,
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
