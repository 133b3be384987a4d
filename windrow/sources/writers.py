"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def write_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite") -> None:
    """Save as a catalog table; with ``path`` the files lie there and outlive the table."""
    writer = df.write.mode(mode)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, *, header: bool = True, sep: str = ",", missing: str | None = None) -> None:
    """Separated text. Quotes inside values are doubled, so any reader gets them back."""
    options = {"header": header, "sep": sep, "escape": '"'}
    if missing is not None:
        options["nullValue"] = missing
    df.write.options(**options).csv(path)


def create_table_as(spark: SparkSession, name: str, path: str, query: str, source: str = "parquet") -> DataFrame:
    """Replace table ``name`` by the result of ``query``, stored at ``path``."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING {source} LOCATION '{path}' AS {query}")
    return spark.table(name)


# Files whose places are sent to every task; a longer list is joined like a table.
LISTED = 100_000

# With fewer folders than this, a task writes its rows as they come; from then on Spark sorts what is left of them.
OPEN_FOLDERS = 2


def _write_unsorted(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Write into partition folders without a sort of each task's rows, which would hold all of them.

    For frames whose tasks have one folder each. The bound is Spark's, read when the write is planned.
    """
    key, conf = "spark.sql.maxConcurrentOutputFileWriters", df.sparkSession.conf
    before = conf.get(key, None)
    conf.set(key, str(OPEN_FOLDERS))
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def _bins(files: DataFrame, file_bytes: int) -> tuple[DataFrame, int]:
    """Files with the folder's bins they go to, and the number of all bins.

    In each folder, files lie one after another in order of their names; bins of equal width, as near to
    ``file_bytes`` as the folder's size allows, are laid over them. A file from ``start`` on of ``size``
    bytes covers one bin or goes on into the next. The folders, not the files, are listed on the driver.
    """
    placed = files.withColumn("folder", F.regexp_replace("file", "[^/]*$", ""))
    sizes = placed.groupBy("folder").agg(F.sum("size").alias("total")).orderBy("folder").collect()
    spread, first = [], 0
    for row in sizes:
        bins = max(1, round(row["total"] / file_bytes))
        spread.append((row["folder"], first, bins, max(1.0, row["total"] / bins)))
        first += bins
    folders = files.sparkSession.createDataFrame(spread, "folder string, first_bin long, bins long, width double")
    before = Window.partitionBy("folder").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")
    return placed.select("*", start).join(folders, "folder"), max(1, first)


def compact_files(
    spark: SparkSession,
    path: str,
    target: str,
    file_bytes: int = 128 * 1024 * 1024,
    partition_by: Sequence[str] | None = None,
) -> DataFrame:
    """Copy a parquet folder of many small files into files of about ``file_bytes``, folder by folder.

    The listing's sizes are packed into bins within each partition folder, and every bin is one task
    that writes one file: no task writes into several folders, so its rows go to the file as they come and
    none are held. Files larger than a bin are spread over several. Rows are shuffled once. Files with other columns are merged: a column that a file
    lacks is null for its rows. Partition folders (``column=value``) stay; they are found in the file
    names, or given in ``partition_by``. Returns the copy, after a check of its rows and columns.
    """
    source_path, target_path = path.rstrip("/") + "/", target.rstrip("/") + "/"
    if target_path.startswith(source_path) or source_path.startswith(target_path):
        raise ValueError(f"{target} and {path} lie in one another")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    files = listed.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    rows = spark.read.option("mergeSchema", True).parquet(path)
    count, first = files.agg(F.count(F.lit(1)), F.min("file")).first()
    if partition_by is None:
        inner = (first or "").rpartition(source_path.lstrip("/").split(":/")[-1].lstrip("/"))[2]
        folders = [part.split("=", 1)[0] for part in inner.split("/")[:-1] if "=" in part]
        partition_by = [c for c in rows.columns if c in folders]
    places, bins = _bins(files, file_bytes)
    places = places.select(F.col("file").alias("_file"), *[F.col(c).alias(f"_{c}") for c in ("start", "size", "first_bin", "bins", "width")])
    named = rows.select("*", F.col("_metadata.file_path").alias("_of"), F.col("_metadata.row_index").alias("_row"))
    placed = named.join(F.broadcast(places) if count <= LISTED else places, F.col("_of") == F.col("_file"))
    # Where in its file a row lies does not matter, only that a file's rows spread evenly over its bytes.
    share = F.pmod(F.xxhash64("_row"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    place = F.floor((F.col("_start") + share * F.col("_size")) / F.col("_width"))
    own = F.col("_first_bin") + F.least(place, F.col("_bins") - 1)
    packed = placed.withColumn("_bin", own.cast("int")).repartitionById(bins, "_bin").select(rows.columns)
    _write_unsorted(packed, target, partition_by)
    copy = spark.read.schema(rows.schema).parquet(target)
    if copy.count() != rows.count() or set(spark.read.parquet(target).columns) != set(rows.columns):
        raise RuntimeError(f"the copy in {target} has other rows or columns than {path}")
    return copy
