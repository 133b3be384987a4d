"""Plain parquet folders that batches are added to, read whole or as a stream.

A batch is written aside and moved in under its name when it is complete, so readers see all of
its rows or none. A batch that is there already is not added again: a writer that was broken
off repeats its batch without counting it twice.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    files, hadoop = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(hadoop)) if files.exists(hadoop) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    files, hadoop = _files(spark, path)
    files.delete(hadoop, True)


def _moved(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder to a name that is free; False, and nothing changed, where it is taken.

    The move asks the file system to refuse an existing target, which distributed file systems do in one
    step. Where the test and the move are two steps, a folder that another writer has put there in
    between takes the moved one inside itself: that is undone.
    """
    jvm = spark._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(path) for path in (source, target)]
    files = paths[1].getFileSystem(spark._jsc.hadoopConfiguration())
    paths = [files.makeQualified(path) for path in paths]
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(paths[1].toUri(), spark._jsc.hadoopConfiguration())
    kinds = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = getattr(kinds, "NONE")
    try:
        context.rename(*paths, options)
    except Py4JJavaError as error:
        if "AlreadyExists" not in str(error.java_exception.getClass().getName()):
            raise
        return False
    inside = jvm.org.apache.hadoop.fs.Path(paths[1], paths[0].getName())
    if files.exists(inside):
        files.delete(inside, True)
        return False
    return True


def add_batch(rows: DataFrame, folder: str, name: str) -> bool:
    """Add rows as batch ``name``; False where that batch is there already.

    Of several writers of one batch one succeeds, whenever they look. Each writes aside under a
    name of its own.
    """
    spark = rows.sparkSession
    if name in names_in(spark, f"{folder}/batches"):
        return False
    aside = f"{folder}/_aside/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(aside)
    files, target = _files(spark, f"{folder}/batches")
    files.mkdirs(target)
    added = _moved(spark, aside, f"{folder}/batches/{name}")
    if not added:
        remove_folder(spark, aside)
    return added


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """All rows added so far."""
    return spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/batches")


def stream_batches(
    spark: SparkSession, folder: str, files_per_batch: int | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """The rows as a stream, those added later included."""
    reader = spark.readStream.schema(schema or read_batches(spark, folder).schema).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/batches")
