"""Insert, delete, update and merge as functions from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from windrow.session import scratch_dir
from windrow.sources.readers import local_frame


class SchemaMismatch(ValueError):
    """New rows do not fit the table's columns."""


class AmbiguousMerge(ValueError):
    """Several source rows match the same target row."""


def is_true(test: Column | str) -> Column:
    """The test, with null counted as false: a row is changed only where it is true."""
    test = F.expr(test) if isinstance(test, str) else test
    return F.coalesce(test, F.lit(False))


def delete_where(df: DataFrame, test: Column | str) -> DataFrame:
    return df.filter(~is_true(test))


def update_where(df: DataFrame, test: Column | str, values: Mapping[str, Column | object]) -> DataFrame:
    """Set columns where the test is true; every value sees the row as it was."""
    return df.select(*updated_columns(df.schema, test, values))


def updated_columns(schema: T.StructType, test: Column | str, values: Mapping[str, Column | object]) -> list[Column]:
    values = {name.lower(): value for name, value in values.items()}
    unknown = set(values) - {name.lower() for name in schema.names}
    if unknown:
        raise SchemaMismatch(f"no such columns: {sorted(unknown)}")
    columns = []
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name.lower() in values:
            value = values[field.name.lower()]
            value = value if isinstance(value, Column) else F.lit(value)
            column = F.when(is_true(test), value.cast(field.dataType)).otherwise(column)
        columns.append(column.alias(field.name))
    return columns


def insert_rows(df: DataFrame, rows: Sequence[Sequence[object]]) -> DataFrame:
    """Add literal rows, positions as in the table; equal rows are all kept."""
    return df.unionByName(local_frame(df.sparkSession, rows, df.schema))


def same_columns(target: T.StructType, new: T.StructType) -> None:
    """Raise unless names and types agree (order and nullability do not matter)."""
    have = {f.name.lower(): f.dataType for f in target.fields}
    got = {f.name.lower(): f.dataType for f in new.fields}
    extra, missing = sorted(set(got) - set(have)), sorted(set(have) - set(got))
    changed = sorted(n for n in set(have) & set(got) if have[n] != got[n])
    if extra or missing or changed:
        raise SchemaMismatch(f"columns added {extra}, missing {missing}, with another type {changed}")


def append_strict(df: DataFrame, new: DataFrame) -> DataFrame:
    same_columns(df.schema, new.schema)
    return df.unionByName(new)


def merged_schema(target: T.StructType, new: T.StructType) -> T.StructType:
    """The target's columns, then the new ones. A column may not change its type."""
    have = {f.name.lower(): f for f in target.fields}
    fields = [T.StructField(f.name, f.dataType, True) for f in target.fields]
    for field in new.fields:
        old = have.get(field.name.lower())
        if old is None:
            fields.append(T.StructField(field.name, field.dataType, True))
        elif old.dataType != field.dataType:
            raise SchemaMismatch(f"{field.name}: {old.dataType.simpleString()} became {field.dataType.simpleString()}")
    return T.StructType(fields)


def append_merge_schema(df: DataFrame, new: DataFrame) -> DataFrame:
    """Append rows with other columns; columns a side lacks are null there."""
    merged_schema(df.schema, new.schema)
    return df.unionByName(new, allowMissingColumns=True)


def fit_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with the schema's columns, cast to its types."""
    names = {c.lower() for c in df.columns}
    lacking = [f.name for f in schema.fields if f.name.lower() not in names]
    if lacking or len(names) != len(schema.fields):
        raise SchemaMismatch(f"need columns {schema.names}, got {df.columns}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def key_set(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key once, for use in a join.

    Adaptive execution splits a hot key only where both sides of a join are shuffled right
    below it. Grouping by one struct keeps the join from reusing this shuffle, so the keys
    (at most one row each) are shuffled again, and rows that meet them can be split.
    """
    return df.select(F.struct(*keys).alias("_key")).distinct().select("_key.*")


def replaced_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the source has."""
    return target.join(key_set(source, keys), list(keys), "left_semi")


def unaffected_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the source lacks."""
    return target.join(key_set(source, keys), list(keys), "left_anti")


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks; rows with a null key are among them."""
    return source.join(key_set(target, keys), list(keys), "left_anti")


def check_merge_source(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a target row is matched by several source rows. Runs Spark jobs.

    The target is looked at only where the source repeats a key at all.
    """
    counts = source.select(*keys).dropna().groupBy(F.struct(*keys).alias("_key")).count()
    repeated = counts.filter(F.col("count") > 1).select("_key.*")
    if repeated.isEmpty():
        return
    clash = target.select(*keys).join(repeated, list(keys), "left_semi").limit(1).collect()
    if clash:
        raise AmbiguousMerge(f"several source rows match key {tuple(clash[0])}")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update target rows whose key the source has, insert the source's other rows.

    One left join keeps or replaces every target row. A source that Spark knows to be
    small is broadcast there, so the target is not shuffled; otherwise adaptive
    execution can split a hot key on the target side, which a full outer join forbids.
    The source comes to the join with one row and a count per key: the count tells a
    match (never a null in the data), and a match of several source rows fails the job.
    The source is evaluated once, into working files that both parts read, so one that is
    not deterministic can't give a torn result.
    """
    keys = list(keys)
    source = fit_to(source, target.schema)
    staged = scratch_dir(source.sparkSession, "merge")
    source.write.parquet(staged)
    source = source.sparkSession.read.schema(source.schema).parquet(staged)
    change = (
        source.groupBy(F.struct(*keys).alias("_key"))  # one struct: see key_set
        .agg(
            F.first(F.struct(*[F.col(f"`{c}`") for c in source.columns])).alias("_new"),
            F.count(F.lit(1)).alias("_matches"),
        )
        .select("_key.*", "_new", "_matches")
    )
    clash = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    matched = F.col("_matches").isNotNull()
    kept = (
        target.join(change, keys, "left")
        .filter(F.when(F.col("_matches") > 1, clash).otherwise(True))
        .select(*[F.when(matched, F.col(f"_new.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in target.columns])
    )
    added = new_rows(target, source, keys)
    return kept.unionByName(added.select(*target.columns))


def lay_out(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store rows as a table laid out by key: ``buckets`` files, each with all rows of its keys.

    Joins and merges on the keys then read co-located files instead of shuffling the table. Choose so
    many buckets that one fits a task's memory; a table that is merged again and again stays laid
    out if its new state is written by this again.
    """
    # Dealt like the buckets first, so that every bucket is one file and not one per task.
    dealt = df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def merge_laid_out(target: DataFrame, source: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``merge_upsert`` into a table that ``lay_out`` has stored with so many buckets.

    The table is read once, bucket by bucket, and not shuffled; the source is dealt to the same
    buckets and read once. The cost of the shuffle follows the change, not the table. A key with
    many rows in the table is in one bucket by its layout, and rows of the source that
    share a key (null among them) meet in one task. Several source rows that match one target
    row fail the job; those that match none are all inserted.
    """
    keys = list(keys)
    source = fit_to(source, target.schema)
    key_columns = [F.col(f"`{k}`") for k in keys]
    # The count takes the order that the join needs as well.
    counted = source.repartition(buckets, *key_columns).withColumn("_matches", F.count(F.lit(1)).over(Window.partitionBy(*key_columns)))
    change = counted.select(
        *[c.alias(f"_key{i}") for i, c in enumerate(key_columns)],
        F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("_new"),
        "_matches",
    )
    same = [F.col(f"`{k}`") == F.col(f"_key{i}") for i, k in enumerate(keys)]
    both = target.withColumn("_held", F.lit(True)).join(change, same, "full")
    clash = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    told = F.col("_matches").isNotNull()
    sound = F.when(F.col("_held") & (F.col("_matches") > 1), clash).otherwise(True)
    return both.filter(sound).select(
        *[F.when(told, F.col(f"_new.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in target.columns]
    )


def swap_in(df: DataFrame, path: str, view: str) -> DataFrame:
    """Write the new state to a fresh folder, then point the view at it.

    The files being read are never overwritten; readers move over in one step.
    """
    df.write.parquet(path)
    spark = df.sparkSession
    fresh = spark.read.schema(df.schema).parquet(path)
    fresh.createOrReplaceTempView(view)
    return fresh


def upsert_rewrite(target: DataFrame, source: DataFrame, keys: Sequence[str], path: str, view: str) -> DataFrame:
    """The upsert for plain files whose target keys are unique.

    Unaffected rows, the new form of replaced rows and new rows make up the new state.
    The last two together are the source, so one anti join is enough.
    """
    check_merge_source(target, source, keys)
    result = unaffected_rows(target, source, keys).unionByName(fit_to(source, target.schema))
    return swap_in(result, path, view)
