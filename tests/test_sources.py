import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from task_memory import peak_mb
from windrow import session
from windrow.plans.inputs import FLIGHT_FIELDS
from windrow.sources import catalog, readers, writers


@pytest.fixture
def delays(spark, tmp_path):
    path = str(tmp_path / "delays.csv")
    with open(path, "w") as f:
        f.write("carrier,DepDelay\nAA,10\nAA,NA\nUA,9\nUA,100\n")
    return path


def test_missing_marker_turns_an_inferred_column_into_text(spark, delays):
    as_text = readers.read_csv(spark, delays, infer=True)
    assert dict(as_text.dtypes)["DepDelay"] == "string"
    as_number = readers.read_csv(spark, delays, infer=True, missing="NA")
    assert dict(as_number.dtypes)["DepDelay"] == "int"
    assert sorted(r[1] for r in as_text.filter("DepDelay != 'NA'").orderBy(F.desc("DepDelay")).collect()) == ["10", "100", "9"]
    assert [r[1] for r in as_text.filter("DepDelay != 'NA'").orderBy(F.desc("DepDelay")).collect()] == ["9", "100", "10"]


def test_missing_marker_is_null_under_a_schema(spark, delays):
    rows = readers.read_csv(spark, delays, schema="carrier string, DepDelay int", missing="NA").collect()
    assert [r["DepDelay"] for r in rows] == [10, None, 9, 100]


def test_flight_schema_has_27_fields(spark):
    assert len(FLIGHT_FIELDS.split(", ")) == 27
    assert len(spark.createDataFrame([], FLIGHT_FIELDS).columns) == 27


def test_csv_keeps_quotes_separators_and_text_with_blanks(spark, tmp_path):
    rows = [(1, 'say "hi", twice'), (2, "a|b\tc"), (3, "back\\slash"), (4, "NA"), (5, 'quote " only')]
    df = readers.local_frame(spark, rows, "id int, text string")
    for sep in (",", "\t", "|"):
        path = str(tmp_path / f"q{ord(sep)}")
        writers.write_csv(df, path, sep=sep)
        assert sorted(map(tuple, readers.read_csv(spark, path, schema=df.schema, sep=sep).collect())) == rows


def test_csv_with_line_breaks(spark, tmp_path):
    rows = [(1, "two\nlines"), (2, 'a "b"\n,c')]
    df = readers.local_frame(spark, rows, "id int, text string")
    writers.write_csv(df, str(tmp_path / "m"))
    back = readers.read_csv(spark, str(tmp_path / "m"), schema=df.schema, multiline=True)
    assert sorted(map(tuple, back.collect())) == rows


def test_local_frame_size_is_known(spark):
    df = readers.local_frame(spark, [("a", 1.5), (None, None)], "k string, v double")
    assert [tuple(r) for r in df.collect()] == [("a", 1.5), (None, None)]
    assert "LocalRelation" in df._jdf.queryExecution().optimizedPlan().toString()
    assert readers.local_frame(spark, [], "k string").count() == 0


def test_parquet_refuses_to_overwrite_unless_told(spark, tmp_path):
    path = str(tmp_path / "p")
    writers.write_parquet(spark.range(3), path)
    with pytest.raises(AnalysisException):
        writers.write_parquet(spark.range(3), path)
    writers.write_parquet(spark.range(4), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 4


def test_choose_columns_checks_names(spark):
    readers.register(spark.createDataFrame([(1, 2)], "mpg int, disp int"), "cars_view")
    assert [tuple(r) for r in readers.choose_columns(spark, "cars_view", x="disp", y="MPG").collect()] == [(2, 1)]
    with pytest.raises(ValueError):
        readers.choose_columns(spark, "cars_view", x="mpg; drop")
    spark.catalog.dropTempView("cars_view")


def test_jdbc_ranges():
    assert readers.jdbc_ranges(None, None, None, None) == {}
    assert readers.jdbc_ranges("id", 0, 100, 4) == {
        "column": "id", "lowerBound": 0, "upperBound": 100, "numPartitions": 4,
    }
    with pytest.raises(ValueError):
        readers.jdbc_ranges("id", 0, None, 4)
    with pytest.raises(ValueError):
        readers.jdbc_ranges("id", 5, 5, 4)


def test_sequence_starts_at_one(spark):
    assert [r[0] for r in readers.sequence_ids(spark, 4).collect()] == [1, 2, 3, 4]


def test_table_names_are_lower_case_on_disk(spark, tmp_path):
    catalog.create_database(spark, "case_db", str(tmp_path / "case_db"))
    with catalog.use_database(spark, "case_db"):
        writers.write_table(spark.range(5).repartition(2), "PersistentTable")
        assert spark.catalog.currentDatabase() == "case_db"
    assert spark.catalog.currentDatabase() == "default"
    files = catalog.list_files(spark, str(tmp_path / "case_db"))
    assert files.count() == 2
    assert files.filter("file_path like '%/persistenttable/%'").count() == 2
    assert [r["tableName"] for r in catalog.list_tables(spark, "case_db").collect()] == ["persistenttable"]
    spark.sql("DROP DATABASE case_db CASCADE")


def test_database_is_restored_after_an_error(spark, tmp_path):
    catalog.create_database(spark, "err_db", str(tmp_path / "err_db"))
    with pytest.raises(AnalysisException):
        with catalog.use_database(spark, "err_db"):
            readers.read_table(spark, "no_such_table")
    assert spark.catalog.currentDatabase() == "default"
    spark.sql("DROP DATABASE err_db")


def test_compaction_keeps_rows(spark, tmp_path):
    small, packed = str(tmp_path / "small"), str(tmp_path / "packed")
    spark.range(1000).repartition(30).write.parquet(small)
    writers.compact_files(spark, small, packed)
    detail = catalog.table_detail(spark, packed).first()
    assert detail["num_files"] == 1 and detail["size_bytes"] > 0
    assert spark.read.parquet(packed).agg(F.sum("id")).first()[0] == 499500


def test_compaction_keeps_columns_that_only_some_files_have(spark, tmp_path):
    small, packed = str(tmp_path / "small"), str(tmp_path / "packed")
    spark.range(10).withColumn("a", F.col("id") * 2).write.parquet(small)
    spark.range(10, 15).withColumn("b", F.lit("x")).write.mode("append").parquet(small)
    copy = writers.compact_files(spark, small, packed)
    rows = {r["id"]: (r["a"], r["b"]) for r in copy.collect()}
    assert len(rows) == 15 and rows[4] == (8, None) and rows[12] == (None, "x")
    assert set(readers.read_parquet(spark, small, merge_schema=True).columns) == {"id", "a", "b"}


def test_compaction_keeps_partition_folders(spark, tmp_path):
    small, packed = str(tmp_path / "small"), str(tmp_path / "packed")
    df = spark.range(100).withColumn("day", (F.col("id") % 3).cast("int")).withColumn("half", F.col("id") % 2 == 0)
    df.repartition(5).write.partitionBy("day", "half").parquet(small)
    copy = writers.compact_files(spark, small, packed)
    files = [r["file_path"] for r in catalog.list_files(spark, packed).collect()]
    assert len(files) == 6 and all("/day=" in f and "/half=" in f for f in files)
    assert sorted(map(tuple, copy.select("id", "day").collect())) == [(i, i % 3) for i in range(100)]


def test_compaction_packs_each_folder_into_files_of_the_size_asked(spark, tmp_path):
    """Folders of very different size, many small files and one large one: all files near the size asked."""
    small, packed = str(tmp_path / "small files"), str(tmp_path / "packed")
    rows = spark.range(120_000).select(
        "id", F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "b/1 %").otherwise("c").alias("part"), F.sha2(F.col("id").cast("string"), 256).alias("text")
    )
    rows.where("part <> 'c'").repartition(25).write.partitionBy("part").parquet(small)
    rows.where("part = 'c' or id % 4 = 0").coalesce(1).write.mode("append").partitionBy("part").parquet(small)
    size = 600_000
    copy = writers.compact_files(spark, small, packed, file_bytes=size)
    files = [(r["file_path"].rsplit("/", 2)[1], r["size_bytes"]) for r in catalog.list_files(spark, packed).collect()]
    assert len(files) > 8 and len({folder for folder, _ in files}) == 3
    assert all(0.5 * size <= length <= 1.5 * size for _, length in files), files
    assert copy.agg(F.sum("id"), F.count("text")).first() == spark.read.parquet(small).agg(F.sum("id"), F.count("text")).first()


def test_compaction_holds_no_rows_while_it_writes(tmp_path):
    """A bin of a million rows is one task; a sort of them before the write takes more than 100 MB."""
    code = """
        from windrow.sources import writers
        rows = spark.range(0, 1_000_000, 1, 8).select("id", (F.col("id") * 3).alias("v"), F.lit("a").alias("part"))
        rows.write.partitionBy("part").parquet(folder + "/small")
        copy = writers.compact_files(spark, folder + "/small", folder + "/packed")
        assert copy.count() == 1_000_000 and len(spark.read.parquet(folder + "/packed").inputFiles()) == 1
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    """
    assert peak_mb(code, tmp_path) < 60


def test_compaction_by_columns_that_are_no_folders(spark, tmp_path):
    """A task that meets many values of a column sorts what is left of its rows."""
    small, packed = str(tmp_path / "small"), str(tmp_path / "packed")
    spark.range(1000).withColumn("day", (F.col("id") % 7).cast("int")).repartition(5).write.parquet(small)
    copy = writers.compact_files(spark, small, packed, partition_by=["day"])
    assert len(copy.inputFiles()) == 7
    assert sorted(map(tuple, copy.select("id", "day").collect())) == [(i, i % 7) for i in range(1000)]


def test_compaction_refuses_a_target_inside_the_source(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "small"))
    with pytest.raises(ValueError):
        writers.compact_files(spark, str(tmp_path / "small"), str(tmp_path / "small" / "packed"))
    assert spark.read.parquet(str(tmp_path / "small")).count() == 3


def test_listing_files_reads_no_content(spark, medium):
    plan = catalog.list_files(spark, f"{medium}/lineitem.parquet")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_scratch_folder_is_the_named_one(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = session.scratch_dir(spark, "x")
    if base:
        assert path.startswith(base)
    assert path != session.scratch_dir(spark, "x")


def test_a_cluster_must_name_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.scratch_dir(Session(), "x")
