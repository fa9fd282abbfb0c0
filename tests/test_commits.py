"""Committed tables: failures, repeated and competing runs, old versions."""

import pytest
from pyspark.sql import functions as F, types as T

from ebbline.sources import commits, readers

SCHEMA = T.StructType([T.StructField("id", T.LongType())])


def ids(spark, path, number=None):
    return sorted(r["id"] for r in commits.read_table(spark, path, SCHEMA, number).collect())


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def failing(df):
    """``df`` with a row in the middle that fails its task."""
    return df.select(F.when(F.col("id") == 7, F.raise_error("broken").cast("long")).otherwise(F.col("id")).alias("id"))


@pytest.mark.parametrize("keep", [True, False])
def test_a_job_that_fails_midway_changes_nothing(spark, path, keep):
    commits.write_table(spark.range(5), path)
    with pytest.raises(Exception, match="broken"):
        commits.write_table(failing(spark.range(0, 20, 1, 8)), path, run="r", keep=keep)
    assert ids(spark, path) == [0, 1, 2, 3, 4] and commits.versions(spark, path) == [1]
    # The same run may be tried again.
    commits.write_table(spark.range(20, 22), path, run="r", keep=keep)
    assert ids(spark, path) == [*range(5 if keep else 0), 20, 21]


def test_replace_may_read_the_table_it_replaces(spark, path):
    commits.write_table(spark.range(3), path)
    doubled = commits.read_table(spark, path, SCHEMA).select((F.col("id") * 2).alias("id"))
    commits.write_table(doubled, path, keep=False)
    assert ids(spark, path) == [0, 2, 4] and ids(spark, path, 1) == [0, 1, 2]


def test_a_reader_keeps_its_version(spark, path):
    commits.write_table(spark.range(3), path)
    before = commits.read_table(spark, path, SCHEMA)
    commits.write_table(spark.range(9), path, keep=False)
    assert before.count() == 3


def test_repeated_runs_change_nothing(spark, path):
    for _ in range(3):
        commits.write_table(spark.range(4), path, run="monday")
    assert ids(spark, path) == [0, 1, 2, 3] and commits.versions(spark, path) == [1]


def test_competing_writers_both_get_in(spark, path):
    """Another writer commits while this one writes its rows."""

    def write(folder):
        spark.range(10, 12).write.parquet(folder)
        commits.write_table(spark.range(2), path)

    after = commits.publish(spark, path, write)
    assert after.number == 2 and ids(spark, path) == [0, 1, 10, 11]


def test_the_same_run_started_twice_counts_once(spark, path):
    def write(folder):
        spark.range(2).write.parquet(folder)
        commits.write_table(spark.range(2), path, run="r")

    commits.publish(spark, path, write, run="r")
    assert ids(spark, path) == [0, 1]
    assert len(commits._Files(spark, path).names(path)) == 2


def test_a_number_is_taken_once(spark, path):
    files = commits._Files(spark, path)
    assert files.create(f"{path}/a.json", "first") and not files.create(f"{path}/a.json", "second")
    assert files.read(f"{path}/a.json") == "first" and list(files.names(path)) == ["a.json"]


def test_empty_and_partitioned_tables(spark, path):
    schema = T.StructType([*SCHEMA, T.StructField("day", T.IntegerType())])
    with_day = spark.range(6).withColumn("day", (F.col("id") % 2).cast("int"))
    commits.write_table(with_day.limit(0), path, partition_by=["day"])
    assert commits.read_table(spark, path, schema).collect() == []
    for _ in range(2):
        commits.write_table(with_day, path, partition_by=["day"])
    found = commits.read_table(spark, path, schema)
    assert found.count() == 12 and found.where("day = 1").count() == 6
    assert "PartitionFilters: [isnotnull(day" in found.where("day = 1")._jdf.queryExecution().executedPlan().toString()


def test_sources_read_the_last_commit(spark, path):
    with pytest.raises(FileNotFoundError):
        readers.Source("committed", path).load(spark)
    commits.write_table(spark.range(3), path)
    commits.write_table(spark.range(3), path)
    assert readers.Source("committed", path, schema=SCHEMA).load(spark).count() == 6


def test_sweep_deletes_what_no_version_names(spark, path):
    for last in range(1, 5):
        commits.write_table(spark.range(last), path, keep=False)
    with pytest.raises(Exception, match="broken"):
        commits.write_table(failing(spark.range(20)), path)
    assert commits.sweep(spark, path) == []
    assert len(commits.sweep(spark, path, keep=2, hours=0)) == 3
    assert commits.versions(spark, path) == [3, 4] and ids(spark, path, 3) == [0, 1, 2] and ids(spark, path) == [0, 1, 2, 3]
