"""Versioned tables."""

import os
import subprocess
import sys
import textwrap

import pytest
from helpers import raw_tables
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from procurelens.plans.build import build_summary
from procurelens.sources import files, snapshots, tables

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
GIN = (1, "Acme", 10, "Gin", "2.00", 3, "6.00")


def ids(df):
    return sorted(r.id for r in df.collect())


def failing(spark, n):
    return spark.range(n, numPartitions=4).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("torn"))).otherwise(F.col("id")).alias("id"))


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_path(spark.range(3), path)
    with pytest.raises(PySparkException, match="torn"):
        tables.replace_path(failing(spark, 100), path)
    assert ids(tables.read_path(spark, path)) == [0, 1, 2]
    tables.replace_path(spark.range(5), path)
    assert ids(tables.read_path(spark, path)) == [0, 1, 2, 3, 4]


def test_a_job_killed_in_the_middle_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_path(spark.range(3), path)
    job = textwrap.dedent(f"""
        import sys, os, signal
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import functions as F
        from procurelens.session import local_session
        from procurelens.sources import snapshots, tables
        spark = local_session(2)
        commit = snapshots.commit
        def killed(*args, **options):
            os.kill(os.getpid(), signal.SIGKILL)
        snapshots.commit = killed
        tables.replace_path(spark.range(1000), {path!r})
    """)
    run = subprocess.run([sys.executable, "-c", job], capture_output=True, timeout=120)
    assert run.returncode == -9
    left = os.listdir(tmp_path / "t" / "_versions")
    assert len(left) == 2  # the new rows are there, but not in force
    assert ids(tables.read_path(spark, path)) == [0, 1, 2]
    snapshots.prune(spark, path)
    assert len(os.listdir(tmp_path / "t" / "_versions")) == 2  # it may belong to a running writer
    snapshots.prune(spark, path, orphan_hours=-1)
    assert len(os.listdir(tmp_path / "t" / "_versions")) == 1 and ids(tables.read_path(spark, path)) == [0, 1, 2]


def test_a_torn_pointer_does_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_path(spark.range(3), path)
    assert files.create_text(spark, f"{path}/_pointers/v000000000002", '{"parts": ["x"')
    assert ids(tables.read_path(spark, path)) == [0, 1, 2]
    assert tables.replace_path(spark.range(1), path).number == 3
    assert ids(tables.read_path(spark, path)) == [0]


def test_running_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_path(spark.range(2), path)
    before = tables.read_path(spark, path)
    tables.replace_path(before.select((F.col("id") + 10).alias("id")), path)  # reads what it replaces
    assert ids(before) == [0, 1] and ids(tables.read_path(spark, path)) == [10, 11]
    assert ids(tables.read_path(spark, path, version=1)) == [0, 1]
    for n in range(3):
        tables.replace_path(spark.range(n), path)
    assert [v.number for v in snapshots.versions(spark, path)] == [5, 4, 3]
    with pytest.raises(LookupError):
        tables.read_path(spark, path, version=1)
    snapshots.restore(spark, path, 4)
    assert ids(tables.read_path(spark, path)) == [0]


def test_of_two_writers_one_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_path(spark.range(2), path)
    base = snapshots.current(spark, path)
    tables.replace_path(spark.range(3), path)
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, path, ["late"], base)
    assert ids(tables.read_path(spark, path)) == [0, 1, 2]


def test_plain_folders_are_version_0(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).write.parquet(path)
    assert ids(tables.read_path(spark, path)) == [0, 1, 2, 3]
    tables.replace_path(spark.range(1), path)
    assert ids(tables.read_path(spark, path)) == [0] and ids(tables.read_path(spark, path, version=0)) == [0, 1, 2, 3]


def test_catalog_names_move_with_the_version(spark, tmp_path):
    name, path = "procurelens_snapshot_test", str(tmp_path / "t")
    spark.range(4).write.saveAsTable(name)
    with pytest.raises(PySparkException, match="torn"):
        tables.replace_table(failing(spark, 100), name, path)
    assert ids(tables.read_table(spark, name)) == [0, 1, 2, 3]
    tables.replace_table(spark.range(2), name, path)
    before = tables.read_table(spark, name)
    tables.replace_table(spark.range(1).withColumn("more", F.lit("x")), name, path)
    assert ids(before) == [0, 1]
    assert [tuple(r) for r in tables.read_table(spark, name).collect()] == [(0, "x")]
    spark.sql(f"DROP VIEW {name}")


@pytest.mark.parametrize("mode", ["lenient", "strict"])
def test_a_summary_that_fails_leaves_the_old_one(spark, tmp_path, mode):
    path = str(tmp_path / mode)
    good = raw_tables(spark, [GIN], [(1, 10, "3.00", "750")])
    build_summary(spark, good, path, mode=mode)
    bad = dict(good, purchases=good["purchases"].withColumn("vendorname", F.raise_error(F.lit("torn")).cast("string")))
    with pytest.raises(PySparkException, match="torn"):
        build_summary(spark, bad, path, mode=mode)
    assert tables.read_path(spark, path).count() == 1 and len(snapshots.versions(spark, path)) == 1
