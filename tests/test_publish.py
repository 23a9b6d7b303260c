"""A write is seen whole or not at all, and old versions go."""
import os
import signal
import subprocess
import sys
import textwrap
import time

import pytest
from pyspark.sql import functions as F

from strata.sources import Layers, files, publish, read_layer, read_table, write_layer, write_table

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_overwrite_publishes_and_keeps_two_versions(spark, tmp_path):
    place = str(tmp_path / "t")
    for n in range(1, 5):
        write_table(spark.range(n), place)
        assert ids(read_table(spark, place)) == list(range(n))
    assert len(publish.versions(spark, place)) == 2
    assert len([n for n in files.names(spark, place) if n.startswith("version-")]) == 2


def test_a_reader_keeps_the_version_it_began_with(spark, tmp_path):
    place = str(tmp_path / "t")
    write_table(spark.range(3), place)
    held = read_table(spark, place)
    write_table(spark.range(5), place)
    assert ids(held) == [0, 1, 2] and ids(read_table(spark, place)) == [0, 1, 2, 3, 4]


def test_a_table_may_be_rebuilt_from_itself(spark, tmp_path):
    place = str(tmp_path / "t")
    write_table(spark.range(3), place)
    write_table(read_table(spark, place).withColumn("id", F.col("id") + 10), place)
    assert ids(read_table(spark, place)) == [10, 11, 12]


def test_failed_gate_and_failed_write_leave_the_table(spark, tmp_path):
    place = str(tmp_path / "t")
    write_table(spark.range(3), place)

    def gate(staged):
        assert staged.count() > 5, "too few rows"

    with pytest.raises(AssertionError):
        write_table(spark.range(2), place, gate=gate)
    with pytest.raises(Exception):
        write_table(spark.range(2).select(F.raise_error(F.lit("boom")).alias("id")), place)
    assert ids(read_table(spark, place)) == [0, 1, 2]
    assert len([n for n in files.names(spark, place) if n.startswith("version-")]) == 1   # nothing left of either
    write_table(spark.range(8), place, gate=gate)
    assert read_table(spark, place).count() == 8


def test_a_job_killed_mid_write_leaves_the_old_table_readable(spark, tmp_path):
    place = str(tmp_path / "t")
    write_table(spark.range(3), place)
    job = textwrap.dedent(f"""
        import sys, time
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import functions as F
        from strata.session import build_session
        from strata.sources import write_table
        spark = build_session("local[2]", "killed", 4)
        slow = F.pandas_udf(lambda s: (time.sleep(600), s)[1] if (s > 0).any() else s, "long")
        write_table(spark.range(0, 1000, 1, 2).repartition(2, "id").select(slow("id").alias("id")), {place!r})
    """)
    run = subprocess.Popen([sys.executable, "-c", job], stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL, start_new_session=True)
    try:
        until = time.time() + 120
        while time.time() < until and len([n for n in os.listdir(place) if n.startswith("version-")]) < 2:
            time.sleep(0.2)
        assert len([n for n in os.listdir(place) if n.startswith("version-")]) == 2        # the write has begun
    finally:
        os.killpg(run.pid, signal.SIGKILL)
        run.wait()
    assert ids(read_table(spark, place)) == [0, 1, 2]
    for n in (4, 5, 6):
        write_table(spark.range(n), place)
    assert ids(read_table(spark, place)) == list(range(6))
    folders = [n for n in files.names(spark, place) if n.startswith("version-")]
    assert folders == publish.versions(spark, place)                                       # the dead writer's folder went


def test_two_writers_agree_on_one_version(spark, tmp_path):
    place = str(tmp_path / "t")
    first = write_table(spark.range(3), place)
    publish.publish(spark.range(4), place, expect=first)
    with pytest.raises(publish.PublishConflict):
        publish.publish(spark.range(9), place, expect=first)
    assert read_table(spark, place).count() == 4


def test_append_and_partitioned_tables(spark, tmp_path):
    place = str(tmp_path / "t")
    write_table(spark.range(4).withColumn("p", F.col("id") % 2), place, partition_by=["p"])
    write_table(spark.range(4, 6).withColumn("p", F.col("id") % 2), place, mode="append", partition_by=["p"])
    assert ids(read_table(spark, place)) == list(range(6))
    with pytest.raises(ValueError):
        write_table(spark.range(1), place, mode="ignore")


def test_a_plain_folder_is_still_a_table(spark, tmp_path):
    place = str(tmp_path / "plain")
    spark.range(2).write.parquet(place)
    assert ids(read_table(spark, place)) == [0, 1]


def test_catalog_tables_are_published_behind_a_view(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS strata_test_publish")
    lay = Layers(catalog=True, names={"silver": "strata_test_publish"})
    for n in range(1, 5):
        write_layer(spark.range(n), lay, "silver", "uf")
        assert read_layer(spark, lay, "silver", "uf").count() == n
    with pytest.raises(ZeroDivisionError):
        write_layer(spark.range(9), lay, "silver", "uf", gate=lambda staged: 1 / 0)
    assert read_layer(spark, lay, "silver", "uf").count() == 4
    write_layer(spark.range(1), lay, "silver", "uf", mode="append")
    assert read_layer(spark, lay, "silver", "uf").count() == 5
    tables = [r.tableName for r in spark.sql("SHOW TABLES IN strata_test_publish").collect()]
    assert len([t for t in tables if "__v" in t]) == 2
