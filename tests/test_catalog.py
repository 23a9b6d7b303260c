"""Every catalogue query equals its DuckDB oracle (sf0.001), and the entry runs."""
import os

import duckdb
import pytest

import __spark_entry__ as entry
from strata.plans.catalog import ORACLES, QUERIES
from scripts.check_oracles import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert len(QUERIES) >= 30


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "gap_for_year" in df.columns


def test_stream_over_a_folder_and_over_nothing(spark, tmp_path):
    from strata.plans.catalog.stream import run_event_stream
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    one = run_event_stream(spark, "/root/testdata/sf0.001/events.parquet")
    many = run_event_stream(spark, f"{tmp_path}/events.parquet")
    assert sorted(map(str, many.collect())) == sorted(map(str, one.collect()))
    events.filter("false").write.parquet(f"{tmp_path}/none.parquet")
    assert run_event_stream(spark, f"{tmp_path}/none.parquet").count() == 0
