"""The shared folder comes from the session's spark.checkpoint.dir."""
from strata.session import shared_path, shared_root


def test_shared_root_is_read_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == configured.rstrip("/")
    a, b = shared_path(spark, "x", unique=True), shared_path(spark, "x", unique=True)
    assert a != b and a.startswith(configured.rstrip("/") + "/x/")


def test_defaults_for_scale_are_on(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get("spark.ui.enabled") == "false"


def test_the_entry_point_works_without_the_training_data_operators(tmp_path):
    """Neither their folders nor a package that only they need may take the other queries along."""
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(root, "strata"), copy / "strata", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), copy)
    count = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(q.startswith('op') for q in e.queries()))"
    out = subprocess.run([sys.executable, "-c", count], cwd=copy, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= 50 and out[0] == out[1] and out[2] == "0"
    hidden = "import sys; sys.modules['regex'] = None; " + count
    out = subprocess.run([sys.executable, "-c", hidden], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= 50 and out[2] == "0"
