"""Catalogue: the streaming views over the events table.

The events file is read as a file stream (``availableNow``: every file present
is processed, then the query stops), the latest event per (user, type) is kept
in streaming state, each micro-batch's touched keys land in a table on shared
storage, and the query result is read back from there.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.functions import json_int
from strata.session import shared_path
from strata.sources import TableSet, files
from strata.streaming import enriched, read_latest, start_latest_stream
from strata.streaming.measurements import resolve_latest
from strata.plans.catalog.registry import register

EVENT_KEYS = ["user_id", "event_type"]
EVENT_ORDER = ["ts", "event_id"]          # latest time, then the larger id
OUTPUT = ["user_id", "event_type", "event_id", "ts", "value", "k"]
MAX_FILES_PER_BATCH = 1000


def run_event_stream(spark: SparkSession, events_path: str) -> DataFrame:
    """File stream over the events table, which may be one file or a folder of part files.

    Runs until every file present is processed, however long that takes; a
    failed stream raises its own exception.
    """
    static = spark.read.parquet(events_path)
    schema = static.schema
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(events_path)
    single = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isFile()
    folder = events_path.rsplit("/", 1)[0] if single else events_path
    # availableNow honours maxFilesPerTrigger: a large backlog runs as several
    # bounded micro-batches instead of one batch holding everything
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", MAX_FILES_PER_BATCH)
    reader = reader.option("pathGlobFilter", path.getName()) if single else reader
    columns = ["user_id", "event_type", "ts", "event_id", "value", json_int("props", "$.k").alias("k")]
    source = reader.parquet(folder).select(*columns)
    run = shared_path(spark, "streams", "events_latest", unique=True)
    query = start_latest_stream(source, EVENT_KEYS, EVENT_ORDER, f"{run}/table", f"{run}/checkpoint")
    query.awaitTermination()
    files.remove_at_exit(spark, run)
    try:
        return read_latest(spark, f"{run}/table", EVENT_KEYS, EVENT_ORDER).select(*OUTPUT)
    except AnalysisException:      # no file, so no micro-batch and no table
        return resolve_latest(static.select(*columns).filter("false"), EVENT_KEYS, EVENT_ORDER).select(*OUTPUT)


_LATEST_SQL = """
SELECT user_id, event_type, event_id, ts, value,
       CASE WHEN regexp_full_match(trim(CAST(json_value(props, '$.k') AS VARCHAR)), '[+-]?[0-9]+')
            THEN TRY_CAST(trim(CAST(json_value(props, '$.k') AS VARCHAR)) AS INTEGER) END AS k
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
      FROM events) t
WHERE rn = 1
"""


@register("stream_latest", _LATEST_SQL)
def stream_latest(spark, sf_dir):
    """T1 + T2 + T4: latest event per (user, type) maintained by a streaming query."""
    return run_event_stream(spark, TableSet(spark, sf_dir).path("events"))


@register("stream_enriched", "WITH latest AS (" + _LATEST_SQL + """)
SELECT latest.*, c.c_name, c.c_nationkey, c.c_mktsegment
FROM latest LEFT JOIN customer c ON latest.user_id = c.c_custkey
""")
def stream_enriched(spark, sf_dir):
    """The streamed latest rows joined to the customer dimension at read time."""
    t = TableSet(spark, sf_dir)
    latest = run_event_stream(spark, t.path("events"))
    dim = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey", "c_mktsegment")
    return enriched(latest, dim, "user_id")
