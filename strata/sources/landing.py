"""The landing stream of measurement messages as ``(data STRING, publish_time TIMESTAMP)``.

* ``fmt="kafka"``: a Kafka topic (needs the ``spark-sql-kafka`` package on the
  classpath); the message value is the JSON text and the broker timestamp is
  the arrival time.  Options are passed through (``kafka.bootstrap.servers``,
  ``subscribe``, ``startingOffsets``, ...).
* any file format (``parquet``, ``json``, ...): a folder where messages land
  with exactly these two columns, read as a file stream (``maxFilesPerTrigger``
  etc. passed through).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

LANDED_SCHEMA = "data string, publish_time timestamp"


def landed_messages(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options) -> DataFrame:
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**options).load()
        return raw.select(F.col("value").cast("string").alias("data"), F.col("timestamp").alias("publish_time"))
    if not path:
        raise ValueError("a landing folder path is required for file formats")
    return spark.readStream.schema(LANDED_SCHEMA).format(fmt).options(**options).load(path)
