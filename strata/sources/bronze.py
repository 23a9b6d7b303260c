"""Bronze ingestion — a raw copy stamped with arrival time and source name."""
from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

INGESTED_AT = "_ingestao_timestamp"
SOURCE = "_fonte"
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def instant(at: datetime | str) -> Column:
    """A fixed instant as a TIMESTAMP literal; naive values are taken as UTC.

    Built from epoch microseconds, so the instant does not depend on the
    session time zone.
    """
    moment = datetime.fromisoformat(at) if isinstance(at, str) else at
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit((moment - _EPOCH) // timedelta(microseconds=1)))


def stamp(df: DataFrame, source: str, at: datetime | str | None = None) -> DataFrame:
    """``SELECT *, <arrival time> AS _ingestao_timestamp, '<source>' AS _fonte``.

    ``at`` defaults to ``current_timestamp()`` (one value per query); pass a
    fixed instant (naive = UTC) for repeatable runs.
    """
    ts = F.current_timestamp() if at is None else instant(at)
    return df.select("*", ts.alias(INGESTED_AT), F.lit(source).alias(SOURCE))


def ingest(spark, layers, source_location: str, table: str, source_name: str | None = None,
           at: datetime | str | None = None, fmt: str = "parquet") -> str:
    """S4 as a job: read a source table, stamp it, overwrite ``bronze.<table>``.

    One scan and one write; nothing is transformed beyond the two audit columns.
    """
    from strata.sources.sinks import write_layer
    from strata.sources.tables import read_table
    src = read_table(spark, source_location, fmt)
    return write_layer(stamp(src, source_name or source_location, at), layers, "bronze", table)
