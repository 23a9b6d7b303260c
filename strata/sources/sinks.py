"""Full-overwrite table writes with an optional clustered layout.

Clustering is expressed the Spark way: range-partition on the clustering
columns, completed by a hash of the row (a sampled range shuffle, so rows that
share one hot key still spread over tasks), and sort within each partition, so each
output file covers a narrow, sorted slice of the keys and parquet min/max
statistics let later scans skip row groups.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.sources.publish import Gate, current, publish, publish_table
from strata.sources.tables import Layers


def clustered(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """S3: range-partition + sort within partitions on ``columns``."""
    cols = list(columns)
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields
                if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))]
    ranges = [*cols, F.xxhash64(*hashable)] if hashable else cols
    out = df.repartitionByRange(partitions, *ranges) if partitions else df.repartitionByRange(*ranges)
    return out.sortWithinPartitions(*cols)


def write_table(
    df: DataFrame,
    location: str,
    mode: str = "overwrite",
    clustered_fields: Sequence[str] | None = None,
    partition_by: Sequence[str] | None = None,
    catalog: bool = False,
    fmt: str = "parquet",
    gate: Gate | None = None,
) -> str:
    """Write ``df``, optionally clustered (S3); returns where this write's rows lie.

    ``overwrite`` publishes a new version: nothing changes for readers until the
    rows are written and have passed ``gate`` (see ``publish``).  ``append`` adds
    files to the newest version.
    """
    out = clustered(df, clustered_fields) if clustered_fields else df
    if mode == "overwrite":
        return (publish_table if catalog else publish)(out, location, gate, fmt=fmt, partition_by=tuple(partition_by or ()))
    if mode != "append":
        raise ValueError(f"mode {mode!r}: overwrite or append")
    if gate:
        raise ValueError("an append is not staged, so it cannot be gated")
    place = _newest_table(df.sparkSession, location) if catalog else current(df.sparkSession, location) or location
    writer = out.write.mode("append").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(place) if catalog else writer.save(place)
    return place


def _newest_table(spark: SparkSession, table: str) -> str:
    """The table behind a published view, or the name itself."""
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW":
        return spark.sql(f"SHOW CREATE TABLE {table}").first()[0].split("FROM ")[-1].strip()
    return table


def write_layer(df: DataFrame, layers: Layers, layer: str, table: str, **kwargs) -> str:
    return write_table(df, layers.location(layer, table), catalog=layers.catalog, **kwargs)


def materialize(spark: SparkSession, df: DataFrame, location: str) -> DataFrame:
    """Publish ``df`` at ``location`` (shared storage) and read it back.

    Cuts the lineage at a durable point: a lost executor after this only
    recomputes from the written files, not from the sources.
    """
    return spark.read.schema(df.schema).parquet(publish(df, location))
