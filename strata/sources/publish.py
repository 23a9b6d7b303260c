"""Staged, gated, atomic publishing of path-based tables.

A table's rows lie in immutable version folders, ``<location>/version-<n>-<id>``,
and ``<location>/_published`` holds one empty file per published version.  A
write goes to a new folder that nobody reads, is gated there, and becomes the
table by one file creation, which every store does whole or not at all.  A job
that dies before that leaves the old version as it was; so does a failed gate.

Readers resolve the newest mark, so a query keeps the version it began with.
``keep`` versions stay (the newest and those that running readers may hold);
older ones, and folders that dead writers left behind, are retired by later
publications.  Two writers never share a folder; the one that was overtaken gets
a ``PublishConflict`` and leaves nothing.  (Of two that publish in the same
instant the greater name wins, for all readers alike.)
"""
from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.sources import files

MARKS = "_published"
VERSION = re.compile(r"^version-(\d{12})-[0-9a-f]{32}(?:-(\d+))?$")
KEEP = 2

Gate = Callable[[DataFrame], None]


class PublishConflict(RuntimeError):
    """Another writer published while this one was writing; its table stands."""


def versions(spark: SparkSession, location: str) -> list[str]:
    """Published versions that can be read, oldest first."""
    return [n for n in files.names(spark, f"{location.rstrip('/')}/{MARKS}") if VERSION.match(n)]


def current(spark: SparkSession, location: str) -> str | None:
    """Folder of the newest published version, or None."""
    found = versions(spark, location)
    return f"{location.rstrip('/')}/{found[-1]}" if found else None


def tag(folder: str | None) -> int | None:
    """The number a version was published with (``publish(..., tagged=)``)."""
    match = VERSION.match(folder.rsplit("/", 1)[-1]) if folder else None
    return int(match.group(2)) if match and match.group(2) else None


def publish(df: DataFrame, location: str, gate: Gate | None = None, keep: int = KEEP, fmt: str = "parquet",
            partition_by: Sequence[str] = (), tagged: int | None = None, expect: str | None = None) -> str:
    """Write ``df`` beside the table, gate the written rows, make them the table; returns the version's folder.

    ``gate`` gets the staged rows as read back and raises to stop.  ``expect``
    is the folder that must still be the newest one when this one is published,
    for rows that were computed from it (else: the newest when the write began).
    """
    spark, base = df.sparkSession, location.rstrip("/")
    before = versions(spark, base)
    number = int(VERSION.match(before[-1]).group(1)) + 1 if before else 1
    name = f"version-{number:012d}-{uuid.uuid4().hex}" + ("" if tagged is None else f"-{tagged}")
    staged = f"{base}/{name}"
    try:
        writer = df.write.format(fmt)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(staged)
        if gate:
            gate(spark.read.format(fmt).schema(df.schema).load(staged))
        newest = current(spark, base)
        if newest != (expect or (f"{base}/{before[-1]}" if before else None)) or not files.exists(spark, staged):
            raise PublishConflict(f"{base}: {newest} was published while {name} was written")
    except Exception:
        files.remove(spark, staged)
        raise
    files.mark(spark, f"{base}/{MARKS}/{name}")
    retire(spark, base, keep)
    return staged


def retire(spark: SparkSession, location: str, keep: int = KEEP) -> list[str]:
    """Drop all but the newest ``keep`` versions, and unpublished folders older than those; returns their names.

    The mark goes before the folder, so a version that readers can find is whole.
    """
    base = location.rstrip("/")
    published = versions(spark, base)
    kept = set(published[-max(1, keep):])
    if not kept:
        return []
    oldest = min(kept)
    gone = [n for n in files.names(spark, base) if VERSION.match(n) and n not in kept and n < oldest]
    for name in published:
        if name not in kept:
            files.remove(spark, f"{base}/{MARKS}/{name}")
    for name in gone:
        files.remove(spark, f"{base}/{name}")
    return gone


# -- catalog tables -------------------------------------------------------
def publish_table(df: DataFrame, table: str, gate: Gate | None = None, keep: int = KEEP, fmt: str = "parquet",
                  partition_by: Sequence[str] = ()) -> str:
    """The same for a catalog: versions are tables, the name readers use is a view that is replaced in one step.

    A plain table of that name, from before tables were published, gives way to the view.
    """
    spark = df.sparkSession
    schema, _, name = table.rpartition(".")
    prefix = f"{schema}." if schema else ""
    older = sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {schema or 'default'} LIKE '{name}__v*'").collect()
                   if re.match(rf"^{re.escape(name)}__v\d{{12}}_[0-9a-f]{{32}}$", r.tableName))
    number = int(older[-1][len(name) + 3:len(name) + 15]) + 1 if older else 1
    staged = f"{name}__v{number:012d}_{uuid.uuid4().hex}"
    writer = df.write.format(fmt)
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(prefix + staged)
        if gate:
            gate(spark.read.table(prefix + staged))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{staged}")
        raise
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {prefix}{staged}")
    for name_ in [*older, staged][:-max(1, keep)]:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{name_}")
    return prefix + staged
