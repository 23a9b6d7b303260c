"""Table names per layer and table reads.

A ``Layers`` value routes ``(layer, table)`` to a storage location: either a
catalog table ``<schema>.<table>`` or a parquet directory ``<root>/<layer>/<table>``.
Each layer can be overridden (e.g. to point a run at test folders), the same
way the original per-layer dataset names could be.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from strata.sources import files
from strata.sources.publish import current


@dataclass(frozen=True)
class Layers:
    """Where each layer lives.

    ``root`` is a folder for path-based storage; ``catalog`` switches to
    ``saveAsTable``/``read.table`` with one schema per layer.  ``names`` maps a
    layer to its folder/schema name; ``external`` maps reference tables that
    live outside the layers (S5) to their full location.
    """

    root: str | None = None
    catalog: bool = False
    names: dict = field(default_factory=lambda: {"bronze": "bronze", "silver": "silver", "gold": "gold"})
    external: dict = field(default_factory=dict)

    def location(self, layer: str, table: str) -> str:
        if layer == "external":
            return self.external[table]
        name = self.names.get(layer, layer)
        if self.catalog:
            return f"{name}.{table}"
        if not self.root:
            raise ValueError("Layers.root is required for path-based storage")
        return f"{self.root.rstrip('/')}/{name}/{table}"


def read_table(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame:
    """Read a table by catalog name (``a.b``) or by path.

    A published table (``strata.sources.publish``) is read as its newest version.
    Column pruning and filters reach the parquet scan because nothing here
    materialises the frame.
    """
    if location.endswith(f".{fmt}"):
        return spark.read.format(fmt).load(location)
    if "/" in location:
        return spark.read.format(fmt).load(current(spark, location) or location)
    return spark.read.table(location)


def read_layer(spark: SparkSession, layers: Layers, layer: str, table: str) -> DataFrame:
    loc = layers.location(layer, table)
    return spark.read.table(loc) if layers.catalog and layer != "external" else read_table(spark, loc)


def layer_exists(spark: SparkSession, layers: Layers, layer: str, table: str) -> bool:
    """Whether a layer's table has been written."""
    loc = layers.location(layer, table)
    if layers.catalog and layer != "external":
        return spark.catalog.tableExists(loc)
    return current(spark, loc) is not None or files.exists(spark, loc)


class TableSet:
    """Driver test tables under one folder: ``TableSet(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, base: str):
        self._spark = spark
        self._base = base.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        """The table as a lazy DataFrame; listed and resolved once per TableSet."""
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = read_table(self._spark, f"{self._base}/{name}.parquet")
        return self._frames[name]

    def path(self, name: str) -> str:
        return f"{self._base}/{name}.parquet"
