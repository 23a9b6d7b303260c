from strata.sources import files, publish
from strata.sources.bronze import ingest, stamp
from strata.sources.landing import landed_messages
from strata.sources.ranges import year_range, years_between
from strata.sources.sinks import clustered, materialize, write_layer, write_table
from strata.sources.tables import Layers, TableSet, layer_exists, read_layer, read_table

__all__ = [n for n in dir() if not n.startswith("_")]
