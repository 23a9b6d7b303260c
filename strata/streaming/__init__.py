from strata.streaming.measurements import (
    compact_latest, enriched, latest_per_key_stream, parse_measurements, read_latest, resolve_latest, start_latest_stream,
)

__all__ = [n for n in dir() if not n.startswith("_")]
