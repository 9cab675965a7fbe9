"""Column-level rules. Every function maps Columns to a Column and stays JVM-side."""

from .report import (extract_host, map_component, map_status, parse_period_date,
                     size_bytes, size_gib)
from .timeparts import day_string, hour_of, hour_start, hour_string, to_day

__all__ = [
    "extract_host", "map_component", "map_status", "parse_period_date", "size_bytes",
    "size_gib", "day_string", "hour_of", "hour_start", "hour_string", "to_day",
]
