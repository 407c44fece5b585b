"""Readers."""

from fareloom.sources.lookups import (
    read_metrics,
    read_metrics_map,
    read_model,
    read_result,
    read_zones,
    requests_from_rows,
)
from fareloom.sources.trips import read_clean_trips, read_trips, read_trips_pinned
from fareloom.sources.weather import extract_weather, read_weather

__all__ = [
    "extract_weather",
    "read_clean_trips",
    "read_metrics",
    "read_metrics_map",
    "read_model",
    "read_result",
    "read_trips",
    "read_trips_pinned",
    "read_weather",
    "read_zones",
    "requests_from_rows",
]
