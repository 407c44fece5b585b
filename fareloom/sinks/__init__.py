"""Writers."""

from fareloom.sinks.tables import (
    preview,
    save_model,
    write_csv,
    write_metrics,
    write_results,
    write_trips,
)

__all__ = ["preview", "save_model", "write_csv", "write_metrics", "write_results", "write_trips"]
