"""The query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    """A query over the tables of a folder and, where SQL can say it, the same in SQL."""

    build: Build
    sql: str | None = None


def entries() -> dict[str, Entry]:
    from fareloom.registry import cleaning, modelling, profiling, reporting, storage, weather

    merged: dict[str, Entry] = {}
    for module in (cleaning, profiling, reporting, weather, storage, modelling):
        for name, entry in module.ENTRIES.items():
            if name in merged:
                raise ValueError(f"query {name} is registered twice")
            merged[name] = entry
    return merged
