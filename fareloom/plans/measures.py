"""Pre-aggregated trip measures.

Every report counts trips and averages a few measures, so all of them can be answered from sums and
counts. ``preaggregate`` reduces trips to one row per key combination, with a partial aggregation in
every task before anything is shuffled: a key that holds a third of all trips costs no more than any
other. The reports of ``operators.demand`` accept either trips or such a summary.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions import expressions as X

# The grain that answers every report by date, hour, weekday, distance bucket or weather. Its size
# depends on the number of days covered, not on the number of trips.
SUMMARY_KEYS = ("pickup_date", "pickup_hour", "day_of_week", "distance_bucket")


def measures() -> dict[str, Column]:
    fare, tip, distance = F.col("fare_amount"), F.col("tip_amount"), F.col("trip_distance")
    return {
        "fare": fare,
        "distance": distance,
        "tip": tip,
        "tip_pct": X.percent(tip, fare),
        "fare_per_mile": X.ratio(fare, distance),
    }


@dataclass(frozen=True)
class TripSummary:
    """A table with ``trips``, ``<measure>_sum`` and ``<measure>_n`` per combination of keys."""

    table: DataFrame


Trips = DataFrame | TripSummary


def preaggregate(
    trips: DataFrame, keys: Sequence[str], only: Sequence[str] | None = None
) -> TripSummary:
    """Trips reduced to one row per combination of keys, for all measures or ``only`` some."""
    parts = [F.count(F.lit(1)).alias("trips")]
    for name, value in measures().items():
        if only is None or name in only:
            parts += [F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_n")]
    return TripSummary(trips.groupBy(*keys).agg(*parts))


def trip_summary(trips: DataFrame) -> TripSummary:
    """One scan of the trips that serves all reports but the ones by zone."""
    return preaggregate(trips, SUMMARY_KEYS)


def rows_of(source: Trips) -> DataFrame:
    return source.table if isinstance(source, TripSummary) else source


def trip_count(source: Trips) -> Column:
    return F.sum("trips") if isinstance(source, TripSummary) else F.count(F.lit(1))


def total(source: Trips, measure: str) -> Column:
    summed = isinstance(source, TripSummary)
    return F.sum(f"{measure}_sum") if summed else F.sum(measures()[measure])


def mean(source: Trips, measure: str) -> Column:
    if isinstance(source, TripSummary):
        return F.try_divide(F.sum(f"{measure}_sum"), F.sum(f"{measure}_n"))
    return F.avg(measures()[measure])
