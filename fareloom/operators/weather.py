"""Daily weather preparation and its join to trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions import expressions as X
from fareloom.session import written


def categorize_weather(weather: DataFrame) -> DataFrame:
    """Adds ``weather_condition``: snow, rain or clear."""
    return weather.withColumn(
        "weather_condition", X.weather_condition(F.col("SNOW"), F.col("PRCP"))
    )


def one_row_per_day(weather: DataFrame, day: str = "DATE") -> DataFrame:
    """Keep the snowiest, then wettest reading of each day, so that a join cannot multiply trips."""
    order = [name for name in ("SNOW", "PRCP", "STATION") if name in weather.columns]
    rest = [name for name in weather.columns if name not in (day, *order)]
    kept = F.max(F.struct(*order, *rest)).alias("kept")
    return weather.groupBy(day).agg(kept).select(
        *(F.col(day) if name == day else F.col(f"kept.{name}") for name in weather.columns)
    )


def repeated_days(weather: DataFrame, day: str = "DATE") -> DataFrame:
    """Days with more than one reading."""
    return weather.groupBy(day).agg(F.count(F.lit(1)).alias("readings")).filter("readings > 1")


def join_weather(
    trips: DataFrame, weather: DataFrame, pickup_date: str = "pickup_date", day: str = "DATE"
) -> DataFrame:
    """Every trip with the reading of its day; trips without one are dropped.

    The days are written once. From the size of that table the planner decides whether to broadcast
    it; else both sides are shuffled, and adaptive execution splits a day that many trips share.
    """
    days = written(one_row_per_day(weather, day), "days")
    return trips.join(days, trips[pickup_date] == days[day])
