"""Demand, revenue, tipping, price and weather reports.

``trips`` may be cleaned trips or a summary of them (``plans.measures``) that has the keys of the
report. Results are small; only they are sorted, never the trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.functions import expressions as X
from fareloom.plans.measures import Trips, TripSummary, mean, preaggregate, rows_of, total, trip_count
from fareloom.schema import WEATHER_CONDITIONS, WEEKEND


def hourly_demand(
    trips: Trips, hour: str = "pickup_hour", weekday: str = "day_of_week"
) -> DataFrame:
    """Trips by hour and weekday."""
    return (
        rows_of(trips).groupBy(hour, weekday)
        .agg(trip_count(trips).alias("trip_count"))
        .orderBy(weekday, hour)
    )


def zone_revenue(trips: Trips, zone: str = "PULocationID") -> DataFrame:
    """Fares and trips by pickup zone, highest revenue first."""
    return (
        rows_of(trips).groupBy(zone)
        .agg(
            X.to_cents(total(trips, "fare")).alias("total_revenue"),
            X.to_cents(mean(trips, "fare")).alias("avg_fare"),
            trip_count(trips).alias("trip_count"),
        )
        .orderBy(F.desc("total_revenue"), zone)
    )


def top_zone_revenue(trips: Trips, zones: int = 20, zone: str = "PULocationID") -> DataFrame:
    """The zones with the highest revenue; each task keeps only its own best rows."""
    return zone_revenue(trips, zone).limit(zones)


def distance_profile(trips: Trips, bucket: str = "distance_bucket") -> DataFrame:
    """Tipping and price by distance bucket in one pass.

    Reports that select from it pay only for the columns they take.
    """
    return rows_of(trips).groupBy(bucket).agg(
        X.to_cents(mean(trips, "tip_pct")).alias("avg_tip_pct"),
        X.to_cents(mean(trips, "tip")).alias("avg_tip_amount"),
        X.to_cents(mean(trips, "fare_per_mile")).alias("avg_fare_per_mile"),
        X.to_cents(mean(trips, "fare")).alias("avg_fare"),
        X.to_cents(mean(trips, "distance")).alias("avg_distance"),
        trip_count(trips).alias("trip_count"),
    )


def tipping_by_distance(trips: Trips, bucket: str = "distance_bucket") -> DataFrame:
    """Average tip share (the mean of each trip's share) and tip by distance bucket.

    Free trips have no tip share; they still count as trips.
    """
    return (
        distance_profile(trips, bucket)
        .select(bucket, "avg_tip_pct", "avg_tip_amount", "trip_count")
        .orderBy(bucket)
    )


def fare_per_mile(trips: Trips, bucket: str = "distance_bucket") -> DataFrame:
    """Average price per mile by distance bucket."""
    return (
        distance_profile(trips, bucket)
        .select(bucket, "avg_fare_per_mile", "avg_fare", "avg_distance", "trip_count")
        .orderBy(bucket)
    )


def _per_day(trips: Trips, pickup_date: str) -> TripSummary:
    """Trips reduced to one row per date before they meet the weather."""
    if isinstance(trips, TripSummary):
        return trips
    return preaggregate(trips, [pickup_date], only=("fare", "distance"))


def _days(weather: DataFrame, day: str, conditions: Sequence[str]) -> DataFrame:
    """One condition per day, the gravest of several readings.

    Conditions are compared as ranks: a number aggregates by hash, text would need a sort.
    """
    names = F.array(*(F.lit(name) for name in conditions))
    rank = F.array_position(names, F.col("weather_condition"))
    unknown = F.raise_error(F.concat(F.lit("unknown weather_condition: "), "weather_condition"))
    gravest = F.max(F.when(rank == 0, unknown).otherwise(rank)).alias("rank")
    return (
        weather.groupBy(day)
        .agg(gravest)
        .select(day, F.element_at(names, F.col("rank").cast("int")).alias("weather_condition"))
    )


def demand_by_weather(
    trips: Trips,
    weather: DataFrame,
    pickup_date: str = "pickup_date",
    day: str = "DATE",
    conditions: Sequence[str] = WEATHER_CONDITIONS,
) -> DataFrame:
    """Trips, average fare and distance by the weather of the day.

    ``conditions`` lists the weather names from mildest to gravest; the gravest of a day counts.
    Both sides are reduced to one row per day first, so neither trips nor a hot date are shuffled.
    The join itself is left to adaptive execution, which broadcasts the days at their measured size
    if that is below its threshold and merges sorted partitions otherwise.
    """
    daily = _per_day(trips, pickup_date)
    days = _days(weather, day, conditions)
    return (
        daily.table.join(days, daily.table[pickup_date] == days[day])
        .groupBy("weather_condition")
        .agg(
            trip_count(daily).alias("trip_count"),
            X.to_cents(mean(daily, "fare")).alias("avg_fare"),
            X.to_cents(mean(daily, "distance")).alias("avg_distance"),
        )
        .orderBy("weather_condition")
    )


def unmatched_trips(
    trips: Trips, weather: DataFrame, pickup_date: str = "pickup_date", day: str = "DATE"
) -> DataFrame:
    """How many trips ``demand_by_weather`` leaves out because their day has no reading."""
    daily = _per_day(trips, pickup_date)
    missing = daily.table.join(weather, daily.table[pickup_date] == weather[day], "left_anti")
    return missing.agg(F.coalesce(trip_count(daily), F.lit(0)).alias("unmatched_trips"))


def weather_share(by_weather: DataFrame) -> DataFrame:
    """The weather report with each condition's share of all its trips in percent."""
    everything = F.sum("trip_count").over(Window.partitionBy())
    share = F.round(X.percent(F.col("trip_count"), everything), 1)
    return by_weather.withColumn("share_pct", share)


def headline(trips: Trips) -> DataFrame:
    """Trips, revenue and average fare overall."""
    return rows_of(trips).agg(
        trip_count(trips).alias("trip_count"),
        X.to_cents(total(trips, "fare")).alias("total_revenue"),
        X.to_cents(mean(trips, "fare")).alias("avg_fare"),
    )


def weekday_split(hourly: DataFrame, top: int = 3) -> DataFrame:
    """Weekday and weekend trips, their share, and the busiest hours of each.

    Works on the hourly report, whose size is fixed, so its windows are tiny.
    """
    day_class = F.when(F.col("day_of_week").isin(*WEEKEND), "weekend").otherwise("weekday")
    by_hour = (
        hourly.groupBy(day_class.alias("day_class"), "pickup_hour")
        .agg(F.sum("trip_count").alias("hour_trips"))
    )
    of_class = Window.partitionBy("day_class")
    busiest = of_class.orderBy(F.desc("hour_trips"), "pickup_hour")
    everything = F.sum("hour_trips").over(Window.partitionBy())
    class_trips = F.sum("hour_trips").over(of_class)
    return (
        by_hour.select(
            "day_class",
            class_trips.alias("trip_count"),
            F.round(X.percent(class_trips, everything), 1).alias("share_pct"),
            F.row_number().over(busiest).alias("hour_rank"),
            "pickup_hour",
            "hour_trips",
        )
        .filter(F.col("hour_rank") <= top)
        .orderBy("day_class", "hour_rank")
    )


def peak_hours(hourly: DataFrame, top: int = 3) -> DataFrame:
    """The busiest hours of the day over all weekdays, from the hourly report."""
    return (
        hourly.groupBy("pickup_hour")
        .agg(F.sum("trip_count").alias("trip_count"))
        .orderBy(F.desc("trip_count"), "pickup_hour")
        .limit(top)
    )
