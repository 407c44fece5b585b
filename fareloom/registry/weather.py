"""Weather preparation, its joins to trips, and the reports on daily summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareloom.operators import daily_summary as G
from fareloom.operators.weather import categorize_weather, join_weather
from fareloom.registry import sql as S
from fareloom.registry import tables as T
from fareloom.registry.entries import Entry

READINGS = ("STATION", "DATE", "TEMP", "PRCP", "WDSP", "SNDP")


def _conditions(spark, folder):
    days = categorize_weather(T.weather(spark, folder))
    return days.select("STATION", F.col("DATE").cast("string"), "PRCP", "SNOW", "weather_condition")


def _trips_with_weather(spark, folder):
    joined = join_weather(T.clean(spark, folder), T.weather_days(spark, folder))
    return joined.select(*T.KEYS, F.col("DATE").cast("string"), "PRCP", "SNOW", "weather_condition")


def _banded(spark, folder):
    return G.bin_summary(G.impute_summary(T.summary_days(spark, folder)))


def _joined(spark, folder):
    return G.join_summary(T.clean(spark, folder), _banded(spark, folder))


def _report(operator):
    return lambda spark, folder: operator(T.clean(spark, folder), _banded(spark, folder))


ENTRIES = {
    "weather_condition": Entry(
        _conditions,
        S.query(
            """SELECT STATION, CAST(DATE AS VARCHAR) AS DATE, PRCP, SNOW, weather_condition
            FROM days""",
            S.WEATHER,
        ),
    ),
    "trips_with_weather": Entry(
        _trips_with_weather,
        S.query(
            """SELECT l_orderkey, l_linenumber, CAST(DATE AS VARCHAR) AS DATE, PRCP, SNOW,
            weather_condition FROM clean JOIN days ON pickup_date = DATE""",
            S.CLEAN,
            S.WEATHER,
        ),
    ),
    "summary_impute": Entry(
        lambda spark, folder: G.impute_summary(T.summary_days(spark, folder)).select(*READINGS),
        S.query(
            """SELECT STATION, CAST(DATE AS VARCHAR) AS DATE, TEMP, PRCP, WDSP, SNDP
            FROM measured""",
            S.SUMMARY,
        ),
    ),
    "summary_bins": Entry(
        lambda spark, folder: _banded(spark, folder).select(
            "STATION", "DATE", "temp_bucket", "prcp_bucket"
        ),
        S.query(
            """SELECT STATION, CAST(DATE AS VARCHAR) AS DATE, temp_bucket, prcp_bucket
            FROM banded""",
            S.SUMMARY,
        ),
    ),
    "trips_with_summary": Entry(
        lambda spark, folder: _joined(spark, folder).select(
            *T.KEYS, "DATE", "TEMP", "temp_bucket", "prcp_bucket"
        ),
        S.query(
            """SELECT l_orderkey, l_linenumber, CAST(DATE AS VARCHAR) AS DATE, TEMP, temp_bucket,
            prcp_bucket FROM joined""",
            S.CLEAN,
            S.SUMMARY,
            S.JOINED,
        ),
    ),
    "precipitation_effect": Entry(
        _report(G.precipitation_effect),
        S.query(
            """SELECT prcp_bucket, round(avg(fare_amount), 2) AS avg_fare,
            round(avg(trip_distance), 2) AS avg_distance,
            round(avg(tip_amount) / avg(fare_amount) * 100, 1) AS avg_tip_pct,
            count(*) AS trip_count FROM joined GROUP BY prcp_bucket""",
            S.CLEAN,
            S.SUMMARY,
            S.JOINED,
        ),
    ),
    "hourly_demand_by_temp": Entry(
        _report(G.hourly_demand_by_temperature),
        S.query(
            """SELECT pickup_hour, temp_bucket, count(*) AS trip_count FROM joined
            GROUP BY ALL""",
            S.CLEAN,
            S.SUMMARY,
            S.JOINED,
        ),
    ),
    "zone_weather_sensitivity": Entry(
        _report(G.zone_weather_sensitivity),
        S.query(
            """SELECT PULocationID,
            count(*) FILTER (prcp_bucket <> 'dry') AS rainy_trips,
            count(*) FILTER (prcp_bucket = 'dry') AS dry_trips,
            round(count(*) FILTER (prcp_bucket <> 'dry') / any_value(rainy_days), 4) AS rainy_per_day,
            round(count(*) FILTER (prcp_bucket = 'dry') / any_value(dry_days), 4) AS dry_per_day,
            round(count(*) FILTER (prcp_bucket <> 'dry') / any_value(rainy_days)
              - count(*) FILTER (prcp_bucket = 'dry') / any_value(dry_days), 4) AS rain_delta
            FROM joined, (SELECT count(DISTINCT pickup_date) FILTER (prcp_bucket <> 'dry') AS rainy_days,
              count(DISTINCT pickup_date) FILTER (prcp_bucket = 'dry') AS dry_days FROM joined)
            GROUP BY PULocationID""",
            S.CLEAN,
            S.SUMMARY,
            S.JOINED,
        ),
    ),
    "snowstorm_impact": Entry(
        _report(G.snowstorm_impact),
        S.query(
            """SELECT CASE WHEN SNDP > 1 THEN 'snow' ELSE 'no_snow' END AS snow_condition,
            round(avg(fare_amount), 2) AS avg_fare, round(avg(trip_distance), 2) AS avg_distance,
            round(avg(fare_amount) / avg(trip_distance), 2) AS fare_per_mile,
            count(*) AS trip_count FROM joined GROUP BY 1""",
            S.CLEAN,
            S.SUMMARY,
            S.JOINED,
        ),
    ),
}
