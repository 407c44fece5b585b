"""Readers and writers: each query writes to the shared folder and returns what it reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareloom.jobs import analytics
from fareloom.operators import demand as D
from fareloom.operators.weather import categorize_weather
from fareloom.registry import sql as S
from fareloom.registry import tables as T
from fareloom.registry.entries import Entry
from fareloom.registry.reporting import plain_metrics
from fareloom.schema import TRIP_COLUMNS
from fareloom.session import shared_folder
from fareloom.sinks import write_csv, write_metrics, write_trips
from fareloom.sources import (
    extract_weather,
    read_clean_trips,
    read_metrics,
    read_trips_pinned,
    read_weather,
    read_zones,
)

PERIOD = ("1996-01-01", "1999-12-31")
STORED = (*T.KEYS, "PULocationID", "trip_distance", "fare_amount", "distance_bucket")
TIMESTAMPS = ("tpep_pickup_datetime", "tpep_dropoff_datetime")


def _date_text(name):
    return F.col(name).cast("string").alias(name)


def _ingested(spark, folder):
    return extract_weather(spark, T.station_file(spark, folder), *PERIOD)


def _loaded(spark, folder):
    days = categorize_weather(read_weather(spark, T.station_file(spark, folder)))
    return days.withColumn("DATE", _date_text("DATE"))


def _drift(spark, folder):
    trips = read_trips_pinned(spark, T.drifting_files(spark, folder))
    return trips.select(
        *(_date_text(name) if name in TIMESTAMPS else name for name in TRIP_COLUMNS),
        "year",
        "month",
    )


def _round_trip(spark, folder):
    path = shared_folder(spark, "clean")
    write_trips(T.clean(spark, folder), path)
    return read_clean_trips(spark, path).select(*STORED)


def _partitioned(spark, folder):
    path = shared_folder(spark, "clean-by-month")
    write_trips(
        T.with_months(T.clean(spark, folder)), path, ("year", "month"), rebalance=True
    )
    return read_clean_trips(spark, path).select(*STORED, "year", "month")


def _pruned(spark, folder):
    path = shared_folder(spark, "clean-by-month")
    write_trips(
        T.with_months(T.clean(spark, folder)), path, ("year", "month"), rebalance=True
    )
    return D.headline(read_clean_trips(spark, path, since=(1996, 3), until=(1998, 10)))


def _results(spark, folder):
    """The five result tables in one long form: table, key, trips and first measure."""
    written = analytics.run(
        T.clean(spark, folder), T.weather_days(spark, folder), shared_folder(spark, "results")
    )
    key = {
        "q1_hourly_demand": F.concat_ws("/", "day_of_week", "pickup_hour"),
        "q2_zone_revenue": F.col("PULocationID").cast("string"),
        "q3_tipping": F.col("distance_bucket"),
        "q4_fare_per_mile": F.col("distance_bucket"),
        "q5_weather_demand": F.col("weather_condition"),
    }
    measure = {
        "q1_hourly_demand": F.lit(None).cast("double"),
        "q2_zone_revenue": F.col("total_revenue"),
        "q3_tipping": F.col("avg_tip_pct"),
        "q4_fare_per_mile": F.col("avg_fare_per_mile"),
        "q5_weather_demand": F.col("avg_fare"),
    }
    parts = [
        table.select(
            F.lit(name).alias("result"),
            key[name].alias("key"),
            "trip_count",
            measure[name].alias("measure"),
        )
        for name, table in written.items()
    ]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def _csv(spark, folder):
    path = shared_folder(spark, "zone-revenue-csv")
    write_csv(D.zone_revenue(T.clean(spark, folder)), path, single_file=True)
    columns = "PULocationID bigint, total_revenue double, avg_fare double, trip_count bigint"
    return spark.read.option("header", True).schema(columns).csv(path)


def _zone_file(spark, folder):
    path = shared_folder(spark, "zones")
    write_csv(
        T.zones(spark, folder).select("LocationID", "Borough", "Zone", "service_zone"), path
    )
    return read_zones(spark, path)


def _metrics(spark, folder):
    path = shared_folder(spark, "metrics")
    write_metrics(plain_metrics(spark, folder), path)
    return read_metrics(spark, path).withColumns(
        {name: F.round(name, 6) for name in ("rmse", "r2")}
    )


_STORED_SQL = ", ".join(STORED)

ENTRIES = {
    "weather_ingest": Entry(
        _ingested,
        S.query(
            f"""SELECT STATION, CAST(DATE AS VARCHAR) AS DATE,
            CASE WHEN PRCP > 0 THEN CAST(PRCP AS VARCHAR) ELSE '0' END AS PRCP,
            CAST(SNOW AS VARCHAR) AS SNOW
            FROM weather WHERE DATE BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}'""",
            S.WEATHER,
        ),
    ),
    "weather_load": Entry(
        _loaded,
        S.query(
            """SELECT STATION, CAST(DATE AS VARCHAR) AS DATE, greatest(PRCP, 0) AS PRCP, SNOW,
            weather_condition FROM days""",
            S.WEATHER,
        ),
    ),
    "schema_drift_read": Entry(
        _drift,
        S.query(
            "SELECT * EXCLUDE (l_orderkey, l_linenumber) REPLACE ("
            + ", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in TIMESTAMPS)
            + """, CASE WHEN year(tpep_pickup_datetime) % 3 = 0 THEN NULL
              ELSE congestion_surcharge END AS congestion_surcharge),
            CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
            CAST(month(tpep_pickup_datetime) AS INTEGER) AS month FROM raw""",
            S.RAW,
        ),
    ),
    "clean_roundtrip": Entry(_round_trip, S.query(f"SELECT {_STORED_SQL} FROM clean", S.CLEAN)),
    "partitioned_roundtrip": Entry(
        _partitioned, S.query(f"SELECT {_STORED_SQL}, year, month FROM clean", S.CLEAN)
    ),
    "months_read": Entry(
        _pruned,
        S.query(
            """SELECT count(*) AS trip_count, round(sum(fare_amount), 2) AS total_revenue,
            round(avg(fare_amount), 2) AS avg_fare FROM clean
            WHERE year * 100 + month BETWEEN 199603 AND 199810""",
            S.CLEAN,
        ),
    ),
    "results_roundtrip": Entry(
        _results,
        S.query(
            """SELECT 'q1_hourly_demand' AS result, day_of_week || '/' || pickup_hour AS key,
              trip_count, CAST(NULL AS DOUBLE) AS measure FROM hourly
            UNION ALL SELECT 'q2_zone_revenue', CAST(PULocationID AS VARCHAR), trip_count,
              total_revenue FROM revenue
            UNION ALL SELECT 'q3_tipping', distance_bucket, trip_count, avg_tip_pct FROM tipping
            UNION ALL SELECT 'q4_fare_per_mile', distance_bucket, trip_count, avg_fare_per_mile
              FROM price
            UNION ALL SELECT 'q5_weather_demand', weather_condition, trip_count, avg_fare
              FROM by_weather""",
            S.CLEAN,
            S.WEATHER,
            S.HOURLY,
            S.REVENUE,
            S.TIPPING,
            S.PRICE,
            S.BY_WEATHER,
        ),
    ),
    "csv_roundtrip": Entry(_csv, S.query("SELECT * FROM revenue", S.CLEAN, S.REVENUE)),
    "zones_load": Entry(
        _zone_file,
        S.query(
            """SELECT CAST(LocationID AS INTEGER) AS LocationID, Borough, Zone,
            'Yellow Zone' AS service_zone FROM zones""",
            S.ZONES,
        ),
    ),
    "metrics_roundtrip": Entry(
        _metrics,
        S.query(
            """SELECT position, model, round(rmse, 6) AS rmse, round(r2, 6) AS r2
            FROM metrics""",
            S.CLEAN,
            S.METRICS,
        ),
    ),
}
