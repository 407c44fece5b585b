"""Profiling operators and the demand reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareloom.jobs.explore import SAMPLED
from fareloom.operators import demand as D
from fareloom.operators import profile as P
from fareloom.plans.sql_reports import sql_report
from fareloom.registry import sql as S
from fareloom.registry import tables as T
from fareloom.registry.entries import Entry
from fareloom.schema import TRIP_COLUMNS
from fareloom.sinks import preview


def _raw(operator, *args):
    return lambda spark, folder: operator(T.raw_trips(spark, folder), *args)


def _clean(operator, *args):
    return lambda spark, folder: operator(T.clean(spark, folder), *args)


def _sorted(operator):
    return lambda spark, folder: T.in_order(operator(T.clean(spark, folder)))


def _weather(operator):
    return lambda spark, folder: operator(T.clean(spark, folder), T.weather_days(spark, folder))


def _sql(name):
    return lambda spark, folder: sql_report(name, T.raw_trips(spark, folder))


def _rounded_statistics(raw):
    return P.describe(raw).select(
        "column_name",
        "value_count",
        *(F.round(name, 6).alias(name) for name in ("mean", "stddev", "min", "max")),
    )


def _sample(raw):
    text = F.col("tpep_pickup_datetime").cast("string").alias("tpep_pickup_datetime")
    order = (*T.KEYS, "fare_amount", "trip_distance", "PULocationID", "DOLocationID")
    return preview(raw, 10, (*T.KEYS, *SAMPLED), order).withColumn("tpep_pickup_datetime", text)


_SCHEMA_SQL = " UNION ALL ".join(
    f"""SELECT {position} AS position, '{name}' AS column_name, '{kind}' AS data_type,
    {'FALSE' if name in ('mta_tax', 'improvement_surcharge', 'store_and_fwd_flag',
                         'congestion_surcharge') else 'TRUE'} AS nullable,
    count(*) - count({name}) AS null_count FROM raw"""
    for position, (name, kind) in enumerate(TRIP_COLUMNS.items(), 1)
)

_STATISTICS_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS column_name, count({name}) AS value_count,
    round(avg({name}), 6) AS mean, round(stddev_samp({name}), 6) AS stddev,
    round(CAST(min({name}) AS DOUBLE), 6) AS min, round(CAST(max({name}) AS DOUBLE), 6) AS max
    FROM raw"""
    for name in P.DESCRIBED
)

ENTRIES = {
    "schema_report": Entry(
        lambda spark, folder: P.schema_report(T.raw_trips(spark, folder).drop(*T.KEYS)),
        S.query(_SCHEMA_SQL, S.RAW),
    ),
    "row_count": Entry(
        _raw(P.row_count), S.query("SELECT count(*) AS row_count FROM raw", S.RAW)
    ),
    "describe": Entry(_raw(_rounded_statistics), S.query(_STATISTICS_SQL, S.RAW)),
    "null_counts": Entry(
        _raw(P.null_counts),
        S.query(
            "SELECT "
            + ", ".join(
                f"count(*) FILTER ({name} IS NULL"
                + (f" OR isnan({name})" if TRIP_COLUMNS[name] == "double" else "")
                + f") AS {name}"
                for name in P.CHECKED
            )
            + " FROM raw",
            S.RAW,
        ),
    ),
    "sample_rows": Entry(
        _raw(_sample),
        S.query(
            """SELECT l_orderkey, l_linenumber,
            CAST(tpep_pickup_datetime AS VARCHAR) AS tpep_pickup_datetime, PULocationID,
            DOLocationID, trip_distance, fare_amount, tip_amount, payment_type FROM raw
            ORDER BY l_orderkey, l_linenumber, fare_amount NULLS FIRST, trip_distance,
            PULocationID, DOLocationID LIMIT 10""",
            S.RAW,
        ),
    ),
    "audit_before_after": Entry(
        _raw(P.audit_cleaning),
        S.query(
            """SELECT *, raw_rows - clean_rows AS dropped_rows,
            round((raw_rows - clean_rows) / raw_rows * 100, 2) AS drop_rate_pct
            FROM (SELECT count(*) AS raw_rows,
              count(*) FILTER (trip_distance > 0 AND fare_amount >= 0 AND total_amount >= 0)
                AS clean_rows,
              count(*) FILTER (passenger_count IS NULL OR isnan(passenger_count))
                AS missing_passengers,
              count(*) FILTER (fare_amount IS NULL) AS null_fare,
              count(*) FILTER (trip_distance <= 0) AS distance_not_positive,
              count(*) FILTER (fare_amount < 0) AS negative_fare,
              count(*) FILTER (total_amount < 0) AS negative_total,
              count(*) FILTER (fare_amount > 500) AS fare_over_ceiling,
              count(*) FILTER (total_amount > 600) AS total_over_ceiling,
              count(*) FILTER (isnan(trip_distance)) AS nan_distance,
              max(fare_amount) AS highest_fare, max(total_amount) AS highest_total
            FROM raw)""",
            S.RAW,
        ),
    ),
    "data_facts": Entry(
        _raw(P.data_facts),
        S.query(
            """SELECT count(*) AS trip_count, quantile_cont(trip_distance, 0.5) AS median_distance,
            round(count(*) FILTER (trip_distance < 3) / count(*) * 100, 1) AS near_pct,
            round(avg(fare_amount), 2) AS avg_fare, round(avg(total_amount), 2) AS avg_total,
            round(count(*) FILTER (payment_type = 1) / count(*) * 100, 1) AS credit_card_pct,
            round(count(*) FILTER (payment_type = 2) / count(*) * 100, 1) AS cash_pct,
            count(*) FILTER (trip_distance = 0) AS zero_distance,
            count(*) FILTER (fare_amount < 0) AS negative_fare FROM raw""",
            S.RAW,
        ),
    ),
    "hourly_demand": Entry(
        _sorted(D.hourly_demand),
        S.query(S.ordered("hourly", "day_of_week", "pickup_hour"), S.CLEAN, S.HOURLY),
    ),
    "zone_revenue": Entry(
        _sorted(D.zone_revenue),
        S.query(S.ordered("revenue", "total_revenue DESC", "PULocationID"), S.CLEAN, S.REVENUE),
    ),
    "zone_revenue_top20": Entry(
        _clean(D.top_zone_revenue),
        S.query(
            "SELECT * FROM revenue ORDER BY total_revenue DESC, PULocationID LIMIT 20",
            S.CLEAN,
            S.REVENUE,
        ),
    ),
    "tipping_by_distance": Entry(
        _sorted(D.tipping_by_distance),
        S.query(S.ordered("tipping", "distance_bucket"), S.CLEAN, S.TIPPING),
    ),
    "fare_per_mile": Entry(
        _sorted(D.fare_per_mile),
        S.query(S.ordered("price", "distance_bucket"), S.CLEAN, S.PRICE),
    ),
    "distance_profile": Entry(
        _clean(D.distance_profile),
        S.query(
            """SELECT tipping.*, avg_fare_per_mile, avg_fare, avg_distance
            FROM tipping JOIN price USING (distance_bucket)""",
            S.CLEAN,
            S.TIPPING,
            S.PRICE,
        ),
    ),
    "demand_by_weather": Entry(
        lambda spark, folder: T.in_order(_weather(D.demand_by_weather)(spark, folder)),
        S.query(S.ordered("by_weather", "weather_condition"), S.CLEAN, S.WEATHER, S.BY_WEATHER),
    ),
    "weather_share": Entry(
        lambda spark, folder: D.weather_share(
            D.demand_by_weather(T.clean(spark, folder), T.weather_days(spark, folder))
        ),
        S.query(
            """SELECT *, round(trip_count / sum(trip_count) OVER () * 100, 1) AS share_pct
            FROM by_weather""",
            S.CLEAN,
            S.WEATHER,
            S.BY_WEATHER,
        ),
    ),
    "unmatched_weather": Entry(
        _weather(D.unmatched_trips),
        S.query(
            """SELECT count(*) AS unmatched_trips FROM clean
            WHERE NOT EXISTS (SELECT 1 FROM days WHERE DATE = pickup_date)""",
            S.CLEAN,
            S.WEATHER,
        ),
    ),
    "headline": Entry(
        _clean(D.headline),
        S.query(
            """SELECT count(*) AS trip_count, round(sum(fare_amount), 2) AS total_revenue,
            round(avg(fare_amount), 2) AS avg_fare FROM clean""",
            S.CLEAN,
        ),
    ),
    "weekday_split": Entry(
        lambda spark, folder: D.weekday_split(D.hourly_demand(T.clean(spark, folder))),
        S.query(
            """SELECT * FROM (
              SELECT day_class,
                CAST(sum(hour_trips) OVER (PARTITION BY day_class) AS BIGINT) AS trip_count,
                round(sum(hour_trips) OVER (PARTITION BY day_class)
                  / sum(hour_trips) OVER () * 100, 1) AS share_pct,
                CAST(row_number() OVER (PARTITION BY day_class
                  ORDER BY hour_trips DESC, pickup_hour) AS INTEGER) AS hour_rank,
                pickup_hour, CAST(hour_trips AS BIGINT) AS hour_trips
              FROM (SELECT CASE WHEN day_of_week IN (1, 7) THEN 'weekend' ELSE 'weekday' END
                      AS day_class, pickup_hour, sum(trip_count) AS hour_trips
                    FROM hourly GROUP BY ALL))
            WHERE hour_rank <= 3""",
            S.CLEAN,
            S.HOURLY,
        ),
    ),
    "peak_hours": Entry(
        lambda spark, folder: D.peak_hours(D.hourly_demand(T.clean(spark, folder))),
        S.query(
            """SELECT pickup_hour, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM hourly
            GROUP BY pickup_hour ORDER BY sum(trip_count) DESC, pickup_hour LIMIT 3""",
            S.CLEAN,
            S.HOURLY,
        ),
    ),
    "sql_hourly_demand": Entry(
        _sql("hourly_demand"),
        S.query(
            """SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
            CAST(isodow(tpep_pickup_datetime) AS INTEGER) AS day_of_week,
            count(*) AS trip_count FROM raw GROUP BY ALL""",
            S.RAW,
        ),
    ),
    "sql_zone_revenue": Entry(
        _sql("zone_revenue"),
        S.query(
            """SELECT PULocationID, round(sum(fare_amount), 2) AS total_revenue,
            round(avg(fare_amount), 2) AS avg_fare, count(*) AS trip_count FROM raw
            GROUP BY PULocationID ORDER BY total_revenue DESC, PULocationID LIMIT 20""",
            S.RAW,
        ),
    ),
    "sql_tipping": Entry(
        _sql("tipping"),
        S.query(
            f"""SELECT {S.DISTANCE_BUCKET} AS distance_bucket,
            round(avg(tip_amount / fare_amount * 100), 2) AS avg_tip_pct,
            round(avg(tip_amount), 2) AS avg_tip_amount, count(*) AS trip_count
            FROM raw WHERE fare_amount > 0 GROUP BY 1""",
            S.RAW,
        ),
    ),
    "sql_fare_per_mile": Entry(
        _sql("fare_per_mile"),
        S.query(
            f"""SELECT {S.DISTANCE_BUCKET} AS distance_bucket,
            round(avg(fare_amount / trip_distance), 2) AS avg_fare_per_mile,
            round(avg(fare_amount), 2) AS avg_fare,
            round(avg(trip_distance), 2) AS avg_distance, count(*) AS trip_count
            FROM raw WHERE trip_distance > 0 GROUP BY 1""",
            S.RAW,
        ),
    ),
}
