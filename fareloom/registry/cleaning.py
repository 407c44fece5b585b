"""Cleaning operators, one query each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.operators import clean as C
from fareloom.registry import sql as S
from fareloom.registry import tables as T
from fareloom.registry.entries import Entry

KEY_SQL = "l_orderkey, l_linenumber"


def _shown(name: str) -> Column:
    """Dates as text and norms rounded, so that both engines print them alike."""
    column = F.col(name)
    if name == "pickup_date":
        column = column.cast("string")
    if name in C.SCALED.values():
        column = F.round(column, 6)
    return column.alias(name)


def _on_raw(operator, *columns):
    def build(spark, folder) -> DataFrame:
        return operator(T.raw_trips(spark, folder)).select(*T.KEYS, *map(_shown, columns))

    return build


def _scaled(raw: DataFrame) -> DataFrame:
    return raw.transform(C.fill_missing).transform(C.drop_and_cap).transform(C.scale_to_unit)


ENTRIES = {
    "calendar": Entry(
        _on_raw(C.add_calendar, "pickup_date", "pickup_hour", "day_of_week"),
        S.query(
            f"""SELECT {KEY_SQL}, CAST(pickup_date AS VARCHAR) AS pickup_date, pickup_hour,
            day_of_week FROM (SELECT *, {S.CALENDAR} FROM raw)""",
            S.RAW,
        ),
    ),
    "impute": Entry(
        _on_raw(C.fill_missing, "passenger_count", "fare_amount"),
        S.query(
            f"""SELECT {KEY_SQL}, coalesce(passenger_count, 1) AS passenger_count, fare_amount
            FROM raw WHERE fare_amount IS NOT NULL""",
            S.RAW,
        ),
    ),
    "remove_outliers": Entry(
        _on_raw(C.drop_and_cap, "trip_distance", "fare_amount", "total_amount"),
        S.query(
            f"SELECT {KEY_SQL}, trip_distance, fare_amount, total_amount FROM capped", S.CLEAN
        ),
    ),
    "normalize": Entry(
        _on_raw(_scaled, *C.SCALED.values()),
        S.query(f"SELECT {KEY_SQL}, fare_norm, dist_norm FROM scaled", S.CLEAN, S.NORMS),
    ),
    "encode": Entry(
        _on_raw(C.encode_payment, "payment_type", *C.PAYMENT_FLAGS),
        S.query(f"SELECT {KEY_SQL}, payment_type, {S.FLAGS} FROM raw", S.RAW),
    ),
    "bin_distance": Entry(
        _on_raw(C.add_distance_bucket, "trip_distance", "distance_bucket"),
        S.query(
            f"SELECT {KEY_SQL}, trip_distance, {S.DISTANCE_BUCKET} AS distance_bucket FROM raw",
            S.RAW,
        ),
    ),
    "bin_time_of_day": Entry(
        _on_raw(C.add_time_of_day, "time_of_day"),
        S.query(f"SELECT {KEY_SQL}, {S.DAY_PART} AS time_of_day FROM raw", S.RAW),
    ),
    "clean_trips": Entry(
        _on_raw(
            C.clean_trips,
            "pickup_date",
            "pickup_hour",
            "day_of_week",
            "PULocationID",
            "DOLocationID",
            "passenger_count",
            "trip_distance",
            "fare_amount",
            "tip_amount",
            "total_amount",
            *C.SCALED.values(),
            *C.PAYMENT_FLAGS,
            "distance_bucket",
            "time_of_day",
        ),
        S.query(
            f"""SELECT {KEY_SQL}, CAST(pickup_date AS VARCHAR) AS pickup_date, pickup_hour,
            day_of_week, PULocationID, DOLocationID, passenger_count, trip_distance, fare_amount,
            tip_amount, total_amount, fare_norm, dist_norm, pay_credit_card, pay_cash,
            pay_no_charge, distance_bucket, time_of_day FROM scaled""",
            S.CLEAN,
            S.NORMS,
        ),
    ),
}
