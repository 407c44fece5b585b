"""Fixed schemas and fixed values shared by every module.

Everything in this file has to be exactly this for results to be right: column names, types, code
tables, ceilings and bucket edges. Logic lives elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass

# The 19 columns of a raw trip record.
TRIP_COLUMNS = {
    "VendorID": "bigint",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "double",
    "store_and_fwd_flag": "string",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}

# One weather reading per station and day; PRCP in tenths of mm, SNOW in mm.
WEATHER_COLUMNS = {"STATION": "string", "DATE": "date", "PRCP": "int", "SNOW": "int"}

# Weather conditions, mildest first.
WEATHER_CONDITIONS = ("clear", "rain", "snow")

# The zone lookup file.
ZONE_COLUMNS = {
    "LocationID": "int",
    "Borough": "string",
    "Zone": "string",
    "service_zone": "string",
}

# A scoring request, as asked by a person.
REQUEST_COLUMNS = {
    "pu_location_id": "bigint",
    "do_location_id": "bigint",
    "trip_distance": "double",
    "pickup_hour": "int",
    "day_name": "string",
    "passenger_count": "int",
    "payment_method": "string",
}

# Weekday numbers, Sunday first.
WEEKDAYS = {
    1: "Sunday",
    2: "Monday",
    3: "Tuesday",
    4: "Wednesday",
    5: "Thursday",
    6: "Friday",
    7: "Saturday",
}
WEEKEND = (1, 7)

# Payment codes that get a flag column.
PAYMENT_FLAGS = {"pay_credit_card": 1, "pay_cash": 2, "pay_no_charge": 3}

# Payment names a scoring request may carry, and the flag each one sets.
PAYMENT_METHODS = {"Credit Card": "pay_credit_card", "Cash": "pay_cash"}

# Report order of the distance buckets.
DISTANCE_BUCKETS = ("short", "medium", "long")

# The model's inputs, in vector order.
FEATURES = (
    "trip_distance",
    "pickup_hour",
    "day_of_week",
    "passenger_count",
    "pu_idx",
    "do_idx",
    "pay_credit_card",
    "pay_cash",
)
ZONE_INDEXES = {"PULocationID": "pu_idx", "DOLocationID": "do_idx"}
LABEL = "total_amount"


@dataclass(frozen=True)
class CleaningRules:
    """Thresholds of the cleaning steps; the defaults are fixed values."""

    default_passengers: int = 1
    fare_ceiling: float = 500.0
    total_ceiling: float = 600.0
    short_below: float = 1.0
    medium_up_to: float = 10.0
    # (first hour that no longer belongs to the part of the day, its name)
    day_parts: tuple[tuple[int, str], ...] = (
        (6, "overnight"),
        (12, "morning"),
        (18, "afternoon"),
        (22, "evening"),
    )
    last_day_part: str = "night"


@dataclass(frozen=True)
class RequestLimits:
    """Accepted ranges of a scoring request; the defaults are fixed values."""

    least_distance: float = 0.1
    hours: tuple[int, int] = (0, 23)
    passengers: tuple[int, int] = (1, 6)


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())
