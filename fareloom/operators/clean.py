"""Trip cleaning.

The order matters: rows are judged on their recorded values, ceilings apply next, and the unit
scaling sees the capped values. Filters come before any derived column so that they reach the
Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions import expressions as X
from fareloom.schema import PAYMENT_FLAGS, CleaningRules

RULES = CleaningRules()
SCALED = {"fare_amount": "fare_norm", "trip_distance": "dist_norm"}


def add_calendar(trips: DataFrame, pickup: str = "tpep_pickup_datetime") -> DataFrame:
    """Date, hour (0-23) and weekday (1 = Sunday) of the pickup."""
    return trips.withColumns(
        {
            "pickup_date": F.to_date(pickup),
            "pickup_hour": F.hour(pickup),
            "day_of_week": F.dayofweek(pickup),
        }
    )


def fill_missing(trips: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    """Unknown passenger counts become the default; trips without a fare are dropped."""
    return trips.filter(F.col("fare_amount").isNotNull()).fillna(
        {"passenger_count": rules.default_passengers}
    )


def drop_and_cap(trips: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    """Drop impossible trips and hold fare and total at their ceilings.

    A NULL distance, fare or total drops the trip. NaN counts as a large value and stays.
    """
    possible = (
        (F.col("trip_distance") > 0) & (F.col("fare_amount") >= 0) & (F.col("total_amount") >= 0)
    )
    return trips.filter(possible).withColumns(
        {
            "fare_amount": F.least("fare_amount", F.lit(rules.fare_ceiling)),
            "total_amount": F.least("total_amount", F.lit(rules.total_ceiling)),
        }
    )


def fit_ranges(trips: DataFrame, columns=tuple(SCALED)) -> DataFrame:
    """One row with the lowest and highest value of each column; write it out to reuse it."""
    bounds = [
        end
        for name in columns
        for end in (F.min(name).alias(f"{name}_low"), F.max(name).alias(f"{name}_high"))
    ]
    return trips.agg(*bounds)


def scale_to_unit(
    trips: DataFrame, ranges: DataFrame | None = None, columns: dict[str, str] | None = None
) -> DataFrame:
    """Min-max scale columns to [0, 1]; a column without spread scales to 0.

    The range is a one-row scalar subquery: Spark computes it once, over the scaled columns only,
    and uses the values as constants. Pass ``ranges`` to scale by a stored range instead, which
    saves that second pass.
    """
    columns = columns or SCALED
    if ranges is None:
        ranges = fit_ranges(trips, tuple(columns))
    fitted = ranges.select(F.struct("*").alias("fitted")).scalar()

    def scaled(name: str):
        low, high = fitted.getField(f"{name}_low"), fitted.getField(f"{name}_high")
        spread = high - low
        return (F.col(name) - low) / F.when(spread == 0, 1.0).otherwise(spread)

    return trips.withColumns({target: scaled(name) for name, target in columns.items()})


def encode_payment(trips: DataFrame, payment: str = "payment_type") -> DataFrame:
    """One 0/1 column per flagged payment code; any other code leaves all of them 0."""
    return trips.withColumns(
        {name: X.flag(F.col(payment) == code) for name, code in PAYMENT_FLAGS.items()}
    )


def add_distance_bucket(
    trips: DataFrame, rules: CleaningRules = RULES, distance: str = "trip_distance"
) -> DataFrame:
    return trips.withColumn("distance_bucket", X.distance_bucket(F.col(distance), rules))


def add_time_of_day(
    trips: DataFrame, rules: CleaningRules = RULES, pickup: str = "tpep_pickup_datetime"
) -> DataFrame:
    return trips.withColumn("time_of_day", X.time_of_day(F.col(pickup), rules))


def reject_nan_distance(trips: DataFrame) -> DataFrame:
    """Drop NaN distances: one of them makes the highest distance, and so every norm, NaN."""
    return trips.filter(~F.isnan("trip_distance"))


def clean_trips(
    raw: DataFrame,
    rules: CleaningRules = RULES,
    ranges: DataFrame | None = None,
    keep_nan_distance: bool = True,
) -> DataFrame:
    """All cleaning steps in their fixed order."""
    trips = raw if keep_nan_distance else reject_nan_distance(raw)
    return (
        trips.transform(add_calendar)
        .transform(fill_missing, rules)
        .transform(drop_and_cap, rules)
        .transform(scale_to_unit, ranges)
        .transform(encode_payment)
        .transform(add_distance_bucket, rules)
        .transform(add_time_of_day, rules)
    )
