"""Reusable ``Column -> Column`` building blocks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.schema import PAYMENT_METHODS, WEEKDAYS, CleaningRules

RULES = CleaningRules()


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; a zero divisor gives NULL, which averages skip but row counts do not."""
    return F.try_divide(part, whole)


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100


def to_cents(value: Column) -> Column:
    return F.round(value, 2)


def missing(field: T.StructField) -> Column:
    """True where the column is NULL, or NaN if its type can hold NaN."""
    column = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def chain(branches: list[tuple[Column, object]], otherwise: object) -> Column:
    """CASE WHEN over the branches; NULL conditions fall through to ``otherwise``."""
    (first, value), *rest = branches
    case = reduce(lambda c, branch: c.when(*branch), rest, F.when(first, value))
    return case.otherwise(otherwise)


def distance_bucket(distance: Column, rules: CleaningRules = RULES) -> Column:
    """short / medium / long; NULL and NaN distances count as long."""
    return chain(
        [
            (distance < rules.short_below, "short"),
            (distance <= rules.medium_up_to, "medium"),
        ],
        "long",
    )


def time_of_day(pickup: Column, rules: CleaningRules = RULES) -> Column:
    """Part of the day of a timestamp; a NULL timestamp counts as the last part."""
    hour = F.hour(pickup)
    return chain([(hour < end, name) for end, name in rules.day_parts], rules.last_day_part)


def weather_condition(snow: Column, rain: Column) -> Column:
    """snow wins over rain, rain over clear."""
    return chain([(snow > 0, "snow"), (rain > 0, "rain")], "clear")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def lookup(table: dict, key: Column) -> Column:
    """Look a key up in a small constant table; NULL when it is not there."""
    literals = [F.lit(item) for pair in table.items() for item in pair]
    return F.create_map(*literals)[key]


def weekday_name(number: Column) -> Column:
    return lookup(WEEKDAYS, number.cast("int"))


def weekday_number(name: Column) -> Column:
    return lookup({text: number for number, text in WEEKDAYS.items()}, name)


def place_label(zone: Column, borough: Column) -> Column:
    """``Zone, Borough``; NULL when either part is."""
    return F.concat(zone, F.lit(", "), borough)


def method_flag(method: Column, column: str) -> Column:
    """The flag a payment name sets; NULL for a name that is not known."""
    table = {name: int(target == column) for name, target in PAYMENT_METHODS.items()}
    return lookup(table, method)
