"""The reports as SQL text, for people who query the trip tables in SQL.

They differ from the DataFrame reports on purpose: weekdays count from Monday = 1, the tipping
report leaves out trips without a fare, and the price report leaves out trips without a distance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from fareloom.schema import CleaningRules

#: What is averaged, by the name of the average.
AVERAGES = {
    "avg_fare": "fare_amount",
    "avg_distance": "trip_distance",
    "avg_tip_amount": "tip_amount",
    "avg_tip_pct": "tip_amount / fare_amount * 100",
    "avg_fare_per_mile": "fare_amount / trip_distance",
}


def _statement(
    keys: dict[str, str], averages: Sequence[str] = (), sums: dict[str, str] | None = None,
    where: str = "true", order: Sequence[str] = (), top: int | None = None,
) -> str:
    """Count and summarise trips by keys, each an expression under its name."""
    shown = [f"{expression} AS {name}" for name, expression in keys.items()]
    shown += [f"round(sum({column}), 2) AS {name}" for name, column in (sums or {}).items()]
    shown += [f"round(avg({AVERAGES[name]}), 2) AS {name}" for name in averages]
    grouped = ", ".join(str(place) for place in range(1, len(keys) + 1))
    return (
        f"SELECT {', '.join(shown)}, count(*) AS trip_count FROM {{trips}} WHERE {where} "
        f"GROUP BY {grouped} ORDER BY {', '.join(order or keys)}" + (f" LIMIT {top}" if top else "")
    )


def statements(rules: CleaningRules = CleaningRules(), top: int = 20) -> dict[str, str]:
    """The four reports by name, with bucket edges of the cleaning rules."""
    bucket = {
        "distance_bucket": f"CASE WHEN trip_distance < {rules.short_below} THEN 'short' "
        f"WHEN trip_distance <= {rules.medium_up_to} THEN 'medium' ELSE 'long' END"
    }
    pickup = "tpep_pickup_datetime"
    clock = {"pickup_hour": f"hour({pickup})", "day_of_week": f"extract(DAYOFWEEK_ISO FROM {pickup})"}
    return {
        "hourly_demand": _statement(clock),
        "zone_revenue": _statement(
            {"PULocationID": "PULocationID"}, ("avg_fare",), {"total_revenue": "fare_amount"},
            order=("total_revenue DESC", "PULocationID"), top=top,
        ),
        "tipping": _statement(bucket, ("avg_tip_pct", "avg_tip_amount"), where="fare_amount > 0"),
        "fare_per_mile": _statement(
            bucket, ("avg_fare_per_mile", "avg_fare", "avg_distance"), where="trip_distance > 0"
        ),
    }


def sql_report(name: str, trips: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Run one report over a trip table, raw or clean."""
    return trips.sparkSession.sql(statements(rules)[name], trips=trips)


def register_views(spark: SparkSession, raw: DataFrame, clean: DataFrame) -> None:
    """Make the trips queryable as ``trips_raw`` and ``trips_clean``."""
    raw.createOrReplaceTempView("trips_raw")
    clean.createOrReplaceTempView("trips_clean")
