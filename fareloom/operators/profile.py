"""Profiling: each report is one pass over the columns it names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.functions import expressions as X
from fareloom.schema import PAYMENT_FLAGS, CleaningRules

RULES = CleaningRules()
DESCRIBED = ("trip_distance", "fare_amount", "tip_amount", "passenger_count")
CHECKED = (
    "trip_distance",
    "fare_amount",
    "passenger_count",
    "tpep_pickup_datetime",
    "PULocationID",
)


def _rows(one_row: DataFrame, entries: list[Column]) -> DataFrame:
    """Turn the cells of a one-row result into rows."""
    return one_row.select(F.inline(F.array(*entries)))


def schema_report(table: DataFrame) -> DataFrame:
    """Name, type and nullability of each column, and how many of its values are NULL."""
    fields = list(enumerate(table.schema.fields, 1))
    nulls = table.agg(*(F.count_if(F.col(f.name).isNull()).alias(f.name) for _, f in fields))
    return _rows(
        nulls,
        [
            F.struct(
                F.lit(position).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.lit(field.nullable).alias("nullable"),
                F.col(field.name).alias("null_count"),
            )
            for position, field in fields
        ],
    )


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("row_count"))


def describe(table: DataFrame, columns: Sequence[str] = DESCRIBED) -> DataFrame:
    """Count, mean, sample deviation, lowest and highest value, one row per column."""
    stats = {
        "value_count": F.count,
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    wide = table.agg(
        *(f(name).alias(f"{name}:{stat}") for name in columns for stat, f in stats.items())
    )
    return _rows(
        wide,
        [
            F.struct(
                F.lit(name).alias("column_name"),
                *(
                    F.col(f"`{name}:{stat}`")
                    .cast("bigint" if stat == "value_count" else "double")
                    .alias(stat)
                    for stat in stats
                ),
            )
            for name in columns
        ],
    )


def null_counts(table: DataFrame, columns: Sequence[str] = CHECKED) -> DataFrame:
    """NULL and, where the type has it, NaN values per column, in one row."""
    return table.agg(
        *(F.count_if(X.missing(table.schema[name])).alias(name) for name in columns)
    )


def audit_cleaning(raw: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    """What cleaning does to raw trips, in one pass and without running it.

    ``nan_distance`` counts trips that cleaning keeps but that spoil the distance scaling.
    """
    distance, fare, cost = F.col("trip_distance"), F.col("fare_amount"), F.col("total_amount")
    kept = (distance > 0) & (fare >= 0) & (cost >= 0)
    counts = raw.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(kept).alias("clean_rows"),
        F.count_if(X.missing(raw.schema["passenger_count"])).alias("missing_passengers"),
        F.count_if(fare.isNull()).alias("null_fare"),
        F.count_if(distance <= 0).alias("distance_not_positive"),
        F.count_if(fare < 0).alias("negative_fare"),
        F.count_if(cost < 0).alias("negative_total"),
        F.count_if(fare > rules.fare_ceiling).alias("fare_over_ceiling"),
        F.count_if(cost > rules.total_ceiling).alias("total_over_ceiling"),
        F.count_if(F.isnan(distance)).alias("nan_distance"),
        F.max(fare).alias("highest_fare"),
        F.max(cost).alias("highest_total"),
    )
    dropped = F.col("raw_rows") - F.col("clean_rows")
    return counts.withColumns(
        {
            "dropped_rows": dropped,
            "drop_rate_pct": F.round(X.percent(dropped, F.col("raw_rows")), 2),
        }
    )


def exact_median(table: DataFrame, column: str, accuracy: int = 100_000) -> DataFrame:
    """The median of a column in one row, without gathering its values anywhere.

    A sketch of known rank error gives two values that have the middle between them. Values outside
    are only counted; those inside are counted by value, and as the sketch's error bounds how many
    rows they are, ordering them is little work. Both passes are lazy: nothing runs before the result
    is asked for. NULL and NaN do not take part.
    """
    values = table.select(F.col(column).cast("double").alias("value")).filter(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    # The sketch is off by at most 1 / accuracy of the rows at either end.
    shares = F.array(F.lit(0.5 - 2 / accuracy), F.lit(0.5 + 2 / accuracy))
    ends = values.agg(F.percentile_approx("value", shares, accuracy).alias("ends")).scalar()
    side = F.when(F.col("value") < F.col("ends")[0], -1).when(F.col("value") > F.col("ends")[1], 1)
    counts = (
        values.withColumn("ends", ends)
        .select(side.otherwise(0).alias("side"), "value")
        .groupBy("side", F.when(F.col("side") == 0, F.col("value")).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ordered = Window.orderBy("side", "value")
    rows = F.sum("n").over(Window.partitionBy())
    reached = counts.select("value", F.sum("n").over(ordered).alias("reached"), rows.alias("rows"))
    middle = [
        F.min(F.when(F.col("reached") > F.floor(place), F.struct("reached", "value")))["value"]
        for place in ((F.col("rows") - 1) / 2, F.col("rows") / 2)
    ]
    return reached.agg(((middle[0] + middle[1]) / 2).alias("median"))


def data_facts(raw: DataFrame, near: float = 3.0, median_accuracy: int | None = None) -> DataFrame:
    """Headline facts of raw trips in one row.

    The median is exact and takes a second pass over the distances. With ``median_accuracy`` it
    comes from a sketch of that accuracy in the same pass as all other facts.
    """
    distance, fare, payment = F.col("trip_distance"), F.col("fare_amount"), F.col("payment_type")
    rows = F.count(F.lit(1))

    def share(condition: Column) -> Column:
        return F.round(X.percent(F.count_if(condition), rows), 1)

    facts = {
        "trip_count": rows,
        "near_pct": share(distance < near),
        "avg_fare": X.to_cents(F.avg(fare)),
        "avg_total": X.to_cents(F.avg("total_amount")),
        "credit_card_pct": share(payment == PAYMENT_FLAGS["pay_credit_card"]),
        "cash_pct": share(payment == PAYMENT_FLAGS["pay_cash"]),
        "zero_distance": F.count_if(distance == 0),
        "negative_fare": F.count_if(fare < 0),
    }
    if median_accuracy is not None:
        facts["median_distance"] = F.percentile_approx(distance, 0.5, median_accuracy)
    table = raw.agg(*(fact.alias(name) for name, fact in facts.items()))
    if median_accuracy is not None:
        return table
    return table.withColumn("median_distance", exact_median(raw, "trip_distance").scalar())
