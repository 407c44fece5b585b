"""The test tables in the shape of trips, weather, zones and requests.

Every frame is derived by Spark from the Parquet tables of the given folder and is as large as they
are. The SQL in ``sql.py`` states the same mappings for the comparison engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.operators.clean import clean_trips
from fareloom.operators.report import zone_labels
from fareloom.operators.weather import categorize_weather
from fareloom.schema import TRIP_COLUMNS
from fareloom.session import shared_folder
from fareloom.sinks import write_csv

KEYS = ("l_orderkey", "l_linenumber")
STATION = "USW00094728"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _raw_columns() -> dict[str, Column]:
    order, line, part, supplier = (
        F.col(name) for name in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    )
    price, tax = F.col("l_extendedprice"), F.col("l_tax")
    minute = F.pmod(order * 37 + line * 101, F.lit(1440)).cast("int")
    pickup = F.col("l_shipdate") + F.make_dt_interval(mins=minute)
    fare = (
        F.when(part % 97 == 0, None).when(part % 89 == 0, 0.0).otherwise(price / 180 - 20)
    )
    return {
        "VendorID": line % 2 + 1,
        "tpep_pickup_datetime": pickup,
        "tpep_dropoff_datetime": pickup + F.make_dt_interval(mins=(line * 10).cast("int")),
        "passenger_count": F.when(line != 7, line),
        "trip_distance": (F.col("l_quantity") - 3) / 4,
        "RatecodeID": line % 6 + 1,
        "store_and_fwd_flag": F.when(F.col("l_returnflag") == "R", "Y").otherwise("N"),
        "PULocationID": supplier,
        "DOLocationID": part % 265,
        "payment_type": line,
        "fare_amount": fare,
        "extra": F.col("l_discount") * 10,
        "mta_tax": F.lit(0.5),
        "tip_amount": price / 180 * F.col("l_discount"),
        "tolls_amount": tax * 50,
        "improvement_surcharge": F.lit(0.3),
        "total_amount": price / 150 * (1 + tax) - 20,
        "congestion_surcharge": F.when(line <= 3, 2.5).otherwise(0.0),
        "airport_fee": supplier % 3,
    }


def raw_trips(spark: SparkSession, folder: str) -> DataFrame:
    columns = _raw_columns()
    return table(spark, folder, "lineitem").select(
        *KEYS, *(columns[name].cast(kind).alias(name) for name, kind in TRIP_COLUMNS.items())
    )


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_trips(raw_trips(spark, folder))


def in_order(report: DataFrame) -> DataFrame:
    """A sorted report with each row's ``position``, so that a comparison of rows sees the order."""
    return report.coalesce(1).withColumn("position", F.monotonically_increasing_id() + 1)


def with_months(trips: DataFrame) -> DataFrame:
    pickup = "tpep_pickup_datetime"
    return trips.withColumns({"year": F.year(pickup), "month": F.month(pickup)})


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """One reading per shipping day, none on the 31st of a month."""
    day = F.day("DATE")
    winter = F.month("DATE").isin(12, 1, 2) & (day % 4 == 0)
    return (
        table(spark, folder, "lineitem")
        .select(F.to_date("l_shipdate").alias("DATE"))
        .distinct()
        .filter(day != 31)
        .select(
            F.lit(STATION).alias("STATION"),
            "DATE",
            ((day * 7) % 5 * 10 - 10).alias("PRCP"),
            F.when(winter, 20).otherwise(0).alias("SNOW"),
        )
    )


def weather_days(spark: SparkSession, folder: str) -> DataFrame:
    return categorize_weather(weather(spark, folder))


def summary_days(spark: SparkSession, folder: str) -> DataFrame:
    """Daily summaries of two stations, with unmeasured values among them."""
    day, month = F.day("DATE"), F.month("DATE")
    rain = (
        F.when(day % 5 == 0, 0.0).when(day % 5 == 1, 0.05).when(day % 5 == 2, 0.3)
        .when(day % 5 == 3, 0.8).otherwise(99.99)
    )
    depth = F.when(day % 11 == 0, 999.9).when(month.isin(12, 1, 2) & (day % 4 == 0), 3.0)
    return (
        table(spark, folder, "lineitem")
        .select(F.to_date("l_shipdate").alias("DATE"))
        .distinct()
        .select(
            F.explode(F.array(F.lit("94728"), F.lit("14732"))).alias("STATION"),
            F.col("DATE").cast("string").alias("DATE"),
            (20.0 + (day * 3 + month * 5) % 70).alias("TEMP"),
            rain.alias("PRCP"),
            F.when(day % 7 == 0, 999.9).otherwise(day / 2.0).alias("WDSP"),
            depth.otherwise(0.0).alias("SNDP"),
        )
    )


def station_file(spark: SparkSession, folder: str) -> str:
    """A wide station CSV in the shared folder: shuffled columns, blanks where nothing fell."""
    path = shared_folder(spark, "station")
    fallen = {name: F.when(F.col(name) > 0, F.col(name).cast("string")) for name in ("PRCP", "SNOW")}
    wide = weather(spark, folder).select(
        F.col("DATE").cast("string").alias("DATE"),
        F.coalesce(fallen["SNOW"], F.lit("")).alias("SNOW"),
        F.lit("CENTRAL PARK").alias("NAME"),
        "STATION",
        (F.month("DATE") * 10).alias("TMAX"),
        F.coalesce(fallen["PRCP"], F.lit("  ")).alias("PRCP"),
    )
    write_csv(wide, path)
    return path


def zones(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier")
    nations = table(spark, folder, "nation")
    return suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"]).select(
        F.col("s_suppkey").alias("LocationID"),
        F.col("n_name").alias("Borough"),
        F.col("s_name").alias("Zone"),
        F.lit("Yellow Zone").alias("service_zone"),
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    method = (
        F.when(F.col("event_type").isin("click", "purchase"), "Credit Card")
        .when(F.col("event_type").isin("view", "signup"), "Cash")
        .otherwise("Other")
    )
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("pu_location_id"),
        (F.col("event_id") % 265).alias("do_location_id"),
        (F.col("value") / 20).alias("trip_distance"),
        F.hour("ts").alias("pickup_hour"),
        F.date_format("ts", "EEEE").alias("day_name"),
        (F.col("event_id") % 8).cast("int").alias("passenger_count"),
        method.alias("payment_method"),
    )


def labelled_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests that name their zones by label, NULL for a zone nobody knows."""
    labels = zone_labels(zones(spark, folder))
    named = requests(spark, folder)
    for key, label in (("pu_location_id", "pickup_zone"), ("do_location_id", "dropoff_zone")):
        side = labels.select(F.col("LocationID").alias(key), F.col("label").alias(label))
        named = named.join(side, key, "left")
    return named.drop("pu_location_id", "do_location_id")


def split_bucket() -> Column:
    return (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729) % 100


def plain_predictions(trips: DataFrame) -> DataFrame:
    """Three predictors with known values, named like the models."""
    return trips.withColumns(
        {
            "lr": 15 + 3 * F.col("trip_distance"),
            "gbt": F.col("fare_amount") * 1.25,
            "rf": F.col("fare_amount") + F.col("tip_amount"),
        }
    )


def drifting_files(spark: SparkSession, folder: str) -> str:
    """Monthly trip folders in the shared folder whose column types differ between years."""
    root = shared_folder(spark, "drift")
    trips = with_months(raw_trips(spark, folder).drop(*KEYS))
    variants = [
        {"airport_fee": "int", "passenger_count": "bigint", "congestion_surcharge": None},
        {"airport_fee": "bigint", "VendorID": "int"},
        {},
    ]
    for remainder, changes in enumerate(variants):
        part = trips.filter(F.col("year") % 3 == remainder)
        for name, kind in changes.items():
            part = part.withColumn(name, F.col(name).cast(kind)) if kind else part.drop(name)
        part.hint("rebalance", F.col("year"), F.col("month")).write.mode("append").partitionBy(
            "year", "month"
        ).parquet(root)
    return root
