import datetime
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fareloom.schema import TRIP_COLUMNS, WEATHER_COLUMNS, ddl  # noqa: E402
from fareloom.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("fareloom-tests", "local[4]")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    yield spark
    spark.stop()


RAW_TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": datetime.datetime(2022, 1, 15, 10, 0),
    "tpep_dropoff_datetime": datetime.datetime(2022, 1, 15, 10, 30),
    "passenger_count": 1.0,
    "trip_distance": 2.5,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 161,
    "DOLocationID": 236,
    "payment_type": 1,
    "fare_amount": 12.0,
    "extra": 0.0,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 15.0,
    "congestion_surcharge": 2.5,
    "airport_fee": 0.0,
}

CLEAN_COLUMNS = {
    "pickup_date": "date",
    "pickup_hour": "int",
    "day_of_week": "int",
    "distance_bucket": "string",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "trip_distance": "double",
    "fare_amount": "double",
    "tip_amount": "double",
    "total_amount": "double",
    "passenger_count": "double",
    "pay_credit_card": "int",
    "pay_cash": "int",
}
CLEAN_TRIP = {
    "pickup_date": datetime.date(2022, 1, 15),
    "pickup_hour": 10,
    "day_of_week": 7,
    "distance_bucket": "medium",
    "PULocationID": 161,
    "DOLocationID": 236,
    "trip_distance": 2.5,
    "fare_amount": 12.0,
    "tip_amount": 2.0,
    "total_amount": 15.5,
    "passenger_count": 1.0,
    "pay_credit_card": 1,
    "pay_cash": 0,
}
READING = {
    "STATION": "USW00094728",
    "DATE": datetime.date(2022, 1, 15),
    "PRCP": 0,
    "SNOW": 0,
}


def _maker(spark, defaults, columns):
    def make(*changes, **all_rows):
        rows = [{**defaults, **all_rows, **change} for change in (changes or ({},))]
        return spark.createDataFrame([tuple(row[c] for c in columns) for row in rows], ddl(columns))

    return make


@pytest.fixture(scope="session")
def raw(spark):
    """raw({...}, {...}, column=value): one raw trip per dict, over the defaults."""
    return _maker(spark, RAW_TRIP, TRIP_COLUMNS)


@pytest.fixture(scope="session")
def clean(spark):
    return _maker(spark, CLEAN_TRIP, CLEAN_COLUMNS)


@pytest.fixture(scope="session")
def readings(spark):
    return _maker(spark, READING, WEATHER_COLUMNS)


def plan_of(frame):
    """The physical plan after execution, with what adaptive execution made of it."""
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan_of(frame):
    return plan_of(frame).split("Initial Plan")[0]
