"""Every registered query against its SQL counterpart, and relations between reports."""

import pytest
from oracle import TESTDATA, connect, differences

import __spark_entry__ as contract
from fareloom.registry import entries
from fareloom.registry import tables as T

FOLDER = f"{TESTDATA}/sf0.001"
ALL = entries()


@pytest.fixture(scope="module")
def engine():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [name for name, entry in ALL.items() if entry.sql])
def test_equals_sql(spark, engine, name):
    assert differences(ALL[name].build(spark, FOLDER), ALL[name].sql, engine) == []


def test_contract(spark):
    assert contract.entry(spark).columns == [
        "weather_condition", "trip_count", "avg_fare", "avg_distance", "position",
    ]
    assert set(contract.oracle_sql()) < set(contract.queries())


def test_counts_add_up(spark):
    trips = T.clean(spark, FOLDER).count()

    def total(name, column="trip_count"):
        return sum(row[column] for row in ALL[name].build(spark, FOLDER).collect())

    for name in ("hourly_demand", "zone_revenue", "tipping_by_distance", "fare_per_mile"):
        assert total(name) == trips
    assert total("demand_by_weather") + total("unmatched_weather", "unmatched_trips") == trips


