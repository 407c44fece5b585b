"""Cleaning and reports against plain Python on random trips with NULL, NaN and edge values."""

import datetime
import math
import random
from collections import Counter, defaultdict

import pytest

from fareloom.operators import demand as D
from fareloom.operators.clean import clean_trips
from fareloom.operators.weather import categorize_weather
from fareloom.plans.measures import trip_summary

NAN = float("nan")


@pytest.fixture(scope="module")
def rows():
    """A third of all trips start in one zone on one day."""
    chance = random.Random(11)
    result = []
    for i in range(3000):
        hot = i % 3 == 0
        day = 15 if hot else chance.randint(1, 28)
        result.append(
            {
                "tpep_pickup_datetime": datetime.datetime(2022, 1, day, chance.randint(0, 23), 30),
                "PULocationID": 132 if hot else chance.randint(1, 265),
                "trip_distance": chance.choice([None, 0.0, -1.0, 0.5, 1.0, 10.0, 10.5, 3.25, 7.5]),
                "fare_amount": chance.choice([None, NAN, -5.0, 0.0, 499.5, 500.5, 12.25, 30.0]),
                "total_amount": chance.choice([None, -1.0, 0.0, 700.0, 15.0, 44.5]),
                "tip_amount": chance.choice([0.0, 1.25, 4.0]),
                "passenger_count": chance.choice([None, NAN, 0.0, 2.0]),
                "payment_type": chance.choice([None, 1, 2, 3, 4]),
            }
        )
    return result


def at_least(value, bound, strict=False):
    if value is None:
        return False
    return math.isnan(value) or (value > bound if strict else value >= bound)


def capped(value, ceiling):
    return ceiling if math.isnan(value) else min(value, ceiling)


@pytest.fixture(scope="module")
def expected(rows):
    kept = []
    for row in rows:
        if not (
            at_least(row["trip_distance"], 0, strict=True)
            and at_least(row["fare_amount"], 0)
            and at_least(row["total_amount"], 0)
        ):
            continue
        distance = row["trip_distance"]
        pickup = row["tpep_pickup_datetime"]
        passengers = row["passenger_count"]
        kept.append(
            {
                **row,
                "fare_amount": capped(row["fare_amount"], 500.0),
                "total_amount": capped(row["total_amount"], 600.0),
                "passenger_count": 1.0 if passengers is None or math.isnan(passengers) else passengers,
                "pickup_date": pickup.date(),
                "pickup_hour": pickup.hour,
                "day_of_week": pickup.isoweekday() % 7 + 1,
                "distance_bucket": "short" if distance < 1 else "medium" if distance <= 10 else "long",
                "pay_credit_card": int(row["payment_type"] == 1),
                "pay_cash": int(row["payment_type"] == 2),
                "pay_no_charge": int(row["payment_type"] == 3),
            }
        )
    for column, norm in (("fare_amount", "fare_norm"), ("trip_distance", "dist_norm")):
        low = min(row[column] for row in kept)
        spread = max(row[column] for row in kept) - low
        for row in kept:
            row[norm] = (row[column] - low) / spread
    return kept


@pytest.fixture(scope="module")
def trips(raw, rows):
    return clean_trips(raw(*rows).repartition(7))


def test_cleaning(trips, expected):
    columns = sorted(expected[0])
    ours = Counter(tuple(row[name] for name in columns) for row in trips.collect())
    assert ours == Counter(tuple(row[name] for name in columns) for row in expected)


def averaged(values):
    values = [value for value in values if value is not None]
    return sum(values) / len(values) if values else None


@pytest.mark.parametrize("summarised", [False, True])
def test_reports(trips, expected, readings, summarised):
    source = trip_summary(trips) if summarised else trips
    groups = defaultdict(list)
    for row in expected:
        groups[row["distance_bucket"]].append(row)
    for row in D.tipping_by_distance(source).collect():
        group = groups[row["distance_bucket"]]
        shares = [r["tip_amount"] / r["fare_amount"] * 100 if r["fare_amount"] else None for r in group]
        assert row["trip_count"] == len(group)
        assert row["avg_tip_pct"] == pytest.approx(averaged(shares), abs=0.006)
        assert row["avg_tip_amount"] == pytest.approx(averaged(r["tip_amount"] for r in group), abs=0.006)
    hours = Counter((row["pickup_hour"], row["day_of_week"]) for row in expected)
    assert {(r[0], r[1]): r[2] for r in D.hourly_demand(source).collect()} == hours

    january = [datetime.date(2022, 1, day) for day in range(1, 21)]
    changes = [{"DATE": d, "PRCP": d.day % 3, "SNOW": d.day % 5} for d in january]
    days = categorize_weather(readings(*changes))
    names = {d: "snow" if d.day % 5 else "rain" if d.day % 3 else "clear" for d in january}
    counts = Counter(names.get(row["pickup_date"]) for row in expected)
    assert D.unmatched_trips(source, days).first()[0] == counts.pop(None)
    report = D.demand_by_weather(source, days).collect()
    assert {row["weather_condition"]: row["trip_count"] for row in report} == counts
    for row in report:
        fares = [r["fare_amount"] for r in expected if names.get(r["pickup_date"]) == row[0]]
        assert row["avg_fare"] == pytest.approx(averaged(fares), abs=0.006)


def test_zone_revenue(trips, expected):
    sums, counts = defaultdict(float), Counter()
    for row in expected:
        sums[row["PULocationID"]] += row["fare_amount"]
        counts[row["PULocationID"]] += 1
    report = D.zone_revenue(trips).collect()
    assert {r["PULocationID"]: r["trip_count"] for r in report} == counts
    assert {r["PULocationID"]: r["total_revenue"] for r in report} == pytest.approx(sums)
    revenues = [r["total_revenue"] for r in report]
    assert revenues == sorted(revenues, reverse=True)
