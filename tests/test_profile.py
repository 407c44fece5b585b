import statistics

import pytest

from fareloom.operators import profile as P
from fareloom.operators.clean import clean_trips

NAN = float("nan")


def only(frame):
    (row,) = frame.collect()
    return row


def test_schema_report(raw):
    rows = P.schema_report(raw({"PULocationID": None}, {})).collect()
    assert len(rows) == 19
    assert tuple(rows[1]) == (2, "tpep_pickup_datetime", "timestamp_ntz", True, 0)
    assert tuple(rows[7]) == (8, "PULocationID", "bigint", True, 1)


def test_row_count(raw):
    assert only(P.row_count(raw({}, {})))["row_count"] == 2
    assert only(P.row_count(raw().limit(0)))["row_count"] == 0


def test_describe(raw):
    rows = {r["column_name"]: r for r in P.describe(raw({"fare_amount": 1.0}, {"fare_amount": 3.0})).collect()}
    assert set(rows) == set(P.DESCRIBED)
    fare = rows["fare_amount"]
    assert tuple(fare)[1:] == (2, 2.0, pytest.approx(2**0.5), 1.0, 3.0)


def test_null_counts_see_nan_only_where_the_type_has_it(raw):
    trips = raw(
        {"trip_distance": NAN, "passenger_count": NAN},
        {"trip_distance": None, "tpep_pickup_datetime": None, "PULocationID": None},
        {},
    )
    assert tuple(only(P.null_counts(trips))) == (2, 0, 1, 1, 1)


def test_audit_agrees_with_cleaning(raw):
    trips = raw(
        {},
        {"fare_amount": None},
        {"fare_amount": -1.0, "total_amount": -1.0},
        {"trip_distance": 0.0},
        {"trip_distance": NAN},
        {"fare_amount": 501.0, "total_amount": 601.0},
        {"passenger_count": None},
        {"passenger_count": NAN},
    )
    audit = only(P.audit_cleaning(trips)).asDict()
    assert audit["clean_rows"] == clean_trips(trips).count() == 5
    assert (audit["raw_rows"], audit["dropped_rows"], audit["drop_rate_pct"]) == (8, 3, 37.5)
    assert audit["missing_passengers"] == 2
    assert audit["null_fare"] == audit["negative_fare"] == audit["negative_total"] == 1
    assert audit["distance_not_positive"] == audit["nan_distance"] == 1
    assert audit["fare_over_ceiling"] == audit["total_over_ceiling"] == 1


def test_audit_of_nothing(raw):
    audit = only(P.audit_cleaning(raw().limit(0)))
    assert audit["raw_rows"] == 0 and audit["drop_rate_pct"] is None


@pytest.mark.parametrize("accuracy", [None, 10_000])
def test_data_facts(raw, accuracy):
    trips = raw(
        {"trip_distance": 0.0, "payment_type": 2},
        {"trip_distance": 2.0},
        {"trip_distance": 4.0, "fare_amount": -3.0},
    )
    facts = only(P.data_facts(trips, median_accuracy=accuracy))
    assert tuple(facts) == (3, 66.7, 7.0, 15.0, 66.7, 33.3, 1, 1, 2.0)


@pytest.mark.parametrize(
    "values",
    [
        [],
        [None, NAN],
        [4.0],
        [4.0, 1.0],
        [3.0, None, 1.0, NAN, 2.0],
        [7.0] * 5 + [1.0, 9.0],
        [1.0, 1.0, 5.0, 5.0],
        [float(i * 7919 % 1000) for i in range(1000)],
        [float(i * 7919 % 999) / 8 for i in range(999)] + [0.0] * 400,
        [-1.5, -0.0, 0.0, 2.25],
    ],
)
def test_exact_median(spark, values):
    table = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    known = [v for v in values if v is not None and v == v]
    expected = statistics.median(known) if known else None
    assert only(P.exact_median(table, "x"))["median"] == expected


def test_exact_median_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for rows in (2000, 2001):
            table = spark.range(rows).selectExpr("cast(id * 7919 % 100003 as double) AS x")
            expected = statistics.median(r["x"] for r in table.collect())
            assert only(P.exact_median(table, "x"))["median"] == expected
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
