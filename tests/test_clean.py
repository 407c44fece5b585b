import datetime
import math

import pytest
from conftest import final_plan_of

from fareloom.operators import clean as C
from fareloom.schema import CleaningRules

NAN = float("nan")


def only(frame):
    (row,) = frame.collect()
    return row


class TestCalendar:
    def test_date_hour_and_weekday(self, raw):
        row = only(C.add_calendar(raw()))
        assert row["pickup_date"] == datetime.date(2022, 1, 15)
        assert (row["pickup_hour"], row["day_of_week"]) == (10, 7)

    def test_sunday_is_one(self, raw):
        sunday = raw(tpep_pickup_datetime=datetime.datetime(2022, 1, 16, 23, 59))
        assert only(C.add_calendar(sunday))["day_of_week"] == 1

    def test_null_pickup(self, raw):
        row = only(C.add_calendar(raw(tpep_pickup_datetime=None)))
        assert (row["pickup_date"], row["pickup_hour"], row["day_of_week"]) == (None, None, None)


class TestFillMissing:
    @pytest.mark.parametrize("unknown", [None, NAN])
    def test_unknown_passengers_become_one(self, raw, unknown):
        assert only(C.fill_missing(raw(passenger_count=unknown)))["passenger_count"] == 1

    def test_default_is_a_rule(self, raw):
        rules = CleaningRules(default_passengers=2)
        assert only(C.fill_missing(raw(passenger_count=None), rules))["passenger_count"] == 2

    def test_known_passengers_stay(self, raw):
        assert only(C.fill_missing(raw(passenger_count=4.0)))["passenger_count"] == 4

    def test_null_fare_is_dropped(self, raw):
        assert C.fill_missing(raw(fare_amount=None)).count() == 0


class TestDropAndCap:
    @pytest.mark.parametrize(
        "change",
        [
            {"trip_distance": -1.0},
            {"trip_distance": 0.0},
            {"trip_distance": None},
            {"fare_amount": -0.01},
            {"fare_amount": None},
            {"total_amount": -4.55},
            {"total_amount": None},
        ],
    )
    def test_impossible_trips_are_dropped(self, raw, change):
        assert C.drop_and_cap(raw(change)).count() == 0

    def test_free_trips_stay(self, raw):
        assert C.drop_and_cap(raw(fare_amount=0.0, total_amount=0.0)).count() == 1

    def test_ceilings(self, raw):
        row = only(C.drop_and_cap(raw(fare_amount=9999.0, total_amount=401095.62)))
        assert (row["fare_amount"], row["total_amount"]) == (500.0, 600.0)

    def test_ceilings_are_rules(self, raw):
        row = only(C.drop_and_cap(raw(), CleaningRules(fare_ceiling=5.0, total_ceiling=7.0)))
        assert (row["fare_amount"], row["total_amount"]) == (5.0, 7.0)

    def test_ordinary_trip_is_unchanged(self, raw):
        assert only(C.drop_and_cap(raw())) == only(raw())

    def test_nan_counts_as_large(self, raw):
        row = only(C.drop_and_cap(raw(trip_distance=NAN, fare_amount=NAN, total_amount=NAN)))
        assert math.isnan(row["trip_distance"])
        assert (row["fare_amount"], row["total_amount"]) == (500.0, 600.0)


class TestScaleToUnit:
    def test_lowest_is_zero_and_highest_is_one(self, raw):
        trips = raw({"fare_amount": 0.0}, {"fare_amount": 25.0}, {"fare_amount": 100.0})
        assert sorted(r["fare_norm"] for r in C.scale_to_unit(trips).collect()) == [0, 0.25, 1]

    def test_no_spread_scales_to_zero(self, raw):
        rows = C.scale_to_unit(raw({}, {})).collect()
        assert {(r["fare_norm"], r["dist_norm"]) for r in rows} == {(0.0, 0.0)}

    def test_empty_in_empty_out(self, raw):
        assert C.scale_to_unit(raw().limit(0)).collect() == []

    def test_stored_range(self, raw, tmp_path):
        path = str(tmp_path / "ranges")
        C.fit_ranges(raw({"fare_amount": 0.0}, {"fare_amount": 50.0})).write.parquet(path)
        stored = raw().sparkSession.read.parquet(path)
        assert only(C.scale_to_unit(raw(fare_amount=25.0), stored))["fare_norm"] == 0.5

    def test_nan_distance_spoils_the_norm_until_rejected(self, raw):
        trips = raw({"trip_distance": NAN}, {"trip_distance": 1.0}, {"trip_distance": 3.0})
        spoiled = C.clean_trips(trips).collect()
        assert all(math.isnan(r["dist_norm"]) for r in spoiled)
        kept = C.clean_trips(trips, keep_nan_distance=False).collect()
        assert sorted(r["dist_norm"] for r in kept) == [0.0, 1.0]

    def test_range_is_computed_once(self, raw, tmp_path):
        path = str(tmp_path / "trips")
        raw({"fare_amount": 1.0}, {"fare_amount": 5.0}).write.parquet(path)
        scaled = C.scale_to_unit(raw().sparkSession.read.parquet(path))
        plan = final_plan_of(scaled.select("fare_norm", "dist_norm"))
        assert "ReusedSubquery" in plan
        assert "Cartesian" not in plan and "NestedLoop" not in plan


class TestEncodePayment:
    @pytest.mark.parametrize(
        ("code", "flags"),
        [(1, (1, 0, 0)), (2, (0, 1, 0)), (3, (0, 0, 1)), (99, (0, 0, 0)), (None, (0, 0, 0))],
    )
    def test_flags(self, raw, code, flags):
        row = only(C.encode_payment(raw(payment_type=code)))
        assert (row["pay_credit_card"], row["pay_cash"], row["pay_no_charge"]) == flags


class TestBuckets:
    @pytest.mark.parametrize(
        ("distance", "bucket"),
        [
            (0.5, "short"),
            (0.99, "short"),
            (1.0, "medium"),
            (5.0, "medium"),
            (10.0, "medium"),
            (10.01, "long"),
            (15.0, "long"),
            (None, "long"),
            (NAN, "long"),
        ],
    )
    def test_distance(self, raw, distance, bucket):
        assert only(C.add_distance_bucket(raw(trip_distance=distance)))["distance_bucket"] == bucket

    @pytest.mark.parametrize(
        ("hour", "part"),
        [
            (0, "overnight"),
            (5, "overnight"),
            (6, "morning"),
            (8, "morning"),
            (11, "morning"),
            (12, "afternoon"),
            (17, "afternoon"),
            (18, "evening"),
            (21, "evening"),
            (22, "night"),
            (23, "night"),
        ],
    )
    def test_time_of_day(self, raw, hour, part):
        trips = raw(tpep_pickup_datetime=datetime.datetime(2022, 1, 15, hour, 59))
        assert only(C.add_time_of_day(trips))["time_of_day"] == part

    def test_null_pickup_is_night(self, raw):
        assert only(C.add_time_of_day(raw(tpep_pickup_datetime=None)))["time_of_day"] == "night"


class TestCleanTrips:
    def test_caps_before_scaling(self, raw):
        rows = C.clean_trips(raw({"fare_amount": 0.0}, {"fare_amount": 9999.0})).collect()
        assert sorted((r["fare_amount"], r["fare_norm"]) for r in rows) == [(0, 0), (500, 1)]

    def test_adds_all_columns(self, raw):
        added = set(C.clean_trips(raw()).columns) - set(raw().columns)
        assert added == {
            "pickup_date", "pickup_hour", "day_of_week", "fare_norm", "dist_norm",
            "pay_credit_card", "pay_cash", "pay_no_charge", "distance_bucket", "time_of_day",
        }

    def test_empty_in_empty_out(self, raw):
        assert C.clean_trips(raw().limit(0)).collect() == []

    def test_filters_reach_the_scan_and_unused_steps_cost_nothing(self, raw, tmp_path):
        path = str(tmp_path / "trips")
        raw({}, {}).write.parquet(path)
        trips = C.clean_trips(raw().sparkSession.read.parquet(path))
        plan = final_plan_of(trips.groupBy("pickup_hour").count())
        for pushed in ("GreaterThan(trip_distance,0.0)", "GreaterThanOrEqual(fare_amount,0.0)"):
            assert pushed in plan
        assert "tip_amount" not in plan
        assert "ubquery" not in plan
        assert "Python" not in plan
