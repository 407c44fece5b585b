import datetime

import pytest
from conftest import final_plan_of
from pyspark.sql import functions as F

from fareloom.operators import demand as D
from fareloom.operators.weather import (
    categorize_weather,
    join_weather,
    one_row_per_day,
    repeated_days,
)
from fareloom.plans import measures

JAN = [datetime.date(2022, 1, day) for day in range(32) if day]


def only(frame):
    (row,) = frame.collect()
    return row


class TestHourlyDemand:
    def test_counts_in_order(self, clean):
        trips = clean({"day_of_week": 2}, {"day_of_week": 1, "pickup_hour": 11}, {"day_of_week": 1})
        trips = trips.union(clean({"day_of_week": 2}))
        assert [tuple(r) for r in D.hourly_demand(trips).collect()] == [
            (10, 1, 1), (11, 1, 1), (10, 2, 2),
        ]

    def test_columns(self, clean):
        assert D.hourly_demand(clean()).columns == ["pickup_hour", "day_of_week", "trip_count"]


class TestZoneRevenue:
    def test_sums_and_sorts(self, clean):
        trips = clean(
            {"PULocationID": 1, "fare_amount": 20.0},
            {"PULocationID": 2, "fare_amount": 15.0},
            {"PULocationID": 2, "fare_amount": 15.02},
        )
        assert [tuple(r) for r in D.zone_revenue(trips).collect()] == [
            (2, 30.02, 15.01, 2), (1, 20.0, 20.0, 1),
        ]

    def test_ties_by_zone(self, clean):
        trips = clean(*({"PULocationID": zone} for zone in (9, 3, 7)))
        assert [r["PULocationID"] for r in D.zone_revenue(trips).collect()] == [3, 7, 9]

    def test_null_zone_is_a_group(self, clean):
        assert only(D.zone_revenue(clean(PULocationID=None)))["trip_count"] == 1

    def test_top(self, clean):
        trips = clean(*({"PULocationID": z, "fare_amount": float(z)} for z in range(30)))
        top = D.top_zone_revenue(trips, 3)
        assert [r["PULocationID"] for r in top.collect()] == [29, 28, 27]
        assert "TakeOrderedAndProject" in final_plan_of(top)


class TestDistanceReports:
    def test_tip_share(self, clean):
        row = only(D.tipping_by_distance(clean(tip_amount=2.0, fare_amount=10.0)))
        assert tuple(row) == ("medium", 20.0, 2.0, 1)

    def test_tip_share_is_an_average_of_shares(self, clean):
        trips = clean(
            {"tip_amount": 1.0, "fare_amount": 10.0}, {"tip_amount": 50.0, "fare_amount": 100.0}
        )
        assert only(D.tipping_by_distance(trips))["avg_tip_pct"] == 30.0

    def test_free_trip_counts_but_has_no_share(self, clean):
        trips = clean({"tip_amount": 4.0, "fare_amount": 0.0}, {"tip_amount": 2.0, "fare_amount": 10.0})
        assert tuple(only(D.tipping_by_distance(trips))) == ("medium", 20.0, 3.0, 2)

    def test_price_per_mile(self, clean):
        row = only(D.fare_per_mile(clean(fare_amount=10.0, trip_distance=2.0)))
        assert tuple(row) == ("medium", 5.0, 10.0, 2.0, 1)

    def test_one_scan_for_both(self, clean, tmp_path):
        path = str(tmp_path / "trips")
        clean({}, {}).write.parquet(path)
        trips = clean().sparkSession.read.parquet(path)
        assert final_plan_of(D.distance_profile(trips)).count("FileScan") == 1
        assert "trip_distance" not in final_plan_of(D.tipping_by_distance(trips))


class TestDemandByWeather:
    @pytest.fixture
    def trips(self, clean):
        return clean(
            {"pickup_date": JAN[0], "fare_amount": 10.0, "trip_distance": 2.0},
            {"pickup_date": JAN[0], "fare_amount": 20.0, "trip_distance": 4.0},
            {"pickup_date": JAN[1], "fare_amount": 25.0, "trip_distance": 3.0},
            {"pickup_date": JAN[2], "fare_amount": 30.0, "trip_distance": 6.0},
            {"pickup_date": JAN[9], "fare_amount": 999.0, "trip_distance": 999.0},
            {"pickup_date": None},
        )

    @pytest.fixture
    def days(self, readings):
        return categorize_weather(
            readings(
                {"DATE": JAN[0]}, {"DATE": JAN[1], "PRCP": 50}, {"DATE": JAN[2], "SNOW": 30},
                {"DATE": None},
            )
        )

    EXPECTED = [("clear", 2, 15.0, 3.0), ("rain", 1, 25.0, 3.0), ("snow", 1, 30.0, 6.0)]

    def test_report(self, trips, days):
        assert [tuple(r) for r in D.demand_by_weather(trips, days).collect()] == self.EXPECTED

    def test_unmatched_are_counted(self, trips, days):
        assert only(D.unmatched_trips(trips, days))["unmatched_trips"] == 2
        assert only(D.unmatched_trips(trips.limit(0), days))["unmatched_trips"] == 0

    def test_repeated_day_does_not_multiply_trips(self, trips, days, readings):
        more = categorize_weather(readings({"DATE": JAN[0], "PRCP": 1}))
        rows = D.demand_by_weather(trips, days.union(more)).collect()
        assert [(r["weather_condition"], r["trip_count"]) for r in rows] == [("rain", 3), ("snow", 1)]

    def test_unknown_condition_is_an_error(self, trips, days):
        with pytest.raises(Exception, match="unknown weather_condition: hail"):
            D.demand_by_weather(trips, days.withColumn("weather_condition", F.lit("hail"))).collect()

    def test_days_are_broadcast_and_trips_are_reduced_first(self, trips, days, tmp_path):
        path = str(tmp_path / "trips")
        trips.write.parquet(path)
        plan = final_plan_of(D.demand_by_weather(trips.sparkSession.read.parquet(path), days))
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        join, scan = plan.index("BroadcastHashJoin"), plan.index("FileScan")
        assert "HashAggregate" in plan[join:scan]
        assert "Python" not in plan

    def test_same_result_without_broadcast(self, spark, trips, days):
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(name, -1)
        try:
            report = D.demand_by_weather(trips, days)
            assert "BroadcastHashJoin" not in final_plan_of(report)
            assert [tuple(r) for r in report.collect()] == self.EXPECTED
        finally:
            for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
                spark.conf.unset(name)

    def test_share(self, trips, days):
        shares = D.weather_share(D.demand_by_weather(trips, days)).collect()
        assert {r["weather_condition"]: r["share_pct"] for r in shares} == {
            "clear": 50.0, "rain": 25.0, "snow": 25.0,
        }


class TestJoinWeather:
    def test_one_row_per_day_keeps_the_snowiest(self, readings):
        days = readings({"PRCP": 90}, {"SNOW": 5}, {"PRCP": 10})
        assert tuple(only(one_row_per_day(days))) == ("USW00094728", JAN[14], 0, 5)
        assert tuple(only(repeated_days(days))) == (JAN[14], 3)

    def test_join_keeps_every_matched_trip_once(self, clean, readings):
        trips = clean({}, {}, {"pickup_date": JAN[20]})
        joined = join_weather(trips, categorize_weather(readings({}, {"PRCP": 10})))
        assert [r["weather_condition"] for r in joined.collect()] == ["rain", "rain"]
        assert "BroadcastHashJoin" in final_plan_of(joined)

    def test_join_beyond_the_threshold_splits_a_hot_day(self, spark, clean, readings):
        changed = {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        }
        for name, value in changed.items():
            spark.conf.set(name, value)
        try:
            hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 30)
            trips = (
                spark.range(0, 60_000, 1, 8)
                .select(F.date_add(F.lit(JAN[0]), hot.cast("int")).alias("pickup_date"), "id")
            )
            days = readings(*({"DATE": day, "PRCP": 1} for day in JAN))
            joined = join_weather(trips, categorize_weather(days))
            assert "SortMergeJoin(skew=true)" in final_plan_of(joined)
            assert joined.count() == 60_000
        finally:
            for name in changed:
                spark.conf.unset(name)


class TestSummary:
    def test_reports_from_a_summary_equal_those_from_trips(self, clean, readings):
        trips = clean(
            *(
                {
                    "pickup_date": JAN[i % 5],
                    "pickup_hour": i % 24,
                    "day_of_week": i % 7 + 1,
                    "distance_bucket": ("short", "medium", "long")[i % 3],
                    "fare_amount": float(i % 4) * 7,
                    "trip_distance": 0.5 + i,
                    "tip_amount": i % 6 / 2,
                }
                for i in range(100)
            )
        )
        days = categorize_weather(readings({"DATE": JAN[0]}, {"DATE": JAN[1], "SNOW": 1}))
        summary = measures.trip_summary(trips)
        for report in (D.hourly_demand, D.tipping_by_distance, D.fare_per_mile, D.headline):
            assert report(summary).collect() == report(trips).collect()
        for report in (D.demand_by_weather, D.unmatched_trips):
            assert report(summary, days).collect() == report(trips, days).collect()

    def test_null_measures_are_left_out_of_means(self, clean):
        trips = clean({"tip_amount": None}, {"tip_amount": 3.0})
        summary = measures.trip_summary(trips)
        assert only(D.tipping_by_distance(summary))["avg_tip_amount"] == 3.0


class TestSmallReports:
    def test_headline(self, clean):
        row = only(D.headline(clean({"fare_amount": 10.0}, {"fare_amount": 5.555})))
        assert tuple(row) == (2, 15.56, 7.78)

    def test_weekday_split(self, clean):
        trips = clean(
            *[{"day_of_week": 2, "pickup_hour": 18}] * 3,
            *[{"day_of_week": 3, "pickup_hour": 9}] * 2,
            {"day_of_week": 1, "pickup_hour": 12},
            {"day_of_week": 7, "pickup_hour": 12},
            {"day_of_week": 7, "pickup_hour": 3},
        )
        rows = [tuple(r) for r in D.weekday_split(D.hourly_demand(trips), top=2).collect()]
        assert rows == [
            ("weekday", 5, 62.5, 1, 18, 3),
            ("weekday", 5, 62.5, 2, 9, 2),
            ("weekend", 3, 37.5, 1, 12, 2),
            ("weekend", 3, 37.5, 2, 3, 1),
        ]

    def test_peak_hours(self, clean):
        trips = clean(*[{"pickup_hour": 17}] * 2, {"pickup_hour": 5}, {"pickup_hour": 4})
        peaks = D.peak_hours(D.hourly_demand(trips), top=2).collect()
        assert [tuple(r) for r in peaks] == [(17, 2), (4, 1)]
