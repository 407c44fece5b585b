"""Answer the five trip questions from the cleaned table and write one result table each."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from fareloom.operators import demand
from fareloom.operators.weather import categorize_weather
from fareloom.plans.measures import TripSummary, trip_summary
from fareloom.session import session
from fareloom.sinks import write_csv, write_results
from fareloom.sources import read_clean_trips, read_result, read_weather

# Result table names are fixed values; rows is how many of each are printed.
PRINTED = {
    "q1_hourly_demand": 48,
    "q2_zone_revenue": 20,
    "q3_tipping": 20,
    "q4_fare_per_mile": 20,
    "q5_weather_demand": 20,
}


def run(trips: DataFrame, weather: DataFrame, output: str) -> dict[str, DataFrame]:
    """Write the results and return them as read back.

    Two scans of the trips serve all five: one for the summary behind four reports, one for the
    zones. The summary is written first, so that losing an executor later costs no new scan.
    """
    spark = trips.sparkSession
    write_results({"trip_summary": trip_summary(trips).table}, output)
    summary = TripSummary(read_result(spark, output, "trip_summary"))
    results = {
        "q1_hourly_demand": demand.hourly_demand(summary),
        "q2_zone_revenue": demand.zone_revenue(trips),
        "q3_tipping": demand.tipping_by_distance(summary),
        "q4_fare_per_mile": demand.fare_per_mile(summary),
        "q5_weather_demand": demand.demand_by_weather(summary, weather),
    }
    write_results(results, output)
    return {name: read_result(spark, output, name) for name in results}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("trips", help="cleaned trip table")
    parser.add_argument("weather", help="daily weather CSV")
    parser.add_argument("output", help="folder of the result tables")
    parser.add_argument("--csv", help="also write each result as one CSV below this folder")
    args = parser.parse_args(argv)
    spark = session("fareloom-analytics")
    weather = categorize_weather(read_weather(spark, args.weather))
    for name, result in run(read_clean_trips(spark, args.trips), weather, args.output).items():
        print(f"\n{name}")
        result.show(PRINTED[name])
        if args.csv:
            write_csv(result, f"{args.csv.rstrip('/')}/{name}", single_file=True)


if __name__ == "__main__":
    main()
