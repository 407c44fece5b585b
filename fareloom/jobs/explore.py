"""Profile raw trips."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from fareloom.operators import demand, profile
from fareloom.operators.clean import add_calendar
from fareloom.session import session
from fareloom.sinks import preview
from fareloom.sources import read_trips

SAMPLED = (
    "tpep_pickup_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "payment_type",
)


def reports(raw: DataFrame) -> dict[str, DataFrame]:
    hourly = demand.hourly_demand(add_calendar(raw))
    return {
        "schema": profile.schema_report(raw),
        "rows": profile.row_count(raw),
        "statistics": profile.describe(raw),
        "missing values": profile.null_counts(raw),
        "cleaning audit": profile.audit_cleaning(raw),
        "facts": profile.data_facts(raw),
        "peak hours": demand.peak_hours(hourly),
        "sample": preview(raw, 10, SAMPLED),
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("trips", help="raw trip Parquet")
    args = parser.parse_args(argv)
    spark = session("fareloom-explore")
    for title, report in reports(read_trips(spark, args.trips)).items():
        print(f"\n{title}")
        report.show(50, truncate=False)


if __name__ == "__main__":
    main()
