"""Clean raw trips into a Parquet table."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fareloom.operators.clean import clean_trips
from fareloom.session import session
from fareloom.sinks import preview, write_trips
from fareloom.sources import read_clean_trips, read_trips, read_trips_pinned

SHOWN = (
    "pickup_date",
    "pickup_hour",
    "day_of_week",
    "time_of_day",
    "PULocationID",
    "trip_distance",
    "distance_bucket",
    "fare_amount",
    "fare_norm",
    "pay_credit_card",
)


def counted_rows(trips: DataFrame) -> tuple[DataFrame, Observation]:
    """The trips, and their number as the job that reads them finds it."""
    seen = Observation()
    return trips.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("trips", help="raw trip Parquet")
    parser.add_argument("output", help="folder of the cleaned table")
    parser.add_argument("--pinned", action="store_true", help="reconcile drifting column types")
    parser.add_argument("--partition-by", nargs="*", default=[], metavar="COLUMN")
    parser.add_argument("--rebalance", action="store_true", help="input is not in partition order")
    parser.add_argument("--only-touched", action="store_true", help="keep other partitions")
    parser.add_argument("--reject-nan-distance", action="store_true")
    args = parser.parse_args(argv)
    spark = session("fareloom-preprocess")
    read = read_trips_pinned if args.pinned else read_trips
    raw = read(spark, args.trips)
    raw_rows = raw.count()  # reads no column; counting below the filters would keep them from the scan
    clean = clean_trips(raw, keep_nan_distance=not args.reject_nan_distance)
    clean, kept = counted_rows(clean)
    write_trips(clean, args.output, args.partition_by, args.rebalance, args.only_touched)
    print("raw_rows", raw_rows, "clean_rows", kept.get["rows"], "dropped_rows", raw_rows - kept.get["rows"])
    preview(read_clean_trips(spark, args.output), 5, SHOWN).show()


if __name__ == "__main__":
    main()
