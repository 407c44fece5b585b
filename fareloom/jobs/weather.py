"""Cut the daily weather table out of a wide station file."""

from __future__ import annotations

import argparse

from fareloom.session import session
from fareloom.sinks import write_csv
from fareloom.sources import extract_weather


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("stations", help="wide station CSV")
    parser.add_argument("output", help="folder of the daily weather CSV")
    parser.add_argument("--first", default="2019-01-01")
    parser.add_argument("--last", default="2022-12-31")
    args = parser.parse_args(argv)
    spark = session("fareloom-weather")
    write_csv(extract_weather(spark, args.stations, args.first, args.last), args.output)


if __name__ == "__main__":
    main()
