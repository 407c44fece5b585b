"""Daily weather readers. Columns are found by header name, never by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.schema import WEATHER_COLUMNS


def _by_name(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """STATION, DATE, PRCP, SNOW; unreadable values are NULL, missing PRCP and SNOW are 0."""
    readings = _by_name(spark, path).select(
        *(F.col(name).try_cast(kind).alias(name) for name, kind in WEATHER_COLUMNS.items())
    )
    return readings.fillna({"PRCP": 0, "SNOW": 0})


def extract_weather(
    spark: SparkSession, path: str, first: str = "2019-01-01", last: str = "2022-12-31"
) -> DataFrame:
    """The four columns of interest of a wide station file, one period of it, blanks as ``0``.

    Values stay text, as the result is written back as CSV.
    """

    def filled(name: str):
        text = F.trim(F.col(name))
        return F.coalesce(F.nullif(text, F.lit("")), F.lit("0")).alias(name)

    return (
        _by_name(spark, path)
        .filter(F.col("DATE").between(first, last))
        .select("STATION", "DATE", filled("PRCP"), filled("SNOW"))
    )
