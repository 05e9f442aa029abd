"""Typed scans of delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The columns of the daily weather file, in file order.
WEATHER_SCHEMA = (
    "Date string, Location string, MinTemp double, MaxTemp double, Rainfall double, "
    "Evaporation double, Sunshine double, WindGustDir string, WindGustSpeed double, "
    "WindDir9am string, WindDir3pm string, WindSpeed9am int, WindSpeed3pm int, "
    "Humidity9am int, Humidity3pm int, Pressure9am double, Pressure3pm double, "
    "Cloud9am int, Cloud3pm int, Temp9am double, Temp3pm double, "
    "RainToday string, RainTomorrow string"
)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    delimiter: str = ",",
    header: bool = True,
    null_value: str | None = None,
) -> DataFrame:
    """Scan text with a fixed schema; nothing is inferred, so the file is read
    once. A field that does not fit its type becomes NULL. ``null_value`` turns
    a text into NULL in every column; leave it unset to keep it in some."""
    reader = spark.read.schema(schema).option("sep", delimiter).option("header", header).option("mode", "PERMISSIVE")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


def write_delimited(df: DataFrame, path: str, delimiter: str = ",", null_value: str = "NA") -> None:
    df.write.option("sep", delimiter).option("header", True).option("nullValue", null_value).csv(path)


def first_row(df: DataFrame, *order_by: str) -> DataFrame:
    """The least row by a stated order."""
    return df.orderBy(*order_by).limit(1)
