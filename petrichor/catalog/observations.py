"""The test tables seen as observations and as scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.presets import FeatureSet
from ..sources.tables import table

KEYS = ("l_orderkey", "l_linenumber")
DAY_KEYS = ("obs_date", "location")

# Typed columns of the observation file.
OBS_SCHEMA = (
    "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, obs_date string, location string, "
    "price double, quantity double, flag string, code int, target string"
)

OBS_FEATURES = FeatureSet(
    name="line_items",
    keys=KEYS,
    label="target",
    numeric=("price", "quantity"),
    categorical=("Month", "location", "flag"),
    impute_mode=("flag",),
    domain={"code": (0, 8)},
    date="obs_date",
    invalid="skip",
)


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a date, a place, missing numbers, a sentinel text, an
    out-of-range code and missing classes. Every row of the table is kept."""
    li = table(spark, folder, "lineitem")

    def missing(key: str, step: int):
        return F.col(key) % step == 0

    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_shipdate").cast("date").cast("string").alias("obs_date"),
        F.concat(F.lit("S"), (F.col("l_suppkey") % 49).cast("string")).alias("location"),
        F.when(~missing("l_orderkey", 11), F.col("l_extendedprice")).alias("price"),
        F.when(~missing("l_orderkey", 13), F.col("l_quantity")).alias("quantity"),
        F.when(missing("l_partkey", 7), F.lit("NA"))
        .when(~missing("l_partkey", 17), F.col("l_returnflag"))
        .alias("flag"),
        F.when(missing("l_partkey", 19), F.lit(99))
        .when(~missing("l_partkey", 23), F.col("l_linenumber"))
        .alias("code"),
        F.when(~missing("l_suppkey", 23), F.col("l_linestatus")).alias("target"),
    )


def scored_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a class, a hard prediction and two scores: ``score``
    with few distinct values and ``price`` with about one per row."""
    li = table(spark, folder, "lineitem")
    return li.select(
        *KEYS,
        (F.col("l_linestatus") == "O").cast("double").alias("label"),
        (F.col("l_discount") >= 0.05).cast("double").alias("prediction"),
        F.round(F.col("l_discount") * 7 + F.col("l_tax") * 3 + F.col("l_quantity") / 50.0, 6).alias("score"),
        F.col("l_extendedprice").alias("price"),
    )
