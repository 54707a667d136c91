"""Derived frames several queries start from."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.operators import meter, spatial, trips
from fareline.sources.tables import pings, requests, table  # noqa: F401

YEAR = 1998


def zones(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "zones")


def curated(spark: SparkSession, sf: str) -> DataFrame:
    return trips.curate_located(table(spark, sf, "trips"), zones(spark, sf))


def raw_once(spark: SparkSession, sf: str) -> DataFrame:
    """Raw trip rows without repeated deliveries."""
    return trips.with_points(table(spark, sf, "raw_trips").where("delivery = 1")).drop("delivery")


def usable(spark: SparkSession, sf: str) -> DataFrame:
    return raw_once(spark, sf).where(trips.is_complete(F.col("MISSING_DATA"))).where(F.size("points") >= 2)


def clean_meter(spark: SparkSession, sf: str) -> DataFrame:
    return meter.with_features(meter.clean_trips(table(spark, sf, "meter")))


def demand(spark: SparkSession, sf: str) -> DataFrame:
    return meter.demand(clean_meter(spark, sf))


def realistic(spark: SparkSession, sf: str) -> DataFrame:
    return meter.realism_gate(table(spark, sf, "meter"), YEAR)


def lookup(spark: SparkSession, sf: str) -> DataFrame:
    return spatial.cell_lookup(zones(spark, sf))
