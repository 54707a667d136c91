"""Metered-trip cleaning and demand aggregates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.functions import timeparts

#: Cleaning rules in their order of application.
CLEAN_RULES: tuple[tuple[str, str], ...] = (
    ("pickup_known", "tpep_pickup_datetime IS NOT NULL"),
    ("dropoff_known", "tpep_dropoff_datetime IS NOT NULL"),
    ("distance_over_0", "trip_distance > 0"),
    ("distance_under_100", "trip_distance < 100"),
    ("fare_over_0", "fare_amount > 0"),
    ("fare_under_500", "fare_amount < 500"),
    ("passengers_over_0", "passenger_count > 0"),
    ("pickup_zone_known", "PULocationID IS NOT NULL"),
    ("dropoff_zone_known", "DOLocationID IS NOT NULL"),
)


def clean_trips(df: DataFrame, rules=CLEAN_RULES) -> DataFrame:
    for _, rule in rules:
        df = df.where(rule)
    return df


def clean_funnel(df: DataFrame, rules=CLEAN_RULES) -> DataFrame:
    """Rows left and removed after each rule, from one pass over the data."""
    passed: list[Column] = []
    sofar = F.lit(True)
    for _, rule in rules:
        sofar = sofar & F.coalesce(F.expr(rule), F.lit(False))
        passed.append(F.count_if(sofar))
    counted = df.agg(F.array(F.count("*"), *passed).alias("n"))
    steps = F.array(*[
        F.struct(
            F.lit(i + 1).alias("step"), F.lit(name).alias("rule"),
            F.col("n")[i + 1].alias("kept"), (F.col("n")[i] - F.col("n")[i + 1]).alias("removed"),
        )
        for i, (name, _) in enumerate(rules)
    ])
    return counted.select(F.inline(steps))


def with_features(df: DataFrame) -> DataFrame:
    ts = F.col("tpep_pickup_datetime")
    return df.withColumns(
        {
            "pickup_hour": F.hour(ts),
            "pickup_date": F.to_date(ts),
            "day_of_week": F.dayofweek(ts),
            "is_weekend": timeparts.flag(F.dayofweek(ts).isin(1, 7)),
            "year_month": timeparts.year_month(ts),
            "trip_duration_sec": timeparts.seconds_between(ts, F.col("tpep_dropoff_datetime")).cast("int"),
        }
    )


def demand(df: DataFrame) -> DataFrame:
    """Trips per pickup zone, hour and date."""
    return df.groupBy(F.col("PULocationID").alias("pickup_zone_id"), "pickup_hour", "pickup_date", "day_of_week", "is_weekend").agg(
        F.count("*").alias("trip_count"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("trip_duration_sec").alias("avg_duration_sec"),
        F.sum("passenger_count").alias("total_passengers"),
    )


def hourly_curve(dem: DataFrame) -> DataFrame:
    return dem.groupBy("pickup_hour").agg(
        F.avg("trip_count").alias("avg_trips_per_zone"), F.sum("trip_count").alias("total_trips")
    ).orderBy("pickup_hour")


def top_zones(dem: DataFrame) -> DataFrame:
    return dem.groupBy("pickup_zone_id").agg(F.sum("trip_count").alias("total_trips")).orderBy(F.desc("total_trips"), "pickup_zone_id")


def top_n_share(dem: DataFrame, n: int = 20) -> DataFrame:
    """Leading zones with their share of all trips."""
    total = dem.agg(F.sum("trip_count")).scalar()
    return top_zones(dem).limit(n).withColumn("share_pct", F.col("total_trips") / total * 100)


def weekend_ratio(dem: DataFrame) -> DataFrame:
    """Weekday and weekend mean demand per hour, and their ratio."""
    day = lambda w: F.avg(F.when(F.col("is_weekend") == w, F.col("trip_count")))
    return dem.groupBy("pickup_hour").agg(day(0).alias("weekday_mean"), day(1).alias("weekend_mean")).withColumn(
        "ratio", F.col("weekend_mean") / F.col("weekday_mean")
    )


def realism_gate(df: DataFrame, year: int) -> DataFrame:
    """Eight range checks including the derived speed."""
    dur = timeparts.seconds_between(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))
    return (
        df.withColumn("duration_s", dur)
        .withColumn("avg_speed_mph", F.when(dur > 0, F.col("trip_distance") / (dur / 3600.0)).otherwise(0.0))
        .withColumn("hour", F.hour("tpep_pickup_datetime"))
        .withColumn("dow", F.weekday("tpep_pickup_datetime"))
        .where("trip_distance BETWEEN 0.2 AND 60 AND fare_amount BETWEEN 2.5 AND 250 AND passenger_count BETWEEN 1 AND 6")
        .where("duration_s BETWEEN 60 AND 10800 AND avg_speed_mph BETWEEN 3 AND 90")
        .where("PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263")
        .where(F.year("tpep_pickup_datetime") == year)
    )


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null count and percent per column plus rows with any null, in one pass."""
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    one = df.agg(
        F.count("*").alias("n"),
        F.struct(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols], F.count_if(any_null).alias("(any)")).alias("k"),
    )
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("k").getField(c).alias("nulls")) for c in [*cols, "(any)"]])
    return one.select("n", F.inline(rows)).select("column_name", "nulls", (F.col("nulls") / F.col("n") * 100).alias("pct"))
