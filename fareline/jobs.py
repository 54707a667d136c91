"""Batch jobs on paths, for ``spark-submit fareline/jobs.py <job> ...`` or ``python -m fareline.jobs``.

    etl-trips   raw trip CSV + zone CSV        -> curated trips by month
    etl-meter   drifting meter Parquet files   -> demand per zone, hour and date
    kpis        curated trips                  -> one folder per indicator
    features    curated trips                  -> feature matrix
    train       feature matrix                 -> saved model and metrics
    score       saved model + feature rows     -> predictions
"""

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fareline.functions import timeparts
from fareline.operators import features, forecast, kpi, meter, trips
from fareline.session import build_session
from fareline.sources import readers, sinks

INDICATORS = {
    "trips_per_zone": kpi.trips_per_zone,
    "hourly_demand": kpi.hourly,
    "peak_hours": kpi.peak_hours,
    "daily_pattern": kpi.weekday_pattern,
    "zone_hour_heatmap": kpi.zone_hour,
    "coverage_gaps": kpi.coverage_gaps,
    "call_type_breakdown": kpi.call_types,
}


def etl_trips(spark: SparkSession, source: str, zones: str, target: str, mode: str = "first", salt: int = 1) -> dict:
    """Curate and write in one pass; the summary is observed while writing, not by extra jobs."""
    curated = trips.curate_trips(readers.read_trips_csv(spark, source), readers.read_zones(spark, zones), mode)
    seen = Observation("curated")
    watched = curated.observe(
        seen, F.count(F.lit(1)).alias("trips"), F.avg("trip_duration_sec").alias("avg_duration_sec"), F.avg("trip_distance_km").alias("avg_distance_km"))
    sinks.write_partitioned(watched, target, "year_month", salt)
    return seen.get


def etl_meter(spark: SparkSession, sources: list[str], target: str) -> dict:
    raw = readers.read_normalized(spark, sources)
    seen = Observation("cleaned")
    clean = meter.with_features(meter.clean_trips(raw)).observe(
        seen, F.count(F.lit(1)).alias("trips"), F.avg("fare_amount").alias("avg_fare"), F.avg("trip_distance").alias("avg_distance"))
    meter.demand(clean).write.mode("overwrite").parquet(target)
    return seen.get


def kpis(spark: SparkSession, source: str, target: str) -> None:
    """Each indicator reads only its own columns of the curated table."""
    df = readers.read_partitioned(spark, source)
    for name, fn in INDICATORS.items():
        sinks.write_small(fn(df), f"{target}/{name}")


def build_matrix(spark: SparkSession, source: str, target: str, calendar_lag: bool = False) -> None:
    df = readers.read_partitioned(spark, source)
    ts = F.col("event_time")
    slotted = df.withColumns({"trip_date": F.to_date(ts), "slot_of_day": timeparts.slot_of_day(ts)})
    features.build_features(features.slot_demand(slotted), calendar_lag).write.mode("overwrite").parquet(target)


def train(spark: SparkSession, source: str, split: str, model_path: str, metrics_path: str, iterations: int = 50, leaky: bool = False) -> DataFrame:
    before, after = features.split_at(spark.read.parquet(source), split)
    model = forecast.train_gbt(before, leaky=leaky, iterations=iterations)
    forecast.save_model(model, model_path)
    table = forecast.improvement(forecast.metrics(forecast.score(model, after)), forecast.metrics(forecast.naive(after)))
    sinks.write_small(table, metrics_path)
    return spark.read.parquet(metrics_path)


def score(spark: SparkSession, model_path: str, source: str, target: str) -> None:
    forecast.score(forecast.load_model(model_path), spark.read.parquet(source)).write.mode("overwrite").parquet(target)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="job", required=True)
    for name, args in {
        "etl-trips": ("source", "zones", "target"), "etl-meter": ("target", "sources+"), "kpis": ("source", "target"),
        "features": ("source", "target"), "train": ("source", "split", "model", "metrics"), "score": ("model", "source", "target"),
    }.items():
        job = sub.add_parser(name)
        for a in args:
            job.add_argument(a.rstrip("+"), nargs="+" if a.endswith("+") else None)
        if name == "etl-trips":
            job.add_argument("--mode", choices=("first", "last", "all"), default="first")
            job.add_argument("--salt", type=int, default=1, help="writers per month folder")
    a = p.parse_args(argv)
    spark = build_session()
    if a.job == "etl-trips":
        print(etl_trips(spark, a.source, a.zones, a.target, a.mode, a.salt))
    elif a.job == "etl-meter":
        print(etl_meter(spark, a.sources, a.target))
    elif a.job == "kpis":
        kpis(spark, a.source, a.target)
    elif a.job == "features":
        build_matrix(spark, a.source, a.target)
    elif a.job == "train":
        train(spark, a.source, a.split, a.model, a.metrics).show(truncate=False)
    else:
        score(spark, a.model, a.source, a.target)


if __name__ == "__main__":
    main()
