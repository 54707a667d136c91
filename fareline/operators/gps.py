"""Position normalising, the batch form. Column rules are shared with the streaming job."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline import constants as K
from fareline.functions import geo, timeparts
from fareline.operators.common import running_max_before
from fareline.operators.spatial import assign_cell_zone
from fareline.session import small_side


def strictly_increasing(df: DataFrame, key: str = "taxi_id", ts: str = "event_time", arrival: str = "arrival", tie: str = "event_id") -> DataFrame:
    """Keep a row only if its event time is later than every earlier arrival of its key.

    Runs before validation, so an invalid row still moves the key's clock. The per-key scan is split
    by arrival minute, which keeps a very busy key parallel.
    """
    bucket = F.floor(F.unix_timestamp(arrival) / 60)
    scanned = running_max_before(df, key, ts, [arrival, tie], bucket, "_seen")
    return scanned.where(F.col("_seen").isNull() | (F.col(ts) > F.col("_seen"))).drop("_seen")


def is_valid(lat: Column, lon: Column, speed: Column, snap_m: Column, cell: Column) -> Column:
    """Box, speed 0..150 (unknown passes), snap distance up to 333 m (unknown passes), cell known."""
    return (
        geo.inside(lat, lon, K.TARGET_LAT, K.TARGET_LON)
        & F.coalesce(speed.between(0.0, K.MAX_SPEED_KMH), F.lit(True))
        & F.coalesce(snap_m <= K.SNAP_LIMIT_M, F.lit(True))
        & cell.isNotNull()
    )


def valid_pings(df: DataFrame) -> DataFrame:
    return df.where(is_valid(F.col("lat"), F.col("lon"), F.col("speed_kmh"), F.col("snap_dist_m"), F.col("cell")))


def anonymize(df: DataFrame, lookup: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone by cell, then the position replaced by a stable point near the zone centre."""
    zoned = assign_cell_zone(df, lookup, how="inner").drop("zone_name")
    dim = zones.select("zone_id", "centroid_lat", "centroid_lon", "lat_min", "lat_max", "lon_min", "lon_max")
    box = (F.col("lat_min"), F.col("lat_max"), F.col("lon_min"), F.col("lon_max"))
    lat, lon = geo.privacy_point(F.col("taxi_id"), F.col("centroid_lat"), F.col("centroid_lon"), box)
    return zoned.join(small_side(dim), "zone_id").withColumns({"lat": lat, "lon": lon}).drop("lat_min", "lat_max", "lon_min", "lon_max")


def normalize_pings(df: DataFrame, lookup: DataFrame, zones: DataFrame) -> DataFrame:
    """Dedupe, validate, zone and anonymise, in that order."""
    return anonymize(valid_pings(strictly_increasing(df)), lookup, zones)


def demand_window(pings: DataFrame, requests: DataFrame, seconds: int = K.DEMAND_WINDOW_S) -> DataFrame:
    """Distinct vehicles, requests and their ratio per zone and tumbling window.

    ``pings`` has zone_id, taxi_id, event_time; ``requests`` has zone_id, event_time. The distinct
    count is two-phase, so a hot zone is spread over its vehicles first."""
    both = pings.select("zone_id", "event_time", "taxi_id", F.lit(0).alias("req")).unionByName(
        requests.select("zone_id", "event_time", F.lit(None).cast("string").alias("taxi_id"), F.lit(1).alias("req")))
    g = both.groupBy("zone_id", F.window("event_time", f"{seconds} seconds").alias("w")).agg(
        F.count_distinct("taxi_id").alias("unique_vehicles"), F.sum("req").alias("pending_requests"))
    return shape_demand(g)


def shape_demand(g: DataFrame) -> DataFrame:
    """Output columns of a demand window; the ratio is requests per vehicle, zero vehicles count 1."""
    return g.select(
        F.lit(K.CITY).alias("city"), "zone_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "unique_vehicles", "pending_requests",
        (F.col("pending_requests") / F.greatest("unique_vehicles", F.lit(1))).alias("ratio"),
    )


def demand_topic(demand: DataFrame) -> DataFrame:
    """The message form: ISO times, ratio to three digits."""
    return demand.withColumns({
        "window_start": timeparts.iso_utc(F.col("window_start")), "window_end": timeparts.iso_utc(F.col("window_end")),
        "ratio": F.round("ratio", 3)})


def demand_table(demand: DataFrame) -> DataFrame:
    """The table form: raw ratio, forecast left open for batch scoring."""
    return demand.select(
        "city", "zone_id", "window_start", F.col("unique_vehicles").alias("active_vehicles"), "pending_requests", "ratio",
        F.lit(None).cast("double").alias("forecast_demand"))
