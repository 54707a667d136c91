"""Trip curation from raw polyline rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline import constants as K
from fareline.functions import geo, paths, timeparts
from fareline.operators.common import dedupe
from fareline.operators.spatial import assign_box_zone, box_index


def is_complete(flag):
    """True unless the missing flag reads TRUE in any case or padding."""
    return F.coalesce(F.upper(F.trim(flag)) != "TRUE", F.lit(True))


def with_points(raw: DataFrame) -> DataFrame:
    """Add the parsed points. The one-element explode keeps later filters on the points from being
    pushed below the parse, where the JSON would be read once more per reference."""
    return raw.select("*", F.explode(F.array(paths.parse_polyline(F.col("POLYLINE")))).alias("points"))


def endpoints(df: DataFrame) -> DataFrame:
    """First and last point and the point count."""
    first, last = F.try_element_at("points", F.lit(1)), F.try_element_at("points", F.lit(-1))
    return df.select(
        *[c for c in df.columns if c != "points"],
        F.size("points").alias("num_gps_points"),
        F.get(last, 1).alias("dest_lat"), F.get(last, 0).alias("dest_lon"),
        F.get(first, 1).alias("orig_lat"), F.get(first, 0).alias("orig_lon"),
    )


def curate_trips(raw: DataFrame, zones: DataFrame, mode: str = "first") -> DataFrame:
    """Raw rows to curated trips.

    The polyline is reduced to its ends before the dedupe, so the one wide shuffle moves narrow
    rows; the row checks run after it, because a bad first copy must not let a later copy in.
    """
    # which of several deliveries counts must not depend on the run: a given order, else a row hash
    order = F.col("delivery") if "delivery" in raw.columns else F.xxhash64(*raw.columns)
    parsed = with_points(raw.withColumn("copy_order", order))
    has_path = F.coalesce(F.size("points") >= 2, F.lit(False))
    narrow = parsed.select(
        F.col("TRIP_ID").alias("trip_id"), F.col("TAXI_ID").alias("taxi_id"), F.col("CALL_TYPE").alias("call_type"),
        F.nullif(F.col("ORIGIN_CALL"), F.lit("")).alias("origin_call"),
        F.nullif(F.col("ORIGIN_STAND"), F.lit("")).alias("origin_stand"),
        F.col("TIMESTAMP").cast("long").alias("timestamp"), F.col("DAY_TYPE").alias("day_type"), "copy_order",
        (is_complete(F.col("MISSING_DATA")) & has_path).alias("usable"),
        F.when(has_path, F.size("points")).alias("num_gps_points"),
        F.when(has_path, F.try_element_at("points", F.lit(1))).alias("p0"),
        F.when(has_path, F.try_element_at("points", F.lit(-1))).alias("p1"),
    )
    one = dedupe(narrow, "trip_id", F.col("copy_order"))
    gated = (
        one.where("usable")
        .withColumn("trip_duration_sec", (F.col("num_gps_points") - 1) * K.POINT_STEP_S)
        .where(F.col("trip_duration_sec").between(*K.TRIP_DURATION_S))
        .where(geo.inside(F.get("p0", 1), F.get("p0", 0), K.METRO_LAT, K.METRO_LON))
    )
    ts = F.timestamp_seconds("timestamp")
    placed = gated.select(
        "trip_id", "taxi_id", "call_type", "origin_call", "origin_stand", "timestamp", ts.alias("event_time"),
        timeparts.year_month(ts).alias("year_month"), "day_type", "num_gps_points", "trip_duration_sec",
        F.get("p0", 1).alias("src_orig_lat"), F.get("p0", 0).alias("src_orig_lon"),
        F.get("p1", 1).alias("src_dest_lat"), F.get("p1", 0).alias("src_dest_lon"),
        geo.remap(F.get("p0", 1), K.SOURCE_LAT, K.TARGET_LAT).alias("orig_lat"),
        geo.remap(F.get("p0", 0), K.SOURCE_LON, K.TARGET_LON).alias("orig_lon"),
        geo.remap(F.get("p1", 1), K.SOURCE_LAT, K.TARGET_LAT).alias("dest_lat"),
        geo.remap(F.get("p1", 0), K.SOURCE_LON, K.TARGET_LON).alias("dest_lon"),
        F.hour(ts).alias("hour_of_day"), F.weekday(ts).alias("day_of_week"),
        timeparts.is_weekend(ts).alias("is_weekend"), timeparts.is_friday(ts).alias("is_friday"),
    )
    index = box_index(zones)
    zoned = assign_box_zone(placed, zones, "orig_lat", "orig_lon", mode, "origin_", index=index)
    zoned = assign_box_zone(zoned, zones, "dest_lat", "dest_lon", mode, "dest_", index=index)
    return drop_unzoned(zoned).withColumn(
        "trip_distance_km",
        geo.sphcos_km(F.col("orig_lat"), F.col("orig_lon"), F.col("dest_lat"), F.col("dest_lon")),
    )


def drop_unzoned(df: DataFrame) -> DataFrame:
    return df.where("origin_zone IS NOT NULL AND dest_zone IS NOT NULL")


def curate_located(trips: DataFrame, zones: DataFrame, mode: str = "first") -> DataFrame:
    """Curated form of trips that already carry target coordinates."""
    index = box_index(zones)
    z = assign_box_zone(trips, zones, "o_lat", "o_lon", mode, "origin_", index=index)
    z = drop_unzoned(assign_box_zone(z, zones, "d_lat", "d_lon", mode, "dest_", index=index))
    ts = F.col("event_time")
    return z.withColumns(
        {
            "trip_duration_sec": F.col("duration_s"),
            "trip_distance_km": geo.sphcos_km(F.col("o_lat"), F.col("o_lon"), F.col("d_lat"), F.col("d_lon")),
            "hour_of_day": F.hour(ts),
            "day_of_week": F.weekday(ts),
            "is_weekend": timeparts.is_weekend(ts),
            "is_friday": timeparts.is_friday(ts),
            "trip_date": F.to_date(ts),
            "slot_of_day": timeparts.slot_of_day(ts),
        }
    )


def urban_gate(df: DataFrame) -> DataFrame:
    """City-trip realism: box at both ends, point count, duration, length and mean speed."""
    p0, p1 = F.try_element_at("points", F.lit(1)), F.try_element_at("points", F.lit(-1))
    n = F.size("points")
    return (
        df.where(geo.inside(F.get(p0, 1), F.get(p0, 0), K.URBAN_LAT, K.URBAN_LON) & geo.inside(F.get(p1, 1), F.get(p1, 0), K.URBAN_LAT, K.URBAN_LON))
        .where(n.between(4, 400))
        .withColumn("duration_s", (n - 1) * K.POINT_STEP_S)
        .withColumn("distance_km", paths.path_km(F.col("points")))
        .withColumn("avg_speed_kmh", F.when(F.col("duration_s") > 0, F.col("distance_km") / (F.col("duration_s") / 3600)).otherwise(0.0))
        .where("duration_s BETWEEN 180 AND 1800 AND distance_km BETWEEN 1.5 AND 18 AND avg_speed_kmh BETWEEN 8 AND 65")
    )


def etl_summary(df: DataFrame) -> DataFrame:
    """Headline scalars of a curated set in one pass."""
    return df.agg(
        F.count("*").alias("n_trips"),
        F.avg("trip_duration_sec").alias("avg_duration_sec"),
        F.avg("trip_distance_km").alias("avg_distance_km"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
        F.count_distinct("origin_zone").alias("n_zones"),
    )
