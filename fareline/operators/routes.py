"""Point sequences: explode, nest, speeds, status, route lookup and replay."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline import constants as K
from fareline.functions import draws, geo, paths
from fareline.operators.common import ranked
from fareline.session import cut_lineage, small_side


def polyline_points(df: DataFrame) -> DataFrame:
    """One row per point with its index. The explode is a narrow step; order is carried by ``seq``."""
    return df.select("trip_id", F.posexplode("points").alias("seq", "p")).select(
        "trip_id", "seq", F.get("p", 1).alias("lat"), F.get("p", 0).alias("lon"))


def nest_points(points: DataFrame) -> DataFrame:
    """Points back to one array per trip in sequence order. A trip has a bounded number of points
    (one per 15 s of driving)."""
    return points.groupBy("trip_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "lon", "lat"))), lambda s: F.array(s["lon"], s["lat"])).alias("points"))


def ping_speed(points: DataFrame, step_s: int = K.POINT_STEP_S) -> DataFrame:
    """Speed from the previous point, one decimal, 0 for the first."""
    w = Window.partitionBy("trip_id").orderBy("seq")
    km = geo.haversine_atan_km(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon"))
    return points.withColumn("speed_kmh", F.coalesce(F.round(km / (step_s / 3600), 1), F.lit(0.0)))


def ping_status(points: DataFrame) -> DataFrame:
    """First point is the pickup, last the dropoff."""
    last = F.max("seq").over(Window.partitionBy("trip_id"))
    return points.withColumn("status", F.when(F.col("seq") == 0, "pickup").when(F.col("seq") == last, "dropoff").otherwise("moving"))


def assign_fleet(trips: DataFrame, fleet: int, time: str = "event_time", tie: str = "trip_id") -> DataFrame:
    """Round-robin vehicle ids over the trips in time order, by distributed global positions."""
    pos = ranked(trips, time, tie, "position")
    return pos.withColumn("vehicle_id", F.format_string("taxi_%04d", F.col("position") % fleet))


def trajectory_index(routes: DataFrame) -> DataFrame:
    """Route ids by zone pair and by class pair, long form with an ordinal per key.

    A list per key would put a hot pair's ids into one row, so the
    ordinal table keeps them as rows and still answers 'the n-th route of this pair'.
    """
    keyed = routes.select("route_id", "event_time", F.inline(F.array(
        F.struct(F.lit("zone").alias("kind"), F.concat_ws("-", "origin_zone", "dest_zone").alias("key")),
        F.struct(F.lit("class").alias("kind"), F.concat_ws("-", "origin_class", "dest_class").alias("key")),
        F.struct(F.lit("any").alias("kind"), F.lit("*").alias("key")))))
    return keyed


def with_ordinals(index: DataFrame, slots: int = 65536) -> tuple[DataFrame, DataFrame]:
    """Number the routes of each key 0..n-1 by (hash slot, hash, id) and return (numbered, sizes).

    Numbering runs per (key, hash slot) with slot offsets, so a hot key is spread over the slots."""
    h = geo.hash32(F.col("route_id"))
    keyed = index.withColumn("_h", h).withColumn("_slot", F.floor(F.col("_h") / F.lit(4294967296.0 / slots)))
    counts = keyed.groupBy("kind", "key", "_slot").agg(F.count("*").alias("_n"))
    w = Window.partitionBy("kind", "key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    inner = F.row_number().over(Window.partitionBy("kind", "key", "_slot").orderBy("_h", "route_id"))
    numbered = keyed.join(offs, ["kind", "key", "_slot"]).withColumn("ordinal", F.col("_off") + inner - 1).drop("_h", "_slot", "_off")
    sizes = counts.groupBy("kind", "key").agg(F.sum("_n").alias("size"))
    return numbered, sizes


def pick_trajectory(trips: DataFrame, index: DataFrame, seed: int = 42) -> DataFrame:
    """Route per trip: same zone pair, else same class pair, else any; which one is a hashed ordinal.

    The level is decided first from the (small) key sizes, so each trip makes exactly one equi-join
    on (kind, key, ordinal). The ordinal spreads a hot pair over as many join keys as it has routes.
    """
    numbered, sizes = with_ordinals(index)
    sizes = cut_lineage(sizes, "route-sizes")  # a row per key: the written size decides on broadcast

    def level(kind, key):
        s = sizes.where(F.col("kind") == kind).select(F.col("key").alias(f"_{kind}_key"), F.col("size").alias(f"_{kind}_n"))
        return small_side(s), F.col(f"_{kind}_key") == key

    zone_key = F.concat_ws("-", "origin_zone", "dest_zone")
    class_key = F.concat_ws("-", "origin_class", "dest_class")
    total = sizes.where("kind = 'any'").agg(F.max("size")).scalar()
    t = trips
    for kind, key in (("zone", zone_key), ("class", class_key)):
        side, cond = level(kind, key)
        t = t.join(side, cond, "left")
    picked = t.withColumn(
        "kind", F.when(F.col("_zone_n").isNotNull(), "zone").when(F.col("_class_n").isNotNull(), "class").otherwise("any")
    ).withColumn(
        "key", F.when(F.col("kind") == "zone", zone_key).when(F.col("kind") == "class", class_key).otherwise("*")
    ).withColumn(
        "ordinal", F.floor(draws.uniform(F.col("trip_id"), "route", seed) * F.coalesce("_zone_n", "_class_n", total)))
    return picked.drop("_zone_key", "_zone_n", "_class_key", "_class_n").join(
        numbered.select("kind", "key", "ordinal", "route_id"), ["kind", "key", "ordinal"])


def adapt_path(df: DataFrame, start: Column, points: str = "points") -> DataFrame:
    """Replay a path's scaled steps from a new start in the target box."""
    lon_scale = (K.TARGET_LON[1] - K.TARGET_LON[0]) / abs(K.SOURCE_LON[1] - K.SOURCE_LON[0])
    lat_scale = (K.TARGET_LAT[1] - K.TARGET_LAT[0]) / (K.SOURCE_LAT[1] - K.SOURCE_LAT[0])
    return df.withColumn("adapted", paths.replay_steps(F.col(points), start, lon_scale, lat_scale, K.TARGET_LON, K.TARGET_LAT))


def late_arrival(df: DataFrame, row_id: str, planned: str, seed: int, p: float = K.BLACKOUT_P, delay=K.BLACKOUT_S) -> DataFrame:
    """Arrival = planned time, or later for a hashed share of the rows."""
    hit = draws.uniform(F.col(row_id), "late", seed) < p
    wait = draws.integer(F.col(row_id), "wait", seed, *delay)
    us = F.unix_micros(planned) + F.when(hit, wait.cast("long") * 1_000_000).otherwise(F.lit(0))
    return df.withColumn("arrival", F.timestamp_micros(us))
