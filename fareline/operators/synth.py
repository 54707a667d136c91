"""Calibrated synthetic demand.

Shapes (hour, weekday, tier flow, passengers, distance) are measured on real trips and drawn again
for the target city. A draw is a hashed uniform joined to a cumulative table by equi-join on a
bucket of the uniform, so the whole generator is one map stage with broadcast lookups: nothing is
collected and no row depends on another.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline import constants as K
from fareline.functions import draws, geo, pricing
from fareline.operators.common import fill_spine
from fareline.session import small_side, spread

BUCKETS = 128


# --- fingerprints -----------------------------------------------------------------------------

def clipped_km(miles: Column) -> Column:
    return draws.clip(miles * K.MILE_KM, *K.SYNTH_DIST_KM)


def fingerprint(df: DataFrame, *keys: str) -> DataFrame:
    """Count and share per key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).withColumn("p", F.col("n") / df.agg(F.count("*")).scalar())


def _constant_rows(spark, values, name: str, start: int = 0) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(i + start).alias(name), F.lit(float(v)).alias("w")) for i, v in enumerate(values)])
    return spark.range(1).select(F.inline(rows))


def profile(df: DataFrame) -> DataFrame:
    """Every count the generator needs from one scan of the source trips: (hour, weekday),
    passengers, clipped distance, and zone pair, as grouping sets told apart by ``part``."""
    rows = df.select("hour", "dow", "passenger_count", F.round(clipped_km(F.col("trip_distance")), 3).alias("dist_km"), "PULocationID", "DOLocationID")
    sets = [["hour", "dow"], ["passenger_count"], ["dist_km"], ["PULocationID", "DOLocationID"]]
    counted = rows.groupingSets(sets, *rows.columns).agg(F.count("*").alias("n"), F.grouping_id().alias("gid"))
    width = len(rows.columns)
    part = F.lit(None).cast("string")
    for name, cols in zip(("hour_dow", "passengers", "distance", "pairs"), sets):
        gid = sum(1 << (width - 1 - i) for i, c in enumerate(rows.columns) if c not in cols)
        part = F.when(F.col("gid") == gid, name).otherwise(part)
    return counted.withColumn("part", part).drop("gid")


def part_of(prof: DataFrame, name: str, *cols: str) -> DataFrame:
    return prof.where(F.col("part") == name).select(*cols, "n")


def hour_given_dow(counts: DataFrame) -> DataFrame:
    """Local hour curve blended with the source's weekday or weekend curve, one row per (dow, hour).
    ``counts`` has hour, dow, n."""
    spark = counts.sparkSession
    local = _constant_rows(spark, K.HOUR_WEIGHTS, "hour")
    local = local.withColumn("w", F.col("w") / sum(K.HOUR_WEIGHTS))
    side = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    per = counts.groupBy("hour").agg(side(F.col("dow") < 5).alias("wd"), side(F.col("dow") >= 5).alias("we"))
    wd, we = counts.agg(side(F.col("dow") < 5)).scalar(), counts.agg(side(F.col("dow") >= 5)).scalar()
    mixed = local.join(per, "hour", "left").withColumn("dow", F.explode(F.sequence(F.lit(0), F.lit(6)))).withColumn(
        "p",
        F.when(F.col("dow") >= 5, (1 - K.WEEKEND_BLEND) * F.col("w") + K.WEEKEND_BLEND * F.coalesce(F.col("we") / we, F.lit(0.0)))
        .otherwise((1 - K.WEEKDAY_BLEND) * F.col("w") + K.WEEKDAY_BLEND * F.coalesce(F.col("wd") / wd, F.lit(0.0))),
    )
    return mixed.withColumn("p", F.col("p") / F.sum("p").over(Window.partitionBy("dow"))).select("dow", "hour", "p")


def zone_pairs(df: DataFrame) -> DataFrame:
    return df.groupBy("PULocationID", "DOLocationID").agg(F.count("*").alias("n"))


def zone_volume(pairs: DataFrame) -> DataFrame:
    """Pickups plus drop-offs per source zone, from pair counts."""
    return pairs.select(F.explode(F.array("PULocationID", "DOLocationID")).alias("src_zone_id"), "n").groupBy("src_zone_id").agg(F.sum("n").alias("volume"))


def volume_tiers(pairs: DataFrame) -> DataFrame:
    """Zones ranked by volume and cut into tiers A-E at fixed rank shares. The ranking runs over
    one row per source zone."""
    vol = zone_volume(pairs)
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("volume"), "src_zone_id")
    q = vol.withColumn("q", (F.row_number().over(w) - 1) / (F.count("*").over(Window.partitionBy(F.lit(0))) - 1))
    tier = F.lit("E")
    for name, cut in reversed(K.TIER_CUTS):
        tier = F.when(F.col("q") <= cut, name).otherwise(tier)
    return q.withColumn("tier", tier).drop("q")


def tier_summary(pairs: DataFrame) -> DataFrame:
    return volume_tiers(pairs).groupBy("tier").agg(F.count("*").alias("n_zones"), F.sum("volume").alias("total_volume"))


def tier_od(pairs: DataFrame) -> DataFrame:
    """P(destination tier | origin tier) over all 25 cells, and the origin share."""
    tiers = volume_tiers(pairs).select("src_zone_id", "tier")
    o = tiers.select(F.col("src_zone_id").alias("PULocationID"), F.col("tier").alias("o_tier"))
    d = tiers.select(F.col("src_zone_id").alias("DOLocationID"), F.col("tier").alias("d_tier"))
    counts = pairs.join(o, "PULocationID").join(d, "DOLocationID").groupBy("o_tier", "d_tier").agg(F.sum("n").alias("n"))
    classes = F.array(*[F.lit(c) for c in K.CLASSES])
    spine = pairs.sparkSession.range(1).select(F.explode(classes).alias("o_tier")).select("o_tier", F.explode(classes).alias("d_tier"))
    full = fill_spine(counts, spine, ["o_tier", "d_tier"])
    row = F.sum("n").over(Window.partitionBy("o_tier"))
    return full.withColumns({
        "p": F.when(row > 0, F.col("n") / row).otherwise(0.0),
        "origin_p": row / F.sum("n").over(Window.partitionBy(F.lit(0))),
    })


def zone_bridge(tiers: DataFrame, zones: DataFrame) -> DataFrame:
    """Source zones to all target zones of the same tier, weighted by population."""
    dst = zones.withColumn("weight", F.col("population") / F.sum("population").over(Window.partitionBy("ae_class")))
    return tiers.join(small_side(dst), tiers.tier == dst.ae_class).select("src_zone_id", "tier", "zone_id", "zone_name", "weight")


def origin_weights(zones: DataFrame) -> DataFrame:
    """Population times class multiplier, normalised."""
    mult = F.coalesce(*[F.when(F.col("ae_class") == c, m) for c, m in K.CLASS_MULTIPLIER.items()])
    w = zones.select("zone_id", "zone_name", "ae_class", (F.col("population") * mult).alias("weight"))
    return w.withColumn("p", F.col("weight") / F.sum("weight").over(Window.partitionBy(F.lit(0))))


# --- categorical draws ------------------------------------------------------------------------

def cdf_table(weights: DataFrame, value: str, weight: str, by: list[str] | None = None) -> DataFrame:
    """Cumulative share per value: [cum_lo, cum_p). The last value of a group is open-ended so that
    rounding can never leave a uniform without a row."""
    part = Window.partitionBy(*(by or [F.lit(0)])).orderBy(value)
    total = F.sum(weight).over(Window.partitionBy(*(by or [F.lit(0)])))
    t = weights.where(F.col(weight) > 0).withColumn("cum_p", F.sum(weight).over(part.rowsBetween(Window.unboundedPreceding, 0)) / total)
    lo = F.coalesce(F.lag("cum_p").over(part), F.lit(0.0))
    hi = F.when(F.lead("cum_p").over(part).isNull(), F.lit(2.0)).otherwise(F.col("cum_p"))
    return t.withColumns({"cum_lo": lo, "cum_hi": hi})


def sample_categorical(df: DataFrame, table: DataFrame, value: str, u: Column, out: str, keys: dict[str, str] | None = None, how: str = "inner") -> DataFrame:
    """Add ``out``: the value whose cumulative interval holds ``u``, optionally within the row's
    group (``keys`` maps table columns to row columns). Intervals are listed under every bucket of
    [0, 1) they touch; the join is an equi-join on (group, bucket) with a residual range test. A null
    ``u`` draws nothing: its bucket is -1, so that no null test of the bucket, which would repeat the
    hash, moves below a shuffle of the rows."""
    keys = keys or {}
    first = F.floor(F.col("cum_lo") * BUCKETS)
    last = F.floor(F.least("cum_hi", F.lit(1.0)) * BUCKETS)
    dim = table.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col(value).alias(out), "cum_lo", "cum_hi",
        F.explode(F.sequence(first, last)).alias("_tb"),
    )
    cond = (F.col("_ub") == F.col("_tb")) & (F.col("_u") >= F.col("cum_lo")) & (F.col("_u") < F.col("cum_hi"))
    for k, mine in keys.items():
        cond = cond & (F.col(mine) == F.col(f"_k_{k}"))
    return (
        df.withColumn("_u", u).withColumn("_ub", F.coalesce(F.floor(F.col("_u") * BUCKETS), F.lit(-1)))
        .join(small_side(dim, expand=BUCKETS), cond, how)
        .drop("_u", "_ub", "_tb", "cum_lo", "cum_hi", *[f"_k_{k}" for k in keys])
    )


def _table(spark, pairs, name: str = "value") -> DataFrame:
    """A constant (value, weight) list as a frame."""
    rows = F.array(*[F.struct(F.lit(v).alias(name), F.lit(float(w)).alias("w")) for v, w in pairs])
    return spark.range(1).select(F.inline(rows))


def other_zones(zones: DataFrame, within_class: bool) -> DataFrame:
    """For every zone, the zones it may be swapped for: the members of its class, or of the city,
    other than itself. The zone lists are taken once and exploded."""
    member = F.struct(F.col("zone_id").alias("alt_zone"), F.col("population").cast("double").alias("w"))
    if within_class:
        lists = zones.groupBy("ae_class").agg(F.collect_list(member).alias("others"))
        base = zones.select("ae_class", F.col("zone_id").alias("not_zone")).join(lists, "ae_class")
    else:
        base = zones.select(F.col("zone_id").alias("not_zone")).withColumn("others", zones.agg(F.collect_list(member)).scalar())
    return base.select("not_zone", F.inline("others")).where("not_zone <> alt_zone")


def synth_trips(rows: DataFrame, prof: DataFrame, zones: DataFrame, seed: int = 42, start: str = "2024-03-01", key: str = "trip_key") -> DataFrame:
    """One synthetic trip per input row, drawn from the profile ``prof`` of the source demand.

    ``prof`` is small (see :func:`profile`) and should be materialised; the big side is never
    shuffled."""
    spark = rows.sparkSession
    rid = F.col(key)
    u = lambda stream: draws.uniform(rid, stream, seed)
    hour_dow = part_of(prof, "hour_dow", "hour", "dow")

    dow_n = hour_dow.groupBy("dow").agg(F.sum("n").alias("n"))
    first = F.lit(start).cast("date")
    days = spark.range(K.SYNTH_DAYS).select(F.col("id").cast("int").alias("day_idx")).withColumn("dow", F.weekday(F.date_add(first, F.col("day_idx"))))
    day_w = days.join(dow_n, "dow").select("day_idx", F.col("n").cast("double").alias("w"))
    tiers = tier_od(part_of(prof, "pairs", "PULocationID", "DOLocationID"))
    # an origin tier that never occurs in the source sends its trips by the overall tier shares
    marginal = tiers.groupBy(F.col("o_tier").alias("d_tier")).agg(F.max("origin_p").alias("overall"))
    seen = F.sum("n").over(Window.partitionBy("o_tier")) > 0
    dest_w = tiers.join(F.broadcast(marginal), "d_tier").withColumn("w", F.when(seen, F.col("p")).otherwise(F.col("overall")))
    pool = zones.select("ae_class", F.col("zone_id").alias("dest_zone_id"), F.col("population").cast("double").alias("w"))

    t = spread(rows.select(rid), key)
    t = sample_categorical(t, cdf_table(day_w, "day_idx", "w"), "day_idx", u("day"), "day_idx")
    t = t.withColumn("dow", F.weekday(F.date_add(first, F.col("day_idx"))))
    t = sample_categorical(t, cdf_table(hour_given_dow(hour_dow), "hour", "p", ["dow"]), "hour", u("hour"), "hour", {"dow": "dow"})
    t = sample_categorical(t, cdf_table(origin_weights(zones), "zone_id", "p"), "zone_id", u("origin"), "origin_zone_id")
    own = zones.select(F.col("zone_id").alias("origin_zone_id"), F.col("zone_name").alias("origin_zone_name"), F.col("ae_class").alias("origin_class"), "adjacent_zones")
    t = t.join(small_side(own), "origin_zone_id")
    t = sample_categorical(t, cdf_table(dest_w, "d_tier", "w", ["o_tier"]), "d_tier", u("tier"), "dest_class", {"o_tier": "origin_class"})
    t = sample_categorical(t, cdf_table(pool, "dest_zone_id", "w", ["ae_class"]), "dest_zone_id", u("dest"), "first_dest", {"ae_class": "dest_class"})
    again = (F.col("first_dest") == F.col("origin_zone_id")) & (u("again") < K.SAME_ZONE_RESAMPLE_P)
    alt = cdf_table(other_zones(zones, within_class=True), "alt_zone", "w", ["not_zone"])
    t = t.withColumn("swap", F.when(again, F.col("origin_zone_id")))
    t = sample_categorical(t, alt, "alt_zone", F.when(again, u("alt")), "swapped", {"not_zone": "swap"}, how="left")
    t = t.withColumn("dest_zone_id", F.coalesce("swapped", "first_dest"))
    t = t.join(small_side(zones.select(F.col("zone_id").alias("dest_zone_id"), F.col("zone_name").alias("dest_zone_name"))), "dest_zone_id")
    t = sample_categorical(t, cdf_table(part_of(prof, "distance", "dist_km"), "dist_km", "n"), "dist_km", u("distance"), "distance_km")
    t = sample_categorical(t, cdf_table(part_of(prof, "passengers", "passenger_count"), "passenger_count", "n"), "passenger_count", u("passengers"), "pax")
    t = sample_categorical(t, cdf_table(_table(spark, K.SYNTH_CALLS), "value", "w"), "value", u("call"), "call_type")

    same = F.col("origin_zone_id") == F.col("dest_zone_id")
    near = same | F.array_contains(F.split("adjacent_zones", ","), F.col("dest_zone_id").cast("string"))
    small = u("fleet") < F.when(near, K.SMALL_P_NEAR).otherwise(K.SMALL_P_FAR)
    pax = F.when((F.col("fleet_type") == "grand") & (F.col("pax") < 2), 2).when((F.col("fleet_type") == "petit") & (F.col("pax") > 3), 3).otherwise(F.col("pax"))
    base = F.unix_timestamp(F.date_add(first, F.col("day_idx")).cast("timestamp"))
    at = base + F.col("hour") * 3600 + draws.integer(rid, "minute", seed, 0, 59) * 60 + draws.integer(rid, "second", seed, 0, 59)
    noise = draws.gaussian(rid, "speed", seed, 1.0, K.SYNTH_DURATION_SIGMA)
    t = t.withColumn("fleet_type", F.when(small | same, "petit").otherwise("grand")).withColumn("passenger_count", pax.cast("int"))
    return t.select(
        draws.stable_id(F.lit("synth"), F.lit(str(seed)), rid.cast("string")).alias("trip_id"),
        F.timestamp_seconds(at).alias("request_time"), "hour", "dow", "origin_zone_id", "origin_zone_name", "origin_class",
        "dest_zone_id", "dest_zone_name", "dest_class", "passenger_count", "distance_km",
        F.floor(draws.clip(F.col("distance_km") / K.SYNTH_SPEED_KMH * 3600 * noise, *map(float, K.SYNTH_DURATION_S))).cast("int").alias("duration_s"),
        "fleet_type", "call_type",
        draws.half_up(pricing.two_fleet_fare(F.col("distance_km"), F.col("hour"), F.col("fleet_type"), F.col("passenger_count")), 2).alias("fare_mad"),
        F.lit("pending").alias("status"),
    )


def write_chronological(trips: DataFrame, path: str) -> None:
    """One folder per date; rows are shuffled by (date, ten-minute block) and sorted inside a file, so
    a folder's files hold disjoint sorted blocks that a replay merges by their first row. Nothing is
    sampled: a range partitioning would run the whole generator once more to find its bounds."""
    ts = F.col("request_time")
    keyed = trips.withColumns({"date": F.date_format(ts, "yyyy-MM-dd"), "block": F.floor(F.unix_timestamp(ts) / 600)})
    keyed.repartition("date", "block").sortWithinPartitions("date", "block", "request_time", "trip_id").drop("block").write.partitionBy("date").parquet(path)


def hourly_demand(trips: DataFrame) -> DataFrame:
    return trips.groupBy(
        F.col("origin_zone_id").alias("zone_id"), F.col("origin_zone_name").alias("zone_name"), F.col("origin_class").alias("ae_class"),
        F.to_date("request_time").alias("date"), "hour",
    ).agg(
        F.count("*").alias("trip_count"), F.avg("distance_km").alias("avg_distance_km"), F.avg("fare_mad").alias("avg_fare_mad"),
        F.avg("duration_s").alias("avg_duration_s"), F.avg("passenger_count").alias("avg_passengers"))


def od_matrix(trips: DataFrame) -> DataFrame:
    return trips.groupBy("origin_zone_id", "origin_zone_name", "origin_class", "dest_zone_id", "dest_zone_name", "dest_class", "fleet_type").agg(
        F.count("*").alias("trip_count"), F.avg("distance_km").alias("avg_distance_km"), F.avg("fare_mad").alias("avg_fare_mad"))


def checks(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Eight acceptance checks, one row each (name, measured value, ok)."""
    from fareline.operators.common import percentiles

    per_class = trips.groupBy("origin_class").agg(F.count("*").alias("n")).join(
        zones.groupBy(F.col("ae_class").alias("origin_class")).agg(F.sum("population").alias("pop")), "origin_class")
    rate = lambda c: F.max(F.when(F.col("origin_class") == c, F.col("n") / F.col("pop")))
    ratio = per_class.agg(rate("A") / rate("E")).scalar()
    top = trips.groupBy("hour").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "hour").limit(3)
    peaks = top.agg((F.max(F.col("hour").isin(7, 8, 9).cast("int")) * F.max(F.col("hour").isin(17, 18, 19).cast("int"))).cast("double")).scalar()
    idle = zones.join(trips.select(F.col("origin_zone_id").alias("zone_id")).distinct(), "zone_id", "left_anti").agg(F.count("*").cast("double")).scalar()
    same = trips.where(F.col("origin_class").isin("A", "B")).groupBy("origin_zone_id").agg(
        F.avg((F.col("origin_zone_id") == F.col("dest_zone_id")).cast("int")).alias("s")).agg(F.max("s")).scalar()
    med = percentiles(trips, "fare_mad", [0.5], ["fleet_type"])
    median = lambda f: med.agg(F.max(F.when(F.col("fleet_type") == f, F.col("value")))).scalar()
    one = trips.agg(F.avg((F.col("fleet_type") == "petit").cast("int")).alias("small"), F.min("distance_km").alias("lo"), F.max("distance_km").alias("hi"))
    one = one.withColumns({"ratio": ratio, "peaks": peaks, "idle": idle, "same": same, "m_small": median("petit"), "m_large": median("grand")})
    c = F.col
    rules = [
        ("fleet_share", c("small"), c("small").between(0.65, 0.75)),
        ("per_capita_a_over_e", c("ratio"), c("ratio") >= 3.0),
        ("morning_and_evening_peak", c("peaks"), c("peaks") == 1),
        ("zones_without_outbound", c("idle"), c("idle") == 0),
        ("same_zone_share_ab", c("same"), c("same") <= 0.40),
        ("small_fleet_median_fare", c("m_small"), c("m_small").between(12, 55)),
        ("large_fleet_median_fare", c("m_large"), c("m_large").between(25, 120)),
        ("distance_window", c("hi") - c("lo"), (c("lo") >= K.SYNTH_DIST_KM[0]) & (c("hi") <= K.SYNTH_DIST_KM[1])),
    ]
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), v.cast("double").alias("value"), ok.alias("ok")) for n, v, ok in rules])))


def synth_requests(rows: DataFrame, zones: DataFrame, seed: int = 42, riders: int = 5000, key: str = "event_id") -> DataFrame:
    """Random requests: uniform zones with different ends, uniform points in the zone boxes."""
    spark = rows.sparkSession
    rid = F.col(key)
    u = lambda s: draws.uniform(rid, s, seed)
    even = zones.select("zone_id", F.lit(1.0).alias("w"))
    t = sample_categorical(spread(rows, key), cdf_table(even, "zone_id", "w"), "zone_id", u("origin"), "origin_zone")
    others = other_zones(zones, within_class=False).withColumn("w", F.lit(1.0))
    t = sample_categorical(t, cdf_table(others, "alt_zone", "w", ["not_zone"]), "alt_zone", u("dest"), "destination_zone", {"not_zone": "origin_zone"})
    t = sample_categorical(t, cdf_table(_table(spark, K.STREAM_CALLS), "value", "w"), "value", u("call"), "call_type")
    for end, zcol in (("origin", "origin_zone"), ("dest", "destination_zone")):
        box = zones.select(F.col("zone_id").alias(zcol), *[F.col(c).alias(f"{end}_{c}") for c in ("lat_min", "lat_max", "lon_min", "lon_max")])
        t = t.join(small_side(box), zcol)
        for ax in ("lat", "lon"):
            lo, hi = F.col(f"{end}_{ax}_min"), F.col(f"{end}_{ax}_max")
            t = t.withColumn(f"{end}_{ax}", F.round(lo + u(f"{end}_{ax}") * (hi - lo), 6))
    lat, lon = F.col("origin_lat"), F.col("origin_lon")
    return t.select(
        draws.stable_id(F.lit("req"), F.lit(str(seed)), rid.cast("string")).alias("trip_id"),
        F.format_string("rider_%05d", draws.integer(rid, "rider", seed, 1, riders)).alias("rider_id"),
        "origin_zone", "origin_lat", "origin_lon", geo.grid_cell(lat, lon).alias("origin_cell"),
        "destination_zone", "dest_lat", "dest_lon", geo.grid_cell(F.col("dest_lat"), F.col("dest_lon")).alias("dest_cell"), "call_type")


def synth_pings(trips: DataFrame, routes: DataFrame, step_s: int = K.PING_STEP_S, seed: int = 42) -> DataFrame:
    """Positions along each trip's route. ``trips`` has trip_id, event_time, duration_s, taxi_id,
    route_id; ``routes`` has route_id, points, route_s. A blackout delays the arrival of all later
    positions of a trip but not their event time."""
    tid = F.col("trip_id")
    joined = trips.join(routes, "route_id")
    total = F.greatest(F.col("duration_s"), F.col("route_s"))
    j = joined.withColumn("n", F.greatest(F.lit(2), F.floor(total / step_s).cast("int")))
    j = j.withColumn("dark_at", F.when(draws.uniform(tid, "dark", seed) < K.BLACKOUT_P, 1 + F.floor(draws.uniform(tid, "at", seed) * (F.col("n") - 1)).cast("int")))
    j = j.withColumn("dark_s", draws.integer(tid, "wait", seed, *K.BLACKOUT_S))
    k = F.col("k")
    p = j.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
    m = F.size("points")
    pos = k * (m - 1) / F.greatest(F.col("n") - 1, F.lit(1))
    i0 = F.floor(pos).cast("int")
    a, b, w = F.get("points", i0), F.get("points", F.least(i0 + 1, m - 1)), pos - i0
    row = F.concat_ws(":", tid, k.cast("string"))
    noise = lambda s: draws.gaussian(row, s, seed, 0.0, K.NOISE_SIGMA)
    mix = lambda i: F.get(a, i) * (1 - w) + F.get(b, i) * w
    when = F.unix_micros("event_time") + k.cast("long") * (step_s * 1_000_000)
    late = F.when(k >= F.col("dark_at"), F.col("dark_s").cast("long") * 1_000_000).otherwise(F.lit(0))
    lat, lon = F.round(mix(1) + noise("lat"), 6), F.round(mix(0) + noise("lon"), 6)
    return p.select(
        "taxi_id", "trip_id", k.alias("seq"), F.timestamp_micros(when).alias("event_time"), F.timestamp_micros(when + late).alias("arrival"),
        lat.alias("lat"), lon.alias("lon"),
        F.when(k == 0, "pickup").when(k == F.col("n") - 1, "dropoff").otherwise("moving").alias("status"))


def od_anchor_sample(df: DataFrame, zones: DataFrame, seed: int = 42) -> DataFrame:
    """Class-to-class OD draw for measured trips, endpoints mapped to the target city and pulled
    towards the drawn zones. ``df`` has trip_id and the four source end coordinates."""
    spark = df.sparkSession
    tid = F.col("trip_id")
    u = lambda s: draws.uniform(tid, s, seed)
    pool = zones.select("ae_class", "zone_id", F.col("population").cast("double").alias("w"))
    t = sample_categorical(df, cdf_table(_table(spark, K.CLASS_ORIGIN_P.items()), "value", "w"), "value", u("o_class"), "origin_class")
    dest = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(d).alias("value"), F.lit(p).alias("w")) for o, row in K.CLASS_DEST_P.items() for d, p in row.items()])
    t = sample_categorical(t, cdf_table(spark.range(1).select(F.inline(dest)), "value", "w", ["o"]), "value", u("d_class"), "dest_class", {"o": "origin_class"})
    for end, cls in (("origin", "origin_class"), ("dest", "dest_class")):
        t = sample_categorical(t, cdf_table(pool, "zone_id", "w", ["ae_class"]), "zone_id", u(f"{end}_zone"), f"{end}_zone_id", {"ae_class": cls})
        c = zones.select(F.col("zone_id").alias(f"{end}_zone_id"), F.col("centroid_lat").alias(f"{end}_cy"), F.col("centroid_lon").alias(f"{end}_cx"))
        t = t.join(small_side(c), f"{end}_zone_id")

    def pull(col, src, dst, center, stream):
        a = K.ANCHOR_PULL
        return (1 - a) * geo.affine(F.col(col), src, dst) + a * F.col(center) + draws.gaussian(tid, stream, seed, 0.0, K.ANCHOR_JITTER)

    lat, lon = (K.URBAN_LAT, K.TARGET_LAT), (K.URBAN_LON, K.TARGET_LON)
    return t.select(
        "trip_id", "origin_class", "dest_class", "origin_zone_id", "dest_zone_id",
        pull("orig_lat", *lat, "origin_cy", "sy").alias("start_lat"), pull("orig_lon", *lon, "origin_cx", "sx").alias("start_lon"),
        pull("dest_lat", *lat, "dest_cy", "ey").alias("end_lat"), pull("dest_lon", *lon, "dest_cx", "ex").alias("end_lon"))


def start_sample(rows: DataFrame, zones: DataFrame, weights: DataFrame, outline: Column, center: tuple[float, float], tries: int = 10, sigma: float = 0.003, seed: int = 42) -> DataFrame:
    """Start point near a weighted zone centre: first try inside the outline, else the city centre.
    All tries of a row sit in one partition, so the choice is made before the shuffle."""
    t = spread(rows.select("trip_id"), "trip_id").select("trip_id", F.explode(F.sequence(F.lit(1), F.lit(tries))).alias("attempt"))
    rid = F.concat_ws(":", "trip_id", F.col("attempt").cast("string"))
    t = sample_categorical(t, cdf_table(weights, "zone_id", "w"), "zone_id", draws.uniform(rid, "zone", seed), "zone_id")
    t = t.join(small_side(zones.select("zone_id", "centroid_lat", "centroid_lon")), "zone_id")
    t = t.withColumns({"lat": F.col("centroid_lat") + draws.gaussian(rid, "lat", seed, 0.0, sigma), "lon": F.col("centroid_lon") + draws.gaussian(rid, "lon", seed, 0.0, sigma)})
    hit = F.when(geo.in_ring(F.col("lat"), F.col("lon"), outline), F.struct("attempt", "lat", "lon"))
    best = t.groupBy("trip_id").agg(F.min(hit).alias("h"))
    return best.select("trip_id", F.coalesce("h.attempt", F.lit(0)).alias("attempt"), F.coalesce("h.lat", F.lit(center[0])).alias("lat"), F.coalesce("h.lon", F.lit(center[1])).alias("lon"))


def stamp_sample(rows: DataFrame, start: str, seed: int = 7) -> DataFrame:
    """Timestamp in one week from hour and weekday weights."""
    spark = rows.sparkSession
    tid = F.col("trip_id")
    hours = cdf_table(_table(spark, list(enumerate(K.HOUR_WEIGHTS))), "value", "w")
    dows = cdf_table(_table(spark, list(enumerate(K.DOW_WEIGHTS))), "value", "w")
    t = sample_categorical(rows, hours, "value", draws.uniform(tid, "hour", seed), "hour")
    t = sample_categorical(t, dows, "value", draws.uniform(tid, "dow", seed), "dow")
    at = F.unix_timestamp(F.lit(start).cast("timestamp")) + F.col("dow") * 86400 + F.col("hour") * 3600 + draws.integer(tid, "minute", seed, 0, 59) * 60 + draws.integer(tid, "second", seed, 0, 59)
    return t.withColumn("timestamp", F.timestamp_seconds(at))
