"""Raw trips, polylines and trajectories."""

from pyspark.sql import functions as F

from fareline import constants as K
from fareline.functions import geo, paths, timeparts
from fareline.operators import common, routes, trips
from fareline.plans import views
from fareline.plans.ctes import hav, remap_sql, sql, uni, zone_of
from fareline.plans.registry import query, rounded

S, T = "points[1]", "points[-1]"
LEGS = "list_sum(list_transform(range(1, len({p})), lambda i: " + hav("{p}[i][2]", "{p}[i][1]", "{p}[i+1][2]", "{p}[i+1][1]") + "))"


def length(p="points"):
    return f"coalesce({LEGS.replace('{p}', p)}, 0)"


@query("flt_missing", sql("SELECT TRIP_ID AS trip_id FROM pts1 WHERE complete", "pts1"))
def flt_missing(spark, sf):
    return views.raw_once(spark, sf).where(trips.is_complete(F.col("MISSING_DATA"))).select(F.col("TRIP_ID").alias("trip_id"))


@query("flt_polyline", sql("SELECT TRIP_ID AS trip_id, len(points) AS n_points FROM pts1 WHERE len(points) >= 2", "pts1"))
def flt_polyline(spark, sf):
    df = views.raw_once(spark, sf).withColumn("points", paths.valid_points(F.col("points"))).where(F.size("points") >= 2)
    return df.select(F.col("TRIP_ID").alias("trip_id"), F.size("points").cast("long").alias("n_points"))


@query("flt_metro", sql(f"SELECT TRIP_ID AS trip_id FROM good WHERE {S}[2] BETWEEN 41.10e0 AND 41.25e0 AND {S}[1] BETWEEN -8.72e0 AND -8.55e0 AND {T}[2] BETWEEN 41.10e0 AND 41.25e0 AND {T}[1] BETWEEN -8.72e0 AND -8.55e0", "good"))
def flt_metro(spark, sf):
    e = trips.endpoints(views.usable(spark, sf))
    return e.where(geo.inside(F.col("orig_lat"), F.col("orig_lon"), K.METRO_LAT, K.METRO_LON) & geo.inside(
        F.col("dest_lat"), F.col("dest_lon"), K.METRO_LAT, K.METRO_LON)).select(F.col("TRIP_ID").alias("trip_id"))


@query("polyline_endpoints", sql(f"SELECT TRIP_ID AS trip_id, CAST(len(points) AS INT) AS num_gps_points, {S}[2] AS orig_lat, {S}[1] AS orig_lon, {T}[2] AS dest_lat, {T}[1] AS dest_lon FROM good", "good"))
def polyline_endpoints(spark, sf):
    return trips.endpoints(views.usable(spark, sf)).select(F.col("TRIP_ID").alias("trip_id"), "num_gps_points", "orig_lat", "orig_lon", "dest_lat", "dest_lon")


@query("trips_dedupe", sql("SELECT TRIP_ID AS trip_id, TAXI_ID AS taxi_id, delivery FROM raw_trips WHERE delivery = 1", "raw_trips"))
def trips_dedupe(spark, sf):
    raw = views.table(spark, sf, "raw_trips").select(F.col("TRIP_ID").alias("trip_id"), F.col("TAXI_ID").alias("taxi_id"), "delivery")
    return common.dedupe(raw, "trip_id", F.col("delivery"))


BOX = {"lat": (K.SOURCE_LAT, K.TARGET_LAT), "lon": (K.SOURCE_LON, K.TARGET_LON)}
ETL = {
    "gated": f"""SELECT *, {remap_sql(S + '[2]', *BOX['lat'])} AS oy, {remap_sql(S + '[1]', *BOX['lon'])} AS ox, {remap_sql(T + '[2]', *BOX['lat'])} AS dy, {remap_sql(T + '[1]', *BOX['lon'])} AS dx,
        (len(points) - 1) * 15 AS dur, make_timestamp(epoch * 1000000) AS ts FROM good
        WHERE (len(points) - 1) * 15 BETWEEN 30 AND 10800 AND {S}[2] BETWEEN 41.10e0 AND 41.25e0 AND {S}[1] BETWEEN -8.72e0 AND -8.55e0""",
    "zoned": f"SELECT *, {zone_of('oy', 'ox')} AS oz, {zone_of('dy', 'dx')} AS dz FROM gated",
}


@query("etl_trips", sql("""SELECT TRIP_ID AS trip_id, TAXI_ID AS taxi_id, CALL_TYPE AS call_type, ORIGIN_CALL AS origin_call, ORIGIN_STAND AS origin_stand, epoch AS "timestamp", ts AS event_time,
    strftime(ts, '%Y-%m') AS year_month, DAY_TYPE AS day_type, CAST(len(points) AS INT) AS num_gps_points, CAST(dur AS INT) AS trip_duration_sec,
    round(oy, 8) AS orig_lat, round(ox, 8) AS orig_lon, round(dy, 8) AS dest_lat, round(dx, 8) AS dest_lon, CAST(hour(ts) AS INT) AS hour_of_day, CAST(isodow(ts) - 1 AS INT) AS day_of_week,
    (isodow(ts) >= 6)::INT AS is_weekend, (isodow(ts) = 5)::INT AS is_friday, oz AS origin_zone, dz AS dest_zone, o.zone_name AS origin_zone_name, d.zone_name AS dest_zone_name,
    round(6371e0 * acos(least(1e0, sin(radians(oy)) * sin(radians(dy)) + cos(radians(oy)) * cos(radians(dy)) * cos(radians(dx) - radians(ox)))), 5) AS trip_distance_km
    FROM zoned JOIN zones o ON o.zone_id = oz JOIN zones d ON d.zone_id = dz""", "good", "zones", extra=ETL))
def etl_trips(spark, sf):
    c = trips.curate_trips(views.table(spark, sf, "raw_trips"), views.zones(spark, sf)).drop("src_orig_lat", "src_orig_lon", "src_dest_lat", "src_dest_lon")
    return rounded(c.withColumn("trip_distance_km", F.round("trip_distance_km", 5)), 8)


URBAN = {"u": f"""SELECT *, (len(points) - 1) * 15 AS duration_s, {length()} AS distance_km FROM good WHERE len(points) BETWEEN 4 AND 400
    AND {S}[2] BETWEEN 41.08e0 AND 41.24e0 AND {T}[2] BETWEEN 41.08e0 AND 41.24e0 AND {S}[1] BETWEEN -8.73e0 AND -8.54e0 AND {T}[1] BETWEEN -8.73e0 AND -8.54e0"""}


@query("urban_realism", sql("""SELECT TRIP_ID AS trip_id, CAST(duration_s AS INT) AS duration_s, round(distance_km, 6) AS distance_km, round(distance_km / (duration_s / 3600e0), 6) AS avg_speed_kmh FROM u
    WHERE duration_s BETWEEN 180 AND 1800 AND distance_km BETWEEN 1.5e0 AND 18 AND distance_km / (duration_s / 3600e0) BETWEEN 8 AND 65""", "good", extra=URBAN))
def urban_realism(spark, sf):
    return rounded(trips.urban_gate(views.usable(spark, sf)).select(F.col("TRIP_ID").alias("trip_id"), "duration_s", "distance_km", "avg_speed_kmh"))


@query("polyline_points", sql("SELECT trip_id, CAST(i - 1 AS INT) AS seq, p[2] AS lat, p[1] AS lon FROM (SELECT TRIP_ID AS trip_id, unnest(points) AS p, generate_subscripts(points, 1) AS i FROM good)", "good"))
def polyline_points(spark, sf):
    return routes.polyline_points(_paths(spark, sf))


def _paths(spark, sf):
    return views.usable(spark, sf).select(F.col("TRIP_ID").alias("trip_id"), "points", F.col("TIMESTAMP").cast("long").alias("epoch"))


@query("polyline_length", sql(f"SELECT TRIP_ID AS trip_id, round({length()}, 6) AS km FROM good", "good"))
def polyline_length(spark, sf):
    return rounded(_paths(spark, sf).select("trip_id", paths.path_km(F.col("points")).alias("km")))


PAIR = {"px": "SELECT TRIP_ID AS trip_id, i, points[i][2] AS lat, points[i][1] AS lon, points[i-1][2] AS plat, points[i-1][1] AS plon, len(points) AS n FROM (SELECT *, unnest(range(1, len(points) + 1)) AS i FROM good)"}


@query("ping_speed", sql(f"SELECT trip_id, CAST(i - 1 AS INT) AS seq, CASE WHEN i = 1 THEN 0e0 ELSE round({hav('plat', 'plon', 'lat', 'lon')} / (15 / 3600e0), 1) END AS speed_kmh FROM px", "good", extra=PAIR))
def ping_speed(spark, sf):
    return routes.ping_speed(routes.polyline_points(_paths(spark, sf))).select("trip_id", "seq", "speed_kmh")


@query("ping_status", sql("SELECT trip_id, CAST(i - 1 AS INT) AS seq, CASE WHEN i = 1 THEN 'pickup' WHEN i = n THEN 'dropoff' ELSE 'moving' END AS status FROM px", "good", extra=PAIR))
def ping_status(spark, sf):
    return routes.ping_status(routes.polyline_points(_paths(spark, sf))).select("trip_id", "seq", "status")


@query("fleet_assign", sql("""SELECT trip_id, position, concat('taxi_', lpad(CAST(position % 500 AS VARCHAR), 4, '0')) AS vehicle_id FROM (
    SELECT trip_id, row_number() OVER (ORDER BY event_time, ('0x' || substr(md5(trip_id), 1, 8))::BIGINT, trip_id) - 1 AS position FROM trips)""", "trips"))
def fleet_assign(spark, sf):
    return routes.assign_fleet(views.table(spark, sf, "trips").select("trip_id", "event_time"), 500).select("trip_id", "position", "vehicle_id")


SPIKE = {
    "walk": f"""SELECT TRIP_ID AS trip_id, points, list_reduce(list_transform(points, lambda q: [q]),
        lambda kept, q: CASE WHEN {hav('kept[-1][2]', 'kept[-1][1]', 'q[1][2]', 'q[1][1]')} / (15 / 3600e0) <= 150e0 THEN list_concat(kept, q) ELSE kept END) AS kept FROM good""",
}


@query("traj_despike", sql(f"SELECT trip_id, CAST(len(kept) AS INT) AS n_kept, CAST(len(points) - len(kept) AS INT) AS n_dropped, round({length('kept')}, 6) AS km FROM walk", "good", extra=SPIKE))
def traj_despike(spark, sf):
    p = _paths(spark, sf).withColumn("kept", paths.despike(F.col("points"), K.MAX_SPEED_KMH))
    return rounded(p.select("trip_id", F.size("kept").alias("n_kept"), (F.size("points") - F.size("kept")).alias("n_dropped"), paths.path_km(F.col("kept")).alias("km")))


REPLAY = {
    "walk": f"""SELECT TRIP_ID AS trip_id, points, list_reduce(list_transform(points, lambda q: [q]),
        lambda kept, q: CASE WHEN (kept[-1][1] <> q[1][1] OR kept[-1][2] <> q[1][2]) AND {hav('kept[-1][2]', 'kept[-1][1]', 'q[1][2]', 'q[1][1]')} / (15 / 3600e0) <= 120e0 THEN list_concat(kept, q) ELSE kept END) AS kept FROM good""",
}


@query("traj_despike_replay", sql(f"SELECT trip_id, CAST(len(kept) AS INT) AS n_kept, round({length('kept')}, 6) AS km FROM walk", "good", extra=REPLAY))
def traj_despike_replay(spark, sf):
    """The form used for replays: 120 km/h, and points that repeat the last one are left out."""
    p = _paths(spark, sf).withColumn("kept", paths.despike(F.col("points"), K.REPLAY_MAX_SPEED_KMH, skip_repeats=True))
    return rounded(p.select("trip_id", F.size("kept").alias("n_kept"), paths.path_km(F.col("kept")).alias("km")))


ROUTE = {
    "turns": """SELECT trip_id, count(*) FILTER (WHERE m > 1e-12 AND dot / m < -0.85e0) AS rev FROM (
        SELECT trip_id, dx1 * dx2 + dy1 * dy2 AS dot, sqrt(dx1 * dx1 + dy1 * dy1) * sqrt(dx2 * dx2 + dy2 * dy2) AS m FROM (
          SELECT TRIP_ID AS trip_id, points[i][1] - points[i-1][1] AS dx1, points[i][2] - points[i-1][2] AS dy1, points[i+1][1] - points[i][1] AS dx2, points[i+1][2] - points[i][2] AS dy2
          FROM (SELECT *, unnest(range(2, len(points))) AS i FROM good))) GROUP BY 1""",
    "rt": f"SELECT good.TRIP_ID AS trip_id, len(points) AS n, {length()} AS km, coalesce(rev, 0) AS rev FROM good LEFT JOIN turns ON turns.trip_id = good.TRIP_ID",
}


@query("route_validate", sql("""SELECT trip_id, CASE WHEN n < 3 THEN 'too_few_points' WHEN km < 0.05e0 THEN 'too_short' WHEN km > 20 THEN 'too_long'
    WHEN rev / greatest(n - 2, 1)::DOUBLE > 0.3e0 THEN 'zigzag' ELSE 'ok' END AS verdict FROM rt""", "good", extra=ROUTE))
def route_validate(spark, sf):
    return _paths(spark, sf).select("trip_id", paths.route_verdict(F.col("points"), max_km=20.0).alias("verdict"))


@query("wkt_points", sql("SELECT TRIP_ID AS trip_id, CAST(len(points) AS INT) AS n, round(list_sum(list_transform(points, lambda p: p[1])), 6) AS sum_lon, round(list_sum(list_transform(points, lambda p: p[2])), 6) AS sum_lat FROM good", "good"))
def wkt_points(spark, sf):
    p = _paths(spark, sf).withColumn("wkt", paths.to_linestring(F.col("points"))).select("trip_id", paths.parse_linestring(F.col("wkt")).alias("points"))
    add = lambda i: F.aggregate("points", F.lit(0.0), lambda s, q: s + F.get(q, i))
    return rounded(p.select("trip_id", F.size("points").alias("n"), add(0).alias("sum_lon"), add(1).alias("sum_lat")))


RES = "SELECT trip_id, k, points, (k * (len(points) - 1))::DOUBLE / 9 AS pos FROM (SELECT TRIP_ID AS trip_id, points, unnest(range(0, 10)) AS k FROM good)"


@query("polyline_resample", sql(f"""SELECT trip_id, CAST(k AS INT) AS k, round(points[f][2] * (1 - t) + points[g][2] * t, 7) AS lat, round(points[f][1] * (1 - t) + points[g][1] * t, 7) AS lon FROM (
    SELECT *, CAST(floor(pos) AS BIGINT) + 1 AS f, least(CAST(floor(pos) AS BIGINT) + 2, len(points)) AS g, pos - floor(pos) AS t FROM ({RES}))""", "good"))
def polyline_resample(spark, sf):
    p = _paths(spark, sf).select("trip_id", F.posexplode(paths.resample(F.col("points"), F.lit(10))).alias("k", "p"))
    return rounded(p.select("trip_id", "k", F.get("p", 1).alias("lat"), F.get("p", 0).alias("lon")), 7)


@query("waypoint_subsample", sql("""SELECT trip_id, CAST(k AS INT) AS k, q[2] AS lat, q[1] AS lon FROM (SELECT trip_id, k, points[CAST(floor(k * (len(points) - 1)::DOUBLE / greatest(m - 1, 1)) AS BIGINT) + 1] AS q FROM (
    SELECT TRIP_ID AS trip_id, points, least(6, len(points)) AS m, unnest(range(0, least(6, len(points)))) AS k FROM good))""", "good"))
def waypoint_subsample(spark, sf):
    p = _paths(spark, sf).select("trip_id", F.posexplode(paths.subsample(F.col("points"), 4)).alias("k", "p"))
    return p.select("trip_id", "k", F.get("p", 1).alias("lat"), F.get("p", 0).alias("lon"))


SX = (K.TARGET_LON[1] - K.TARGET_LON[0]) / abs(K.SOURCE_LON[1] - K.SOURCE_LON[0])
SY = (K.TARGET_LAT[1] - K.TARGET_LAT[0]) / (K.SOURCE_LAT[1] - K.SOURCE_LAT[0])
ADAPT = {
    "st": f"""SELECT TRIP_ID AS trip_id, list_prepend([-7.6e0, 33.565e0], list_transform(range(1, len(points)), lambda i: [(points[i+1][1] - points[i][1]) * ({SX!r}::DOUBLE), (points[i+1][2] - points[i][2]) * ({SY!r}::DOUBLE)])) AS s FROM good""",
    "ad": """SELECT trip_id, list_reduce(s, lambda c, d: [CASE WHEN c[1] + d[1] BETWEEN -7.72e0 AND -7.48e0 THEN c[1] + d[1] ELSE c[1] - d[1] END,
        CASE WHEN c[2] + d[2] BETWEEN 33.45e0 AND 33.68e0 THEN c[2] + d[2] ELSE c[2] - d[2] END]) AS e, CAST(len(s) AS INT) AS n FROM st""",
}


@query("traj_adapt", sql("SELECT trip_id, n, round(e[2], 6) AS end_lat, round(e[1], 6) AS end_lon FROM ad", "good", extra=ADAPT))
def traj_adapt(spark, sf):
    a = routes.adapt_path(_paths(spark, sf), F.array(F.lit(-7.6), F.lit(33.565)))
    end = F.try_element_at("adapted", F.lit(-1))
    return rounded(a.select("trip_id", F.size("adapted").alias("n"), F.get(end, 1).alias("end_lat"), F.get(end, 0).alias("end_lon")))


@query("traj_nest", sql("SELECT TRIP_ID AS trip_id, array_to_string(list_transform(points, lambda p: concat(CAST(CAST(round(p[1] * 1000) AS BIGINT) AS VARCHAR), ' ', CAST(CAST(round(p[2] * 1000) AS BIGINT) AS VARCHAR))), ',') AS path FROM good", "good"))
def traj_nest(spark, sf):
    n = routes.nest_points(routes.polyline_points(_paths(spark, sf)))
    milli = lambda p, i: F.round(F.get(p, i) * 1000).cast("long").cast("string")
    return n.select("trip_id", F.array_join(F.transform("points", lambda p: F.concat_ws(" ", milli(p, 0), milli(p, 1))), ",").alias("path"))


ROUTES = {
    "rts": """SELECT trip_id AS route_id, origin_zone, dest_zone, zo.ae_class AS origin_class, zd.ae_class AS dest_class FROM cur
        JOIN zones zo ON zo.zone_id = origin_zone JOIN zones zd ON zd.zone_id = dest_zone WHERE call_type <> 'C'""",
    "idx": """SELECT 'zone' AS kind, concat(origin_zone, '-', dest_zone) AS key, route_id FROM rts UNION ALL SELECT 'class', concat(origin_class, '-', dest_class), route_id FROM rts
        UNION ALL SELECT 'any', '*', route_id FROM rts""",
    "num": "SELECT *, row_number() OVER (PARTITION BY kind, key ORDER BY ('0x' || substr(md5(route_id), 1, 8))::BIGINT, route_id) - 1 AS ordinal, count(*) OVER (PARTITION BY kind, key) AS size FROM idx",
    "sz": "SELECT kind, key, max(size) AS size FROM num GROUP BY 1, 2",
    "asked": """SELECT trip_id, concat(origin_zone, '-', dest_zone) AS zk, concat(zo.ae_class, '-', zd.ae_class) AS ck FROM cur0
        JOIN zones zo ON zo.zone_id = origin_zone JOIN zones zd ON zd.zone_id = dest_zone WHERE call_type = 'C'""",
    "lev": f"""SELECT a.trip_id, CASE WHEN z.size IS NOT NULL THEN 'zone' WHEN c.size IS NOT NULL THEN 'class' ELSE 'any' END AS kind,
        CASE WHEN z.size IS NOT NULL THEN zk WHEN c.size IS NOT NULL THEN ck ELSE '*' END AS key,
        CAST(floor({uni('a.trip_id', 'route', 42)} * coalesce(z.size, c.size, (SELECT size FROM sz WHERE kind = 'any'))) AS BIGINT) AS ordinal
        FROM asked a LEFT JOIN sz z ON z.kind = 'zone' AND z.key = zk LEFT JOIN sz c ON c.kind = 'class' AND c.key = ck""",
}


def classed(spark, sf):
    z = views.zones(spark, sf)
    df = views.curated(spark, sf)
    for end in ("origin", "dest"):
        df = common.enrich(df, z.select(F.col("zone_id").alias(f"{end}_zone"), F.col("ae_class").alias(f"{end}_class")), f"{end}_zone")
    return df


def _routes(spark, sf):
    return classed(spark, sf).where("call_type <> 'C'").select(F.col("trip_id").alias("route_id"), "event_time", "origin_zone", "dest_zone", "origin_class", "dest_class")


@query("trajectory_index", sql("SELECT kind, key, route_id, ordinal FROM num", "cur", extra=ROUTES))
def trajectory_index(spark, sf):
    numbered, _ = routes.with_ordinals(routes.trajectory_index(_routes(spark, sf)))
    return numbered.select("kind", "key", "route_id", "ordinal")


@query("trajectory_pick", sql("SELECT trip_id, kind, num.route_id FROM lev JOIN num USING (kind, key, ordinal)", "cur", extra=ROUTES))
def trajectory_pick(spark, sf):
    asked = classed(spark, sf).where("call_type = 'C'").select("trip_id", "origin_zone", "dest_zone", "origin_class", "dest_class")
    return routes.pick_trajectory(asked, routes.trajectory_index(_routes(spark, sf))).select("trip_id", "kind", "route_id")


@query("late_injection", sql(f"SELECT trip_id, event_time, make_timestamp(epoch_us(event_time) + CASE WHEN {uni('trip_id', 'late', 42)} < 0.05e0 THEN (60 + CAST(floor({uni('trip_id', 'wait', 42)} * 121) AS BIGINT)) * 1000000 ELSE 0 END) AS arrival FROM trips", "trips"))
def late_injection(spark, sf):
    return routes.late_arrival(views.table(spark, sf, "trips").select("trip_id", "event_time"), "trip_id", "event_time", 42)


@query("time_rebase", sql("""SELECT trip_id, make_timestamp(1767225600000000 + CAST(floor((epoch_us(event_time) - (SELECT min(epoch_us(event_time)) FROM trips)) / 50e0) AS BIGINT)) AS wall_time FROM trips""", "trips"))
def time_rebase(spark, sf):
    t = views.table(spark, sf, "trips").select("trip_id", "event_time")
    t0 = t.agg(F.min("event_time")).scalar()
    return t.select("trip_id", timeparts.rebase(F.col("event_time"), t0, F.lit("2026-01-01 00:00:00").cast("timestamp"), 50.0).alias("wall_time"))


@query("demand_multiplier", sql("SELECT trip_id, round(([" + ", ".join(f"{x}e0" for x in K.RATE_MULTIPLIER) + "])[hour(event_time) + 1] * CASE WHEN isodow(event_time) = 5 AND hour(event_time) BETWEEN 12 AND 13 THEN 0.6e0 ELSE 1e0 END, 6) AS mult FROM trips", "trips"))
def demand_multiplier(spark, sf):
    return rounded(views.table(spark, sf, "trips").select("trip_id", timeparts.demand_multiplier(F.col("event_time")).alias("mult")))


@query("heuristic_forecast", sql("SELECT trip_id, round(([" + ", ".join(f"{x}e0" for x in K.HEURISTIC_BASE) + """])[hour_of_day + 1] * CASE WHEN is_weekend = 1 THEN 0.85e0 ELSE 1e0 END
    * CASE WHEN origin_zone IN (8, 9, 14) THEN 1.3e0 WHEN origin_zone IN (1, 3, 16) THEN 0.7e0 ELSE 1e0 END, 1) AS forecast FROM cur""", "cur"))
def heuristic_forecast(spark, sf):
    return views.curated(spark, sf).select("trip_id", timeparts.heuristic_demand(F.col("origin_zone"), F.col("event_time")).alias("forecast"))
