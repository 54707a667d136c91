"""Synthetic demand queries."""

from pyspark.sql import functions as F

from fareline import constants as K
from fareline.functions import draws, geo, paths
from fareline.operators import routes, spatial, synth, trips
from fareline.operators import zonefeatures as zf
from fareline.plans import views
from fareline.plans.ctes import gauss, hav, remap_sql, sql, u32, uni, zone_of  # noqa: F401
from fareline.plans.meter_queries import HOUR_GIVEN_DOW, OD_TIER
from fareline.plans.registry import query, rounded
from fareline.plans.route_queries import ROUTES, S, T, _routes, classed
from fareline.plans.spatial_queries import _aff
from fareline.session import cut_lineage, scratch
from fareline.sources.tables import grid_sql


def cdf_sql(src: str, value: str, w: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    win = f"OVER ({part} ORDER BY {value})"
    keys = f"{by}, " if by else ""
    return (
        f"SELECT {keys}{value}, coalesce(lag(c) {win}, 0) AS lo, CASE WHEN lead(c) {win} IS NULL THEN 2e0 ELSE c END AS hi FROM ("
        f"SELECT {keys}{value}, sum({w}) OVER ({part} ORDER BY {value} ROWS UNBOUNDED PRECEDING)::DOUBLE / (sum({w}) OVER ({part}))::DOUBLE AS c FROM ({src}) WHERE {w} > 0)"
    )


def values(pairs) -> str:
    rows = ", ".join(f"({f"'{v}'" if isinstance(v, str) else v}, {w}e0)" for v, w in pairs)
    return f"SELECT col0 AS value, col1 AS w FROM (VALUES {rows})"


U = lambda s: uni("k", s, 42)
REST = {
    **HOUR_GIVEN_DOW, **OD_TIER,
    "dayw": "SELECT d AS day_idx, n FROM (SELECT unnest(range(0, 90)) AS d) JOIN (SELECT dow, count(*) AS n FROM real GROUP BY 1) ON dow = isodow(DATE '2024-03-01' + CAST(d AS INT)) - 1",
    "ow": "SELECT zone_id, population * CASE ae_class WHEN 'A' THEN 1.8e0 WHEN 'B' THEN 1.3e0 WHEN 'C' THEN 1e0 WHEN 'D' THEN 0.7e0 ELSE 0.5e0 END AS w FROM zones",
    "ow2": "SELECT zone_id, w / sum(w) OVER () AS w FROM ow",
    "dw0": "SELECT a.o_tier, a.d_tier, CASE WHEN sum(a.n) OVER (PARTITION BY a.o_tier) > 0 THEN a.p ELSE m.origin_p END AS w FROM odp a JOIN (SELECT DISTINCT o_tier, origin_p FROM odp) m ON m.o_tier = a.d_tier",
    "alt0": "SELECT a.zone_id AS nz, b.zone_id AS az, b.population AS w FROM zones a JOIN zones b USING (ae_class) WHERE a.zone_id <> b.zone_id",
    "dist0": "SELECT round(greatest(1.5e0, least(18e0, trip_distance * 1.609e0)), 3) AS d, count(*) AS w FROM real GROUP BY 1",
    "pax0": "SELECT passenger_count AS p, count(*) AS w FROM real GROUP BY 1",
    "c_day": cdf_sql("SELECT * FROM dayw", "day_idx", "n"),
    "c_hour": cdf_sql("SELECT * FROM hgd", "hour", "p", "dow"),
    "c_orig": cdf_sql("SELECT * FROM ow2", "zone_id", "w"),
    "c_tier": cdf_sql("SELECT * FROM dw0", "d_tier", "w", "o_tier"),
    "c_dest": cdf_sql("SELECT * FROM zones", "zone_id", "population", "ae_class"),
    "c_alt": cdf_sql("SELECT * FROM alt0", "az", "w", "nz"),
    "c_dist": cdf_sql("SELECT * FROM dist0", "d", "w"),
    "c_pax": cdf_sql("SELECT * FROM pax0", "p", "w"),
    "c_call": cdf_sql(values(K.SYNTH_CALLS), "value", "w"),
    "s1": f"""SELECT o_orderkey AS k, {uni('o_orderkey', 'day', 42)} AS u1, {uni('o_orderkey', 'hour', 42)} AS u2, {uni('o_orderkey', 'origin', 42)} AS u3, {uni('o_orderkey', 'tier', 42)} AS u4, {uni('o_orderkey', 'dest', 42)} AS u5,
        {uni('o_orderkey', 'again', 42)} AS u6, {uni('o_orderkey', 'alt', 42)} AS u7, {uni('o_orderkey', 'distance', 42)} AS u8, {uni('o_orderkey', 'passengers', 42)} AS u9, {uni('o_orderkey', 'call', 42)} AS u10, {uni('o_orderkey', 'fleet', 42)} AS u11 FROM orders""",
    "s2": "SELECT s1.*, day_idx, CAST(isodow(DATE '2024-03-01' + CAST(day_idx AS INT)) - 1 AS INT) AS dow FROM s1 JOIN c_day ON u1 >= lo AND u1 < hi",
    "s3": "SELECT s2.*, h.hour FROM s2 JOIN c_hour h ON h.dow = s2.dow AND u2 >= lo AND u2 < hi",
    "s4": "SELECT s3.*, z.zone_id AS oz, z.zone_name AS oname, z.ae_class AS oc, z.adjacent_zones FROM s3 JOIN c_orig c ON u3 >= lo AND u3 < hi JOIN zones z ON z.zone_id = c.zone_id",
    "s5": "SELECT s4.*, c.d_tier AS dc FROM s4 JOIN c_tier c ON c.o_tier = oc AND u4 >= lo AND u4 < hi",
    "s6": "SELECT s5.*, c.zone_id AS dz1 FROM s5 JOIN c_dest c ON c.ae_class = dc AND u5 >= lo AND u5 < hi",
    "s7": "SELECT s6.*, coalesce(c.az, dz1) AS dz FROM s6 LEFT JOIN c_alt c ON dz1 = oz AND u6 < 0.55e0 AND c.nz = oz AND u7 >= lo AND u7 < hi",
    "s8": "SELECT s7.*, c.d AS km FROM s7 JOIN c_dist c ON u8 >= lo AND u8 < hi",
    "s9": "SELECT s8.*, c.p AS pax FROM s8 JOIN c_pax c ON u9 >= lo AND u9 < hi",
    "s10": "SELECT s9.*, c.value AS call_type FROM s9 JOIN c_call c ON u10 >= lo AND u10 < hi",
    "s11": "SELECT s10.*, CASE WHEN oz = dz OR u11 < CASE WHEN list_contains(string_split(adjacent_zones, ','), CAST(dz AS VARCHAR)) THEN 0.92e0 ELSE 0.58e0 END THEN 'petit' ELSE 'grand' END AS fleet FROM s10",
    "s12": "SELECT *, CAST(CASE WHEN fleet = 'grand' AND pax < 2 THEN 2 WHEN fleet = 'petit' AND pax > 3 THEN 3 ELSE pax END AS INT) AS seats FROM s11",
    "st": f"""SELECT substr(md5(concat('synth-42-', CAST(k AS VARCHAR))), 1, 16) AS trip_id,
        make_timestamp((1709251200 + day_idx * 86400 + s12.hour * 3600 + CAST(floor({U('minute')} * 60) AS BIGINT) * 60 + CAST(floor({U('second')} * 60) AS BIGINT)) * 1000000) AS request_time,
        s12.hour, dow, oz AS origin_zone_id, oname AS origin_zone_name, oc AS origin_class, dz AS dest_zone_id, z.zone_name AS dest_zone_name, dc AS dest_class, seats AS passenger_count, km AS distance_km,
        CAST(floor(greatest(90e0, least(3600e0, km / 22 * 3600 * (1e0 + {gauss('k', 'speed', 42)} * 0.12e0)))) AS INT) AS duration_s, fleet AS fleet_type, call_type,
        floor(CASE WHEN fleet = 'petit' THEN greatest(10e0, 7e0 + CASE WHEN s12.hour >= 21 OR s12.hour < 6 THEN 2.7e0 ELSE 1.8e0 END * km) ELSE greatest(25e0, (8e0 + 1.35e0 * km) * greatest(seats, 2)) END * 100e0 + 0.5e0) / 100e0 AS fare_mad,
        'pending' AS status FROM s12 JOIN zones z ON z.zone_id = dz""",
}
ST = ("real", "tiers", "zones")


def generated(spark, sf):
    prof = cut_lineage(synth.profile(views.realistic(spark, sf)), "profile")
    return synth.synth_trips(views.table(spark, sf, "trips"), prof, views.zones(spark, sf))


@query("synth_trips", sql("SELECT * FROM st", *ST, extra=REST))
def synth_trips(spark, sf):
    return generated(spark, sf)


@query("synth_replay_files", sql("SELECT date_trunc('hour', request_time) AS hour_start, count(*) AS n FROM st GROUP BY 1", *ST, extra=REST))
def synth_replay_files(spark, sf):
    path = scratch(spark, "replay")
    synth.write_chronological(generated(spark, sf).select("trip_id", "request_time", "origin_zone_id"), path)
    back = spark.read.parquet(path)
    return back.groupBy(F.date_trunc("hour", "request_time").alias("hour_start")).agg(F.count("*").alias("n"))


@query("synth_hourly", sql("""SELECT origin_zone_id AS zone_id, origin_zone_name AS zone_name, origin_class AS ae_class, CAST(request_time AS DATE) AS date, hour, count(*) AS trip_count, round(avg(distance_km), 6) AS avg_distance_km,
    round(avg(fare_mad), 6) AS avg_fare_mad, round(avg(duration_s), 6) AS avg_duration_s, round(avg(passenger_count), 6) AS avg_passengers FROM st GROUP BY 1, 2, 3, 4, 5""", *ST, extra=REST))
def synth_hourly(spark, sf):
    return rounded(synth.hourly_demand(generated(spark, sf)))


@query("synth_od", sql("""SELECT origin_zone_id, origin_zone_name, origin_class, dest_zone_id, dest_zone_name, dest_class, fleet_type, count(*) AS trip_count, round(avg(distance_km), 8) AS avg_distance_km, round(avg(fare_mad), 8) AS avg_fare_mad
    FROM st GROUP BY 1, 2, 3, 4, 5, 6, 7""", *ST, extra=REST))
def synth_od(spark, sf):
    return rounded(synth.od_matrix(generated(spark, sf)), 8)


MED = "(SELECT median(fare_mad) FROM st WHERE fleet_type = '{}')"
CHECKS = {
    **REST,
    "pc": "SELECT origin_class, n / pop AS r FROM (SELECT origin_class, count(*)::DOUBLE AS n FROM st GROUP BY 1) JOIN (SELECT ae_class, sum(population) AS pop FROM zones GROUP BY 1) ON ae_class = origin_class",
    "top3": "SELECT hour FROM st GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3",
    "cv": f"""SELECT 'fleet_share' AS check_name, (SELECT avg((fleet_type = 'petit')::INT) FROM st) AS value, 0.65e0 AS a, 0.75e0 AS b
        UNION ALL SELECT 'per_capita_a_over_e', (SELECT r FROM pc WHERE origin_class = 'A') / (SELECT r FROM pc WHERE origin_class = 'E'), 3, 1e18
        UNION ALL SELECT 'morning_and_evening_peak', (SELECT (max((hour IN (7, 8, 9))::INT) * max((hour IN (17, 18, 19))::INT))::DOUBLE FROM top3), 1, 1
        UNION ALL SELECT 'zones_without_outbound', (SELECT count(*)::DOUBLE FROM zones WHERE zone_id NOT IN (SELECT origin_zone_id FROM st)), 0, 0
        UNION ALL SELECT 'same_zone_share_ab', (SELECT max(s) FROM (SELECT avg((origin_zone_id = dest_zone_id)::INT) AS s FROM st WHERE origin_class IN ('A', 'B') GROUP BY origin_zone_id)), -1, 0.4e0
        UNION ALL SELECT 'small_fleet_median_fare', {MED.format('petit')}, 12, 55 UNION ALL SELECT 'large_fleet_median_fare', {MED.format('grand')}, 25, 120
        UNION ALL SELECT 'distance_window', (SELECT max(distance_km) - min(distance_km) FROM st), 0, 16.5e0""",
}


@query("synth_checks", sql("SELECT check_name, round(value, 6) AS value, value BETWEEN a AND b AS ok FROM cv", *ST, extra=CHECKS))
def synth_checks(spark, sf):
    t = cut_lineage(generated(spark, sf), "synth")
    return rounded(synth.checks(t, views.zones(spark, sf)))


@query("sample_categorical", sql("SELECT trip_id, CAST(value AS INT) AS hour FROM trips JOIN c ON u >= lo AND u < hi".replace("FROM trips", f"FROM (SELECT trip_id, {uni('trip_id', 'hour', 42)} AS u FROM trips)"), "trips", extra={
    "c": cdf_sql(values(list(enumerate(K.HOUR_WEIGHTS))), "value", "w")}))
def sample_categorical(spark, sf):
    table = synth.cdf_table(synth._table(spark, list(enumerate(K.HOUR_WEIGHTS))), "value", "w")
    t = views.table(spark, sf, "trips").select("trip_id")
    return synth.sample_categorical(t, table, "value", draws.uniform(F.col("trip_id"), "hour", 42), "hour")


REQ = {
    "c_o": cdf_sql("SELECT zone_id, 1 AS w FROM zones", "zone_id", "w"),
    "c_d": cdf_sql("SELECT a.zone_id AS nz, b.zone_id AS az, 1 AS w FROM zones a JOIN zones b ON a.zone_id <> b.zone_id", "az", "w", "nz"),
    "c_c": cdf_sql(values(K.STREAM_CALLS), "value", "w"),
    "r1": f"SELECT event_id AS k, {uni('event_id', 'origin', 42)} AS u1, {uni('event_id', 'dest', 42)} AS u2, {uni('event_id', 'call', 42)} AS u3 FROM events",
    "r2": "SELECT r1.*, a.zone_id AS oz, c.value AS call_type FROM r1 JOIN c_o a ON u1 >= a.lo AND u1 < a.hi JOIN c_c c ON u3 >= c.lo AND u3 < c.hi",
    "r3": "SELECT r2.*, d.az AS dz FROM r2 JOIN c_d d ON d.nz = oz AND u2 >= lo AND u2 < hi",
    "r4": "SELECT k, call_type, oz, dz, " + ", ".join(
        f"round({z}.{ax}_min + {uni('k', f'{end}_{ax}', 42)} * ({z}.{ax}_max - {z}.{ax}_min), 6) AS {end}_{ax}" for end, z in (("origin", "a"), ("dest", "b")) for ax in ("lat", "lon")) +
        " FROM r3 JOIN zones a ON a.zone_id = oz JOIN zones b ON b.zone_id = dz",
}


@query("synth_requests", sql(f"""SELECT substr(md5(concat('req-42-', CAST(k AS VARCHAR))), 1, 16) AS trip_id, concat('rider_', lpad(CAST(1 + CAST(floor({uni('k', 'rider', 42)} * 5000) AS BIGINT) AS VARCHAR), 5, '0')) AS rider_id,
    oz AS origin_zone, origin_lat, origin_lon, {grid_sql('origin_lat', 'origin_lon')} AS origin_cell, dz AS destination_zone, dest_lat, dest_lon, {grid_sql('dest_lat', 'dest_lon')} AS dest_cell, call_type FROM r4""", "zones", extra=REQ))
def synth_requests(spark, sf):
    return synth.synth_requests(views.table(spark, sf, "feed").select("event_id"), views.zones(spark, sf))


RLAT, RLON = remap_sql("p[2]", K.SOURCE_LAT, K.TARGET_LAT), remap_sql("p[1]", K.SOURCE_LON, K.TARGET_LON)
PINGS = {
    **ROUTES,
    "rts": ROUTES["rts"] + " AND trip_id IN (SELECT TRIP_ID FROM good)",
    "geo": f"SELECT TRIP_ID AS route_id, list_transform(points, lambda p: [{RLON}, {RLAT}]) AS points, (len(points) - 1) * 15 AS route_s FROM good",
    "pk": "SELECT trip_id, num.route_id FROM lev JOIN num USING (kind, key, ordinal)",
    "j": f"""SELECT t.trip_id, t.taxi_id, t.event_time, points, greatest(2, CAST(floor(greatest(t.duration_s, route_s) / 60e0) AS BIGINT)) AS n FROM pk JOIN cur t ON t.trip_id = pk.trip_id JOIN geo ON geo.route_id = pk.route_id""",
    "jj": f"SELECT *, CASE WHEN {uni('trip_id', 'dark', 42)} < 0.05e0 THEN 1 + CAST(floor({uni('trip_id', 'at', 42)} * (n - 1)) AS BIGINT) END AS da, 60 + CAST(floor({uni('trip_id', 'wait', 42)} * 121) AS BIGINT) AS ds FROM j",
    "e": "SELECT *, (k * (len(points) - 1))::DOUBLE / (n - 1) AS pos FROM (SELECT *, unnest(range(0, n)) AS k FROM jj)",
    "f": "SELECT *, CAST(floor(pos) AS BIGINT) + 1 AS i, least(CAST(floor(pos) AS BIGINT) + 2, len(points)) AS i2, pos - floor(pos) AS w, concat(trip_id, ':', k) AS rk FROM e",
}


@query("synth_pings", sql(f"""SELECT taxi_id, trip_id, CAST(k AS INT) AS seq, make_timestamp(epoch_us(event_time) + k * 60000000) AS event_time,
    make_timestamp(epoch_us(event_time) + k * 60000000 + CASE WHEN k >= da THEN ds * 1000000 ELSE 0 END) AS arrival,
    round(points[i][2] * (1 - w) + points[i2][2] * w + {gauss('rk', 'lat', 42)} * 0.0002e0, 6) AS lat, round(points[i][1] * (1 - w) + points[i2][1] * w + {gauss('rk', 'lon', 42)} * 0.0002e0, 6) AS lon,
    CASE WHEN k = 0 THEN 'pickup' WHEN k = n - 1 THEN 'dropoff' ELSE 'moving' END AS status FROM f""", "cur", "good", extra=PINGS))
def synth_pings(spark, sf):
    pts = F.transform("points", lambda p: F.array(geo.remap(F.get(p, 0), K.SOURCE_LON, K.TARGET_LON), geo.remap(F.get(p, 1), K.SOURCE_LAT, K.TARGET_LAT)))
    shapes = views.usable(spark, sf).select(F.col("TRIP_ID").alias("route_id"), pts.alias("points"), ((F.size("points") - 1) * K.POINT_STEP_S).alias("route_s"))
    index = routes.trajectory_index(_routes(spark, sf).join(shapes.select("route_id"), "route_id", "left_semi"))
    asked = classed(spark, sf).where("call_type = 'C'").select("trip_id", "taxi_id", "event_time", "duration_s", "origin_zone", "dest_zone", "origin_class", "dest_class")
    picked = routes.pick_trajectory(asked, index)
    return synth.synth_pings(picked, shapes, step_s=60)


PULL = "0.2e0 * {v} + 0.8e0 * {c} + {g} * 0.0015e0"
ANCHOR = {
    "c_oc": cdf_sql(values(K.CLASS_ORIGIN_P.items()), "value", "w"),
    "c_dc": cdf_sql("SELECT * FROM (VALUES " + ", ".join(f"('{o}', '{d}', {p}e0)" for o, row in K.CLASS_DEST_P.items() for d, p in row.items()) + ") t(o, value, w)", "value", "w", "o"),
    "c_zn": cdf_sql("SELECT * FROM zones", "zone_id", "population", "ae_class"),
    "a0": f"SELECT TRIP_ID AS trip_id, {_aff(S + '[2]', K.URBAN_LAT, K.TARGET_LAT)} AS sy, {_aff(S + '[1]', K.URBAN_LON, K.TARGET_LON)} AS sx, {_aff(T + '[2]', K.URBAN_LAT, K.TARGET_LAT)} AS ey, {_aff(T + '[1]', K.URBAN_LON, K.TARGET_LON)} AS ex FROM good",
    "a1": f"SELECT *, {uni('trip_id', 'o_class', 42)} AS u1, {uni('trip_id', 'd_class', 42)} AS u2, {uni('trip_id', 'origin_zone', 42)} AS u3, {uni('trip_id', 'dest_zone', 42)} AS u4 FROM a0",
    "a2": "SELECT a1.*, c.value AS oc FROM a1 JOIN c_oc c ON u1 >= lo AND u1 < hi",
    "a3": "SELECT a2.*, c.value AS dc FROM a2 JOIN c_dc c ON c.o = oc AND u2 >= lo AND u2 < hi",
    "a4": "SELECT a3.*, z.zone_id AS oz, z.centroid_lat AS oy, z.centroid_lon AS ox FROM a3 JOIN c_zn c ON c.ae_class = oc AND u3 >= lo AND u3 < hi JOIN zones z ON z.zone_id = c.zone_id",
    "a5": "SELECT a4.*, z.zone_id AS dz, z.centroid_lat AS dy, z.centroid_lon AS dx FROM a4 JOIN c_zn c ON c.ae_class = dc AND u4 >= lo AND u4 < hi JOIN zones z ON z.zone_id = c.zone_id",
}


@query("od_anchor_sample", sql("SELECT trip_id, oc AS origin_class, dc AS dest_class, oz AS origin_zone_id, dz AS dest_zone_id, " + ", ".join(
    f"round({PULL.format(v=v, c=c, g=gauss('trip_id', v, 42))}, 6) AS {n}" for v, c, n in (("sy", "oy", "start_lat"), ("sx", "ox", "start_lon"), ("ey", "dy", "end_lat"), ("ex", "dx", "end_lon"))) + " FROM a5", "good", "zones", extra=ANCHOR))
def od_anchor_sample(spark, sf):
    ends = trips.endpoints(views.usable(spark, sf)).select(F.col("TRIP_ID").alias("trip_id"), "orig_lat", "orig_lon", "dest_lat", "dest_lon")
    return rounded(synth.od_anchor_sample(ends, views.zones(spark, sf)))


RING = [(-7.72, 33.503), (-7.666, 33.449), (-7.48, 33.449), (-7.48, 33.68), (-7.72, 33.68), (-7.72, 33.503)]
START = {
    "wz": "SELECT zone_id, pow((lat_max - lat_min) * (lon_max - lon_min), 0.25e0) AS a FROM zones",
    "c_w": cdf_sql("SELECT zone_id, a / sum(a) OVER () AS w FROM wz", "zone_id", "w"),
    "t0": "SELECT trip_id, t AS attempt, concat(trip_id, ':', t) AS rk FROM (SELECT trip_id, unnest(range(1, 11)) AS t FROM trips)",
    "t1": f"SELECT t0.*, z.centroid_lat + {gauss('rk', 'lat', 42)} * 0.003e0 AS lat, z.centroid_lon + {gauss('rk', 'lon', 42)} * 0.003e0 AS lon FROM (SELECT *, {uni('rk', 'zone', 42)} AS u FROM t0) t0 JOIN c_w c ON u >= lo AND u < hi JOIN zones z ON z.zone_id = c.zone_id",
    "ed": "SELECT * FROM (VALUES " + ", ".join(f"({a[0]}e0, {a[1]}e0, {b[0]}e0, {b[1]}e0)" for a, b in zip(RING, RING[1:])) + ") t(x0, y0, x1, y1)",
    "ins": "SELECT rk FROM t1 JOIN ed ON (y0 > lat) <> (y1 > lat) AND lon < (x1 - x0) * (lat - y0) / (y1 - y0) + x0 GROUP BY 1 HAVING count(*) % 2 = 1",
    "bs": "SELECT trip_id, min(attempt) AS attempt, arg_min(lat, attempt) AS lat, arg_min(lon, attempt) AS lon FROM t1 WHERE rk IN (SELECT rk FROM ins) GROUP BY 1",
}


@query("start_sample", sql("SELECT trips.trip_id, CAST(coalesce(attempt, 0) AS INT) AS attempt, round(coalesce(lat, 33.565e0), 6) AS lat, round(coalesce(lon, -7.6e0), 6) AS lon FROM trips LEFT JOIN bs ON bs.trip_id = trips.trip_id", "trips", "zones", extra=START))
def start_sample(spark, sf):
    z = views.zones(spark, sf)
    w = zf.zone_weights(z, z.select("zone_id", F.lit(0).alias("n"))).select("zone_id", F.col("area_w").alias("w"))
    outline = F.array(*[F.array(F.lit(x), F.lit(y)) for x, y in RING])
    return rounded(synth.start_sample(views.table(spark, sf, "trips").select("trip_id"), z, w, outline, (33.565, -7.6)))


STAMP = {
    "c_h": cdf_sql(values(list(enumerate(K.HOUR_WEIGHTS))), "value", "w"),
    "c_w": cdf_sql(values(list(enumerate(K.DOW_WEIGHTS))), "value", "w"),
    "p0": f"SELECT trip_id, {uni('trip_id', 'hour', 7)} AS u1, {uni('trip_id', 'dow', 7)} AS u2, CAST(floor({uni('trip_id', 'minute', 7)} * 60) AS BIGINT) AS mi, CAST(floor({uni('trip_id', 'second', 7)} * 60) AS BIGINT) AS se FROM trips",
}


@query("stamp_sample", sql("""SELECT trip_id, CAST(h.value AS INT) AS hour, CAST(w.value AS INT) AS dow, make_timestamp((1709510400 + w.value * 86400 + h.value * 3600 + mi * 60 + se) * 1000000) AS "timestamp"
    FROM p0 JOIN c_h h ON u1 >= h.lo AND u1 < h.hi JOIN c_w w ON u2 >= w.lo AND u2 < w.hi""", "trips", extra=STAMP))
def stamp_sample(spark, sf):
    return synth.stamp_sample(views.table(spark, sf, "trips").select("trip_id"), "2024-03-04")
