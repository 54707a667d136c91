"""Positions, requests, matching, live views."""

from pyspark.sql import functions as F

from fareline import constants as K
from fareline.functions import pricing, timeparts
from fareline.operators import common, gps, matching, quality, spatial
from fareline.plans import views
from fareline.plans.ctes import hav, sql, u32, zone_of
from fareline.plans.registry import query, rounded
from fareline.session import spread
from fareline.sources import sinks

VALID = """lat BETWEEN 33.45e0 AND 33.68e0 AND lon BETWEEN -7.72e0 AND -7.48e0 AND coalesce(speed_kmh BETWEEN 0 AND 150, TRUE)
    AND coalesce(snap_dist_m <= 333, TRUE) AND cell IS NOT NULL"""
H = u32("taxi_id")
NORM = {
    "mono": """SELECT * FROM (SELECT *, max(event_time) OVER (PARTITION BY taxi_id ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM pings)
        WHERE seen IS NULL OR event_time > seen""",
    "norm": f"""SELECT m.event_id, m.taxi_id, m.event_time, m.arrival, m.speed_kmh, m.status, m.cell, z.zone_id, z.centroid_lat, z.centroid_lon,
        greatest(lat_min, least(lat_max, centroid_lat + (0.0008e0 + ({H} % 1000) / 1000000e0) * cos(radians(({H} % 360)::DOUBLE)))) AS lat,
        greatest(lon_min, least(lon_max, centroid_lon + (0.0008e0 + ({H} % 1000) / 1000000e0) * sin(radians(({H} % 360)::DOUBLE)))) AS lon
        FROM (SELECT * FROM mono WHERE {VALID}) m JOIN cellmap c ON c.cell = m.cell JOIN zones z ON z.zone_id = c.zone_id""",
    "req": f"SELECT r.*, coalesce({zone_of('origin_lat', 'origin_lon')}, 0) AS origin_zone, coalesce({zone_of('dest_lat', 'dest_lon')}, 0) AS dest_zone FROM requests r",
}
NEED = ("pings", "requests", "cellmap", "zones")


def normalized(spark, sf):
    return gps.normalize_pings(views.pings(spark, sf), views.lookup(spark, sf), views.zones(spark, sf))


def asked(spark, sf):
    z = views.zones(spark, sf)
    index = spatial.box_index(z)
    base = spread(views.requests(spark, sf), "event_id")  # each request fans out to zones and time blocks
    r = spatial.assign_box_zone(base, z, "origin_lat", "origin_lon", prefix="o_", index=index)
    r = spatial.assign_box_zone(r, z, "dest_lat", "dest_lon", prefix="d_", index=index)
    return r.select(*base.columns, F.coalesce("o_zone", F.lit(0)).alias("origin_zone"), F.coalesce("d_zone", F.lit(0)).alias("dest_zone"))


@query("gps_dedupe", sql("SELECT event_id, taxi_id FROM mono", *NEED, extra=NORM))
def gps_dedupe(spark, sf):
    return gps.strictly_increasing(views.pings(spark, sf)).select("event_id", "taxi_id")


@query("gps_valid", sql(f"SELECT event_id FROM pings WHERE {VALID}", "pings"))
def gps_valid(spark, sf):
    return gps.valid_pings(views.pings(spark, sf)).select("event_id")


@query("gps_anonymize", sql("SELECT event_id, zone_id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM norm", *NEED, extra={
    **NORM, "mono": f"SELECT * FROM pings WHERE {VALID}"}))
def gps_anonymize(spark, sf):
    a = gps.anonymize(gps.valid_pings(views.pings(spark, sf)), views.lookup(spark, sf), views.zones(spark, sf))
    return rounded(a.select("event_id", "zone_id", "lat", "lon"))


@query("gps_normalize", sql("""SELECT event_id, taxi_id, zone_id, cell, event_time, centroid_lat, centroid_lon, round(lat, 6) AS lat, round(lon, 6) AS lon, speed_kmh, status FROM norm""", *NEED, extra=NORM))
def gps_normalize(spark, sf):
    n = normalized(spark, sf).select("event_id", "taxi_id", "zone_id", "cell", "event_time", "centroid_lat", "centroid_lon", "lat", "lon", "speed_kmh", "status")
    return n.withColumns({"lat": F.round("lat", 6), "lon": F.round("lon", 6)})


DEM = {
    **NORM,
    "feedz": "SELECT zone_id, event_time, taxi_id, 0 AS r FROM norm UNION ALL SELECT origin_zone, event_time, NULL, 1 FROM req WHERE origin_zone <> 0",
    "dw": """SELECT 'casablanca' AS city, zone_id, w AS window_start, w + INTERVAL 30 SECOND AS window_end, count(DISTINCT taxi_id) AS unique_vehicles, CAST(sum(r) AS BIGINT) AS pending_requests,
        sum(r)::DOUBLE / greatest(count(DISTINCT taxi_id), 1) AS ratio FROM (SELECT *, make_timestamp(epoch_us(event_time) // 30000000 * 30000000) AS w FROM feedz) GROUP BY 1, 2, 3, 4""",
}


def demand(spark, sf):
    r = asked(spark, sf).where("origin_zone <> 0").select(F.col("origin_zone").alias("zone_id"), "event_time")
    return gps.demand_window(normalized(spark, sf), r)


@query("demand_window", sql("SELECT city, zone_id, window_start, window_end, unique_vehicles, pending_requests, round(ratio, 6) AS ratio FROM dw", *NEED, extra=DEM))
def demand_window(spark, sf):
    return rounded(demand(spark, sf))


@query("demand_topic", sql("""SELECT city, zone_id, strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') AS window_start, strftime(window_end, '%Y-%m-%dT%H:%M:%SZ') AS window_end, unique_vehicles, pending_requests,
    round(ratio, 3) AS ratio FROM dw""", *NEED, extra=DEM))
def demand_topic(spark, sf):
    return gps.demand_topic(demand(spark, sf))


@query("request_fanout", sql("""SELECT trip_id, origin_zone AS zone_id FROM req WHERE origin_zone <> 0 UNION ALL
    SELECT trip_id, CAST(unnest(string_split(adjacent_zones, ',')) AS INT) FROM req JOIN zones ON zones.zone_id = origin_zone WHERE origin_zone <> 0""", *NEED, extra=NORM))
def request_fanout(spark, sf):
    return matching.fan_out(asked(spark, sf), views.zones(spark, sf)).select("trip_id", "zone_id")


MATCH = {
    **NORM,
    "pool": """SELECT zone_id, taxi_id, t0, least(coalesce(lead(t0) OVER (PARTITION BY zone_id, taxi_id ORDER BY t0), t0 + 60000), t0 + 60000) AS t1, (sp < 5)::INT AS idle FROM (
        SELECT zone_id, taxi_id, epoch_us(event_time) // 1000 AS t0, max(coalesce(speed_kmh, 0)) AS sp FROM norm WHERE status NOT IN ('matched', 'offline') GROUP BY 1, 2, 3)""",
    "fan": """SELECT trip_id, rider_id, event_time, origin_zone, origin_lat, origin_lon, dest_lat, dest_lon, origin_zone AS zone_id FROM req WHERE origin_zone <> 0 UNION ALL
        SELECT trip_id, rider_id, event_time, origin_zone, origin_lat, origin_lon, req.dest_lat, req.dest_lon, CAST(unnest(string_split(adjacent_zones, ',')) AS INT) FROM req JOIN zones ON zones.zone_id = origin_zone""",
    "pairs": f"""SELECT f.trip_id, f.zone_id, p.taxi_id, p.idle, {hav('origin_lat', 'origin_lon', 'centroid_lat', 'centroid_lon')} AS km FROM fan f
        JOIN pool p ON p.zone_id = f.zone_id AND epoch_us(f.event_time) // 1000 >= t0 AND epoch_us(f.event_time) // 1000 < t1 JOIN zones z ON z.zone_id = f.zone_id""",
    "mc": """SELECT f.trip_id, f.zone_id, count(p.taxi_id) AS candidates, arg_min(p.taxi_id, (p.idle, p.taxi_id)) AS taxi_id, min(km) AS pickup_km, min(0.7e0 * km + 0.3e0 * p.idle) AS score,
        CASE WHEN count(p.taxi_id) > 0 THEN 'matched' ELSE 'no_vehicle' END AS status FROM fan f LEFT JOIN pairs p ON p.trip_id = f.trip_id AND p.zone_id = f.zone_id GROUP BY 1, 2""",
    "mb": f"""SELECT q.trip_id, rider_id, origin_zone, b.taxi_id, b.zone_id AS match_zone, b.score, CASE WHEN b.score IS NOT NULL THEN CAST(greatest(60, floor(b.pickup_km / 30 * 3600)) AS INT) END AS eta_seconds,
        CASE WHEN b.score IS NOT NULL THEN round(10 + 3 * greatest(1e0, {hav('origin_lat', 'origin_lon', 'dest_lat', 'dest_lon')}), 2) END AS fare, CASE WHEN b.score IS NOT NULL THEN 'matched' ELSE 'no_vehicle' END AS status
        FROM (SELECT * FROM req WHERE origin_zone <> 0) q LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY score, taxi_id, zone_id) AS rn FROM mc WHERE status = 'matched') WHERE rn = 1) b ON b.trip_id = q.trip_id""",
}


def candidates(spark, sf):
    return matching.match_candidates(asked(spark, sf), normalized(spark, sf), views.zones(spark, sf))


@query("match_candidates", sql("SELECT trip_id, zone_id, candidates, taxi_id, round(pickup_km, 6) AS pickup_km, round(score, 6) AS score, status FROM mc", *NEED, extra=MATCH))
def match_candidates(spark, sf):
    return rounded(candidates(spark, sf).select("trip_id", "zone_id", "candidates", "taxi_id", "pickup_km", "score", "status"))


@query("match_best", sql("SELECT trip_id, rider_id, origin_zone, taxi_id, match_zone, round(score, 6) AS score, eta_seconds, fare, status FROM mb", *NEED, extra=MATCH))
def match_best(spark, sf):
    m = matching.match_best(candidates(spark, sf))
    return m.withColumn("score", F.round("score", 6))


@query("match_rate", sql("""SELECT count(*) AS requests, count(*) FILTER (WHERE status = 'matched') AS matched, count(*) FILTER (WHERE status = 'no_vehicle') AS no_vehicle,
    round(count(*) FILTER (WHERE status = 'matched') / count(*)::DOUBLE * 100, 6) AS matched_pct FROM mb""", *NEED, extra=MATCH))
def match_rate(spark, sf):
    return rounded(quality.match_rate(matching.match_best(candidates(spark, sf))))


@query("match_exclusive")
def match_exclusive(spark, sf):
    return matching.match_exclusive(asked(spark, sf), normalized(spark, sf), views.zones(spark, sf))


@query("tariff", sql("""SELECT trip_id, round(CASE WHEN call_type = 'C' THEN greatest(25e0, (8e0 + 1.35e0 * trip_distance_km) * greatest(trip_key % 6 + 1, 2))
    ELSE greatest(10e0, 7e0 + CASE WHEN hour_of_day >= 21 OR hour_of_day < 6 THEN 2.7e0 ELSE 1.8e0 END * trip_distance_km) END, 5) AS fare_mad FROM cur""", "cur"))
def tariff(spark, sf):
    fleet = F.when(F.col("call_type") == "C", "grand").otherwise("petit")
    fare = pricing.two_fleet_fare(F.col("trip_distance_km"), F.col("hour_of_day"), fleet, F.col("trip_key") % 6 + 1)
    return views.curated(spark, sf).select("trip_id", F.round(fare, 5).alias("fare_mad"))


# --- live views ------------------------------------------------------------------------------

LATEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY event_time DESC, taxi_id, event_id) AS rn FROM norm) WHERE rn <= {n}"


def latest_positions(spark, sf, n):
    return common.latest_n(normalized(spark, sf), ["zone_id"], n, F.desc("event_time"), F.col("taxi_id"), F.col("event_id"))


@query("latest_per_zone", sql("SELECT zone_id, taxi_id, event_time, status, speed_kmh FROM (" + LATEST.format(n=15) + ")", *NEED, extra=NORM))
def latest_per_zone(spark, sf):
    return latest_positions(spark, sf, 15).select("zone_id", "taxi_id", "event_time", "status", "speed_kmh")


@query("panel_vehicles", sql("SELECT zone_id, count(taxi_id) AS vehicles FROM (" + LATEST.format(n=20) + ") GROUP BY 1", *NEED, extra=NORM))
def panel_vehicles(spark, sf):
    return latest_positions(spark, sf, 20).groupBy("zone_id").agg(F.count("taxi_id").alias("vehicles"))


@query("panel_recent", sql("SELECT zone_id, taxi_id, event_time, status FROM (" + LATEST.format(n=5) + ") ORDER BY event_time DESC", *NEED, extra=NORM))
def panel_recent(spark, sf):
    return latest_positions(spark, sf, 5).select("zone_id", "taxi_id", "event_time", "status").orderBy(F.desc("event_time"))


LDEM = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY window_start DESC) AS rn FROM dw) WHERE rn <= {n}"


@query("panel_demand", sql("SELECT zone_id, CAST(sum(unique_vehicles) AS BIGINT) AS active_vehicles, CAST(sum(pending_requests) AS BIGINT) AS pending_requests FROM (" + LDEM.format(n=1) + ") GROUP BY 1", *NEED, extra=DEM))
def panel_demand(spark, sf):
    d = common.latest_n(gps.demand_table(demand(spark, sf)), ["zone_id"], 1, F.desc("window_start"))
    return d.groupBy("zone_id").agg(F.sum("active_vehicles").alias("active_vehicles"), F.sum("pending_requests").alias("pending_requests"))


@query("panel_demand_details", sql("SELECT zone_id, unique_vehicles AS active_vehicles, pending_requests, round(ratio, 6) AS ratio, window_start FROM (" + LDEM.format(n=5) + ")", *NEED, extra=DEM))
def panel_demand_details(spark, sf):
    d = common.latest_n(gps.demand_table(demand(spark, sf)), ["zone_id"], 5, F.desc("window_start"))
    return rounded(d.select("zone_id", "active_vehicles", "pending_requests", "ratio", "window_start").orderBy(F.desc("window_start")))


@query("panel_trips", sql(" UNION ALL ".join(
    f"SELECT * FROM (SELECT trip_id, rider_id, origin_zone, dest_zone, event_time AS created_at FROM cur WHERE trip_date = DATE '2024-01-{d}' ORDER BY event_time DESC, trip_id LIMIT 50)" for d in ("19", "18")), "cur"))
def panel_trips(spark, sf):
    cur = views.curated(spark, sf).select("trip_id", "rider_id", "origin_zone", "dest_zone", F.col("event_time").alias("created_at"), "trip_date")
    days = [cur.where(F.col("trip_date") == F.lit(d).cast("date")).orderBy(F.desc("created_at"), "trip_id").limit(50) for d in ("2024-01-19", "2024-01-18")]
    return common.union_all(days).drop("trip_date")


AS_OF = "2024-01-01 00:30:00"


@query("vehicles_fresh", sql(f"SELECT event_id, taxi_id, zone_id FROM norm WHERE event_time > TIMESTAMP '{AS_OF}' - INTERVAL 30 SECOND AND event_time <= TIMESTAMP '{AS_OF}'", *NEED, extra=NORM))
def vehicles_fresh(spark, sf):
    as_of = F.lit(AS_OF).cast("timestamp")
    return sinks.ttl_view(normalized(spark, sf), "event_time", 30, as_of).where(F.col("event_time") <= as_of).select("event_id", "taxi_id", "zone_id")


@query("ttl_filter", sql("SELECT event_id, taxi_id FROM pings WHERE event_time > (SELECT max(event_time) FROM pings) - INTERVAL 600 SECOND", "pings"))
def ttl_filter(spark, sf):
    p = views.pings(spark, sf)
    return sinks.ttl_view(p, "event_time", 600, p.agg(F.max("event_time")).scalar()).select("event_id", "taxi_id")


@query("sla_metrics", sql(f"""SELECT kind, count(*) AS n_rows, max(event_time) AS newest, quantile_cont(CAST(round((epoch_us(arrival) - epoch_us(event_time)) / 1000) AS BIGINT), 0.95)::DOUBLE AS p95_delay_ms,
    CAST(epoch(TIMESTAMP '2024-01-01 02:00:00') - floor(epoch(max(event_time))) AS BIGINT) AS age_s FROM feed GROUP BY 1""", "feed"))
def sla_metrics(spark, sf):
    return quality.sla_metrics(views.table(spark, sf, "feed"), F.lit("2024-01-01 02:00:00").cast("timestamp"))
