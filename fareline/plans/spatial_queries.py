"""Spatial joins, zone features and balance metrics."""

from pyspark.sql import functions as F

from fareline import constants as K
from fareline.functions import draws, geo, tags
from fareline.operators import common, quality, spatial, synth
from fareline.operators import zonefeatures as zf
from fareline.plans import views
from fareline.plans.ctes import HAV, gauss, hav, remap_sql, sql, zone_of
from fareline.plans.registry import query, rounded
from fareline.sources.tables import grid_sql

RINGS = ("[[lon_min, lat_min], [lon_max, lat_min + 0.004e0], [lon_max - 0.004e0, lat_max],"
         " [lon_min + 0.004e0, lat_max - 0.004e0], [lon_min, lat_min]]")
POLY = {
    "polys": f"SELECT *, {RINGS} AS ring FROM zones",
    "edges": "SELECT zone_id, zone_name, population, ring, i, ring[i][1] AS x0, ring[i][2] AS y0, ring[i+1][1] AS x1, ring[i+1][2] AS y1 FROM (SELECT *, unnest(range(1, 5)) AS i FROM polys)",
    "areas": """SELECT zone_id, any_value(zone_name) AS zone_name, any_value(population) AS population, abs(sum(x0 * y1 - x1 * y0)) / 2 AS area_deg2,
        sum((y0 + y1) * (x0 * y1 - x1 * y0)) / (3 * sum(x0 * y1 - x1 * y0)) AS cy, sum((x0 + x1) * (x0 * y1 - x1 * y0)) / (3 * sum(x0 * y1 - x1 * y0)) AS cx,
        min(y0) AS lat_min, max(y0) AS lat_max, min(x0) AS lon_min, max(x0) AS lon_max FROM edges GROUP BY 1""",
}
KM2 = "12321.0e0 * cos(radians(33.57e0))"


def pip(points: str, key: str) -> str:
    """Points within a zone outline, by edge parity."""
    return f"""SELECT p.{key}, e.zone_id FROM {points} p JOIN edges e ON (e.y0 > p.lat) <> (e.y1 > p.lat)
        AND p.lon < (e.x1 - e.x0) * (p.lat - e.y0) / (e.y1 - e.y0) + e.x0 GROUP BY 1, 2 HAVING count(*) % 2 = 1"""


def polygons(spark, sf):
    return zf.zone_polygons(views.zones(spark, sf))


@query("dim_zones", sql("SELECT zone_id, zone_name, lat_min, lat_max, lon_min, lon_max, centroid_lat, centroid_lon FROM zones", "zones"))
def dim_zones(spark, sf):
    return views.zones(spark, sf).select("zone_id", "zone_name", "lat_min", "lat_max", "lon_min", "lon_max", "centroid_lat", "centroid_lon")


@query("zone_join_all", sql("""SELECT trip_id, o.zone_id AS origin_zone, d.zone_id AS dest_zone FROM trips
    LEFT JOIN zones o ON o_lat BETWEEN o.lat_min AND o.lat_max AND o_lon BETWEEN o.lon_min AND o.lon_max
    LEFT JOIN zones d ON d_lat BETWEEN d.lat_min AND d.lat_max AND d_lon BETWEEN d.lon_min AND d.lon_max""", "trips", "zones"))
def zone_join_all(spark, sf):
    z = views.zones(spark, sf)
    t = spatial.assign_box_zone(views.table(spark, sf, "trips"), z, "o_lat", "o_lon", "all", "origin_")
    return spatial.assign_box_zone(t, z, "d_lat", "d_lon", "all", "dest_").select("trip_id", "origin_zone", "dest_zone")


@query("zone_join_first", sql(f"SELECT trip_id, {zone_of('o_lat', 'o_lon')} AS zone FROM trips", "trips", "zones"))
def zone_join_first(spark, sf):
    return spatial.assign_box_zone(views.table(spark, sf, "trips"), views.zones(spark, sf), "o_lat", "o_lon").select("trip_id", "zone")


@query("zone_join_last", sql(f"SELECT trip_id, {zone_of('o_lat', 'o_lon', 'max')} AS zone FROM trips", "trips", "zones"))
def zone_join_last(spark, sf):
    return spatial.assign_box_zone(views.table(spark, sf, "trips"), views.zones(spark, sf), "o_lat", "o_lon", "last").select("trip_id", "zone")


NEAR = "(SELECT arg_min(z.zone_id, {d} * 1e9 + z.zone_id * 1e-6) FROM zones z)"
DEG2 = "(pow(o_lat - z.centroid_lat, 2) + pow(o_lon - z.centroid_lon, 2))"


@query("zone_join_fallback", sql(f"""SELECT trip_id, coalesce({zone_of('o_lat', 'o_lon')}, {NEAR.format(d=DEG2)}) AS zone,
    coalesce({zone_of('o_lat', 'o_lon')}, {NEAR.format(d=HAV.format(a='o_lat', b='z.centroid_lat', c='o_lon', d='z.centroid_lon'))}) AS zone_hav FROM trips""", "trips", "zones"))
def zone_join_fallback(spark, sf):
    z = views.zones(spark, sf)
    t = spatial.assign_box_zone(views.table(spark, sf, "trips"), z, "o_lat", "o_lon", fallback="degrees")
    t = t.select("trip_id", "o_lat", "o_lon", "zone")
    t = spatial.assign_box_zone(t, z, "o_lat", "o_lon", prefix="h_", fallback="haversine")
    return t.select("trip_id", "zone", F.col("h_zone").alias("zone_hav"))


@query("dim_cells_built", sql("SELECT cell, zone_id, zone_name FROM cellmap", "cellmap"))
def dim_cells_built(spark, sf):
    return views.lookup(spark, sf)


@query("grid_cell", sql(f"""SELECT trip_id, {grid_sql('o_lat', 'o_lon')} AS cell,
    ({grid_sql('o_lat', 'o_lon')}) // 1000000 // 4 * 1000000 + ({grid_sql('o_lat', 'o_lon')}) % 1000000 // 4 AS parent FROM trips""", "trips"))
def grid_cell(spark, sf):
    cell = geo.grid_cell(F.col("o_lat"), F.col("o_lon"))
    return views.table(spark, sf, "trips").select("trip_id", cell.alias("cell"), geo.parent_cell(cell, 4).alias("parent"))


@query("cell_join", sql("SELECT event_id, p.cell, c.zone_id, c.zone_name FROM pings p JOIN cellmap c ON c.cell = p.cell", "pings", "cellmap"))
def cell_join(spark, sf):
    return spatial.assign_cell_zone(views.pings(spark, sf), views.lookup(spark, sf), how="inner").select("event_id", "cell", "zone_id", "zone_name")


RING_SQL = {
    "grown": """SELECT cell, min(k) AS k, arg_min(zone_id, k * 1000 + zone_id) AS zone_id FROM (
        SELECT m.cell + r.r * 1000000 + c.c AS cell, greatest(abs(r.r), abs(c.c)) AS k, m.zone_id FROM cellmap m
        CROSS JOIN (SELECT unnest(range(-5, 6)) AS r) r CROSS JOIN (SELECT unnest(range(-5, 6)) AS c) c) GROUP BY 1""",
}


@query("cell_join_ring", sql("SELECT event_id, coalesce(g.zone_id, 0) AS zone_id FROM pings p LEFT JOIN grown g ON g.cell = p.cell", "pings", "cellmap", extra=RING_SQL))
def cell_join_ring(spark, sf):
    return spatial.assign_cell_zone(views.pings(spark, sf), views.lookup(spark, sf), max_rings=5).select("event_id", "zone_id")


@query("zone_method_agreement", sql(f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE a > 0 AND b > 0) AS both_known, count(*) FILTER (WHERE a > 0 AND a = b) AS same,
    round(count(*) FILTER (WHERE a > 0 AND a = b) / greatest(count(*) FILTER (WHERE a > 0 AND b > 0), 1)::DOUBLE * 100, 6) AS agree_pct
    FROM (SELECT {zone_of('lat', 'lon')} AS a, c.zone_id AS b FROM feed f LEFT JOIN cellmap c ON c.cell = f.cell)""", "feed", "zones", "cellmap"))
def zone_method_agreement(spark, sf):
    z = views.zones(spark, sf)
    df = spatial.assign_box_zone(views.table(spark, sf, "feed"), z, "lat", "lon", prefix="box_")
    df = spatial.assign_cell_zone(df, views.lookup(spark, sf))
    return rounded(common.agreement(df, "box_zone", "zone_id"))


@query("zone_enrich", sql("SELECT trip_id, origin_zone, ae_class, population FROM cur JOIN zones ON zone_id = origin_zone", "cur"))
def zone_enrich(spark, sf):
    dim = views.zones(spark, sf).select(F.col("zone_id").alias("origin_zone"), "ae_class", "population")
    return common.enrich(views.curated(spark, sf).select("trip_id", "origin_zone"), dim, "origin_zone", require=True)


@query("pip_join", sql("SELECT site_id, zone_id FROM (" + pip("commerce", "site_id") + ")", "commerce", "zones", extra=POLY))
def pip_join(spark, sf):
    return spatial.point_in_polygon(views.table(spark, sf, "commerce"), polygons(spark, sf), "lat", "lon").select("site_id", "zone_id")


SNAP = {
    "cand": f"""SELECT trip_id, node_id, node_lat, node_lon, sqrt(pow(o_lat - node_lat, 2) + pow(o_lon - node_lon, 2)) AS d FROM
        (SELECT trip_id, o_lat, o_lon, {grid_sql('o_lat', 'o_lon', '0.003e0')} AS c FROM trips) t
        JOIN (SELECT *, {grid_sql('node_lat', 'node_lon', '0.003e0')} + r * 1000000 + k AS c FROM nodes, (SELECT unnest(range(-1, 2)) AS r), (SELECT unnest(range(-1, 2)) AS k)) n USING (c)""",
    "best": "SELECT trip_id, arg_min(node_id, (d, node_id)) AS node_id, min(d) * 111000e0 AS snap_m FROM cand WHERE d <= 0.003e0 GROUP BY 1",
}


@query("snap_nearest", sql("SELECT trip_id, node_id, round(snap_m, 4) AS snap_m FROM trips LEFT JOIN best USING (trip_id)", "trips", "nodes", extra=SNAP))
def snap_nearest(spark, sf):
    out = spatial.snap_nearest(views.table(spark, sf, "trips").select("trip_id", "o_lat", "o_lon"), views.table(spark, sf, "nodes"), "o_lat", "o_lon", K.SNAP_LIMIT_DEG)
    return rounded(out.select("trip_id", "node_id", "snap_m"), 4)


@query("zone_overlap", sql(f"""SELECT a.zone_id AS zone_a, b.zone_id AS zone_b,
    round((least(a.lat_max, b.lat_max) - greatest(a.lat_min, b.lat_min)) * (least(a.lon_max, b.lon_max) - greatest(a.lon_min, b.lon_min)) * {KM2}, 6) AS overlap_km2
    FROM zones a JOIN zones b ON a.zone_id < b.zone_id AND a.lat_min < b.lat_max AND b.lat_min < a.lat_max AND a.lon_min < b.lon_max AND b.lon_min < a.lon_max""", "zones"))
def zone_overlap(spark, sf):
    return rounded(spatial.zone_overlap(views.zones(spark, sf)))


@query("zone_adjacency", sql("""SELECT DISTINCT a.zone_id AS zone_a, b.zone_id AS zone_b FROM cellmap a, (SELECT unnest(range(-1, 2)) AS r), (SELECT unnest(range(-1, 2)) AS c), cellmap b
    WHERE b.cell = a.cell + r * 1000000 + c AND a.zone_id <> b.zone_id""", "cellmap"))
def zone_adjacency(spark, sf):
    return spatial.zone_adjacency(views.lookup(spark, sf))


@query("cell_claim", sql("""SELECT cell, arg_min(zone_id, (zone_id % 3) * 1000 + zone_id) AS zone_id, min(zone_id % 3) AS priority FROM cellmap0 GROUP BY 1""", "cellmap0"))
def cell_claim(spark, sf):
    cells = spatial.zone_cells(views.zones(spark, sf)).select("cell", "zone_id", (F.col("zone_id") % 3).alias("priority"))
    return spatial.claim_cells(cells)


@query("nearest_territory", sql("""SELECT cell, arg_min(zone_id, d * 1e9 + zone_id * 1e-6) AS zone_id FROM (
      SELECT g.cell, z.zone_id, pow(cell_lat - centroid_lat, 2) + pow(cell_lon - centroid_lon, 2) AS d FROM (
        SELECT r * 1000000 + c AS cell, (r + 0.5e0) * 0.005e0 - 90e0 AS cell_lat, (c + 0.5e0) * 0.005e0 - 180e0 AS cell_lon FROM
          (SELECT unnest(range(CAST(floor((min(lat_min) + 90e0) / 0.005e0) AS BIGINT), CAST(floor((max(lat_max) + 90e0) / 0.005e0) AS BIGINT) + 1)) AS r FROM zones),
          (SELECT unnest(range(CAST(floor((min(lon_min) + 180e0) / 0.005e0) AS BIGINT), CAST(floor((max(lon_max) + 180e0) / 0.005e0) AS BIGINT) + 1)) AS c FROM zones)) g
      CROSS JOIN zones z WHERE g.cell NOT IN (SELECT cell FROM cellmap)) GROUP BY 1""", "zones", "cellmap"))
def nearest_territory(spark, sf):
    z = views.zones(spark, sf)
    return spatial.nearest_territory(spatial.box_cells(z), z, views.lookup(spark, sf)).select("cell", "zone_id")


@query("land_filter", sql("SELECT trip_id FROM trips WHERE o_lon > CASE WHEN o_lat <= 33.48e0 THEN -7.715e0 " + " ".join(
    f"WHEN o_lat <= {b[0]}e0 THEN {a[1]}e0 + (o_lat - {a[0]}e0) * ({(b[1] - a[1]) / (b[0] - a[0])!r}::DOUBLE)" for a, b in zip(K.COAST, K.COAST[1:])) + f" ELSE {K.COAST[-1][1]}e0 END", "trips"))
def land_filter(spark, sf):
    return views.table(spark, sf, "trips").where(geo.is_on_land(F.col("o_lat"), F.col("o_lon"))).select("trip_id")


@query("polygon_area", sql("SELECT zone_id, round(area_deg2, 9) AS area_deg2 FROM areas WHERE area_deg2 BETWEEN 0.0001e0 AND 0.0023e0", "zones", extra=POLY))
def polygon_area(spark, sf):
    return rounded(zf.area_gate(polygons(spark, sf), (0.0001, 0.0023)).select("zone_id", "area_deg2"), 9)


@query("polygon_summary", sql(f"""SELECT zone_id, round(area_deg2 * {KM2}, 6) AS area_km2, round(cy, 6) AS centroid_lat, round(cx, 6) AS centroid_lon,
    round(lat_min, 6) AS lat_min, round(lat_max, 6) AS lat_max, round(lon_min, 6) AS lon_min, round(lon_max, 6) AS lon_max, 5::INT AS n_vertices FROM areas""", "zones", extra=POLY))
def polygon_summary(spark, sf):
    return rounded(zf.polygon_summary(polygons(spark, sf)))


ZF = {
    **POLY,
    "chit": "SELECT c.*, h.zone_id FROM commerce c JOIN (" + pip("commerce", "site_id") + ") h USING (site_id)",
    "csum": """SELECT zone_id, CAST(sum(commerce_count) AS BIGINT) AS commerce_count_sum, sum(commerce_weight) AS commerce_weight_sum, avg(opportunity) AS opportunity_mean, count(*) AS cell_count FROM chit GROUP BY 1""",
    "cdiv": "SELECT zone_id, count(DISTINCT t) AS poi_diversity FROM (SELECT zone_id, unnest(string_split(commerce_types, '|')) AS t FROM chit) WHERE t <> '' GROUP BY 1",
    "thit": "SELECT zone_id, count(*) AS transit_hub_count FROM (" + pip("(SELECT * FROM stops WHERE mode IN ('tram_stop', 'brt_stop'))", "stop_id") + ") GROUP BY 1",
    "zfeat": f"""SELECT a.zone_id, a.zone_name, a.population, area_deg2 * {KM2} AS area_km2, a.population / (area_deg2 * {KM2}) AS pop_density,
        coalesce(commerce_count_sum, 0) AS commerce_count_sum, coalesce(commerce_weight_sum, 0) AS commerce_weight_sum, coalesce(opportunity_mean, 0) AS opportunity_mean,
        coalesce(cell_count, 0) AS cell_count, coalesce(poi_diversity, 0) AS poi_diversity, coalesce(transit_hub_count, 0) AS transit_hub_count
        FROM areas a LEFT JOIN csum USING (zone_id) LEFT JOIN cdiv USING (zone_id) LEFT JOIN thit USING (zone_id)""",
    "scores": """SELECT zone_id, zone_name, commerce_n, density_n, diversity_n, transit_n, round(0.3e0 * commerce_n + 0.4e0 * density_n + 0.2e0 * diversity_n + 0.1e0 * transit_n, 4) AS ae_score FROM (
        SELECT zone_id, zone_name, """ + ", ".join(
        f"CASE WHEN max({c}) OVER () > min({c}) OVER () THEN ({c} - min({c}) OVER ())::DOUBLE / (max({c}) OVER () - min({c}) OVER ())::DOUBLE ELSE 0.5e0 END AS {n}_n"
        for c, n in (("commerce_weight_sum", "commerce"), ("pop_density", "density"), ("poi_diversity", "diversity"), ("transit_hub_count", "transit"))) + " FROM zfeat)",
}
ZT = ("zones", "commerce", "stops")


def _features(spark, sf):
    p = polygons(spark, sf)
    return zf.zone_features(p, zf.zone_commerce(views.table(spark, sf, "commerce"), p), zf.zone_transit(views.table(spark, sf, "stops"), p))


@query("zone_area", sql("SELECT zone_id, zone_name, population, round(area_km2, 6) AS area_km2, round(pop_density, 4) AS pop_density FROM zfeat", *ZT, extra=ZF))
def zone_area(spark, sf):
    a = zf.zone_area(polygons(spark, sf))
    return a.withColumns({"area_km2": F.round("area_km2", 6), "pop_density": F.round("pop_density", 4)})


@query("zone_commerce", sql("""SELECT zone_id, commerce_count_sum, round(commerce_weight_sum, 4) AS commerce_weight_sum, round(opportunity_mean, 8) AS opportunity_mean,
    cell_count, poi_diversity FROM csum JOIN cdiv USING (zone_id)""", *ZT, extra=ZF))
def zone_commerce(spark, sf):
    c = zf.zone_commerce(views.table(spark, sf, "commerce"), polygons(spark, sf))
    return c.withColumns({"commerce_weight_sum": F.round("commerce_weight_sum", 4), "opportunity_mean": F.round("opportunity_mean", 8)})


@query("zone_transit", sql("SELECT zone_id, transit_hub_count FROM thit", *ZT, extra=ZF))
def zone_transit(spark, sf):
    return zf.zone_transit(views.table(spark, sf, "stops"), polygons(spark, sf))


@query("zone_features", sql("""SELECT zone_id, zone_name, population, round(area_km2, 4) AS area_km2, round(pop_density, 4) AS pop_density, commerce_count_sum,
    round(commerce_weight_sum, 4) AS commerce_weight_sum, round(opportunity_mean, 8) AS opportunity_mean, cell_count, poi_diversity, transit_hub_count FROM zfeat""", *ZT, extra=ZF))
def zone_features(spark, sf):
    f = _features(spark, sf)
    return f.withColumns({c: F.round(c, 8 if c == "opportunity_mean" else 4) for c in ("area_km2", "pop_density", "commerce_weight_sum", "opportunity_mean")})


@query("ae_score", sql("SELECT zone_id, zone_name, round(commerce_n, 6) AS commerce_n, round(density_n, 6) AS density_n, round(diversity_n, 6) AS diversity_n, round(transit_n, 6) AS transit_n, ae_score FROM scores", *ZT, extra=ZF))
def ae_score(spark, sf):
    return rounded(zf.activity_score(_features(spark, sf)))


@query("ae_class", sql("""SELECT zone_id, ae_score, CASE WHEN rn <= 3 THEN 'A' WHEN rn <= 9 THEN 'B' WHEN rn <= 17 THEN 'C' WHEN rn <= 23 THEN 'D' ELSE 'E' END AS ae_class
    FROM (SELECT *, row_number() OVER (ORDER BY ae_score DESC, zone_id) AS rn FROM scores)""", *ZT, extra=ZF))
def ae_class(spark, sf):
    return zf.rank_buckets(zf.activity_score(_features(spark, sf)), (3, 6, 8, 6, 2)).select("zone_id", "ae_score", "ae_class")


@query("zone_edges", sql("SELECT zone_id, CAST(t AS INT) AS neighbour FROM (SELECT zone_id, unnest(string_split(adjacent_zones, ',')) AS t FROM zones)", "zones"))
def zone_edges(spark, sf):
    return zf.zone_edges(views.zones(spark, sf))


@query("zone_edges_symmetric", sql("""WITH e AS (SELECT zone_id, CAST(t AS INT) AS neighbour FROM (SELECT zone_id, unnest(string_split(adjacent_zones, ',')) AS t FROM zones))
    SELECT zone_id, neighbour FROM e UNION SELECT neighbour, zone_id FROM e""", "zones").replace("zones) WITH e AS", "zones), e AS").replace(") WITH e", "), e"))
def zone_edges_symmetric(spark, sf):
    return zf.zone_edges(views.zones(spark, sf), symmetric=True)


PRIOR = "CASE zone_id " + " ".join(f"WHEN {z} THEN {w}e0" for z, w in K.ZONE_PRIOR.items()) + " ELSE 1e0 END"
BONUS = "(1e0 + 0.3e0 / (1e0 + abs(centroid_lon + 7.605e0)))"


@query("zone_weights", sql("SELECT zone_id, " + ", ".join(f"round({c} / sum({c}) OVER (), 9) AS {c}" for c in ("prior_w", "visit_w", "area_w")) + f""" FROM (
    SELECT zone_id, {PRIOR} * {BONUS} AS prior_w, (coalesce(n, 0) + 0.1e0) * {BONUS} AS visit_w, pow((lat_max - lat_min) * (lon_max - lon_min), 0.25e0) AS area_w
    FROM zones LEFT JOIN (SELECT origin_zone, count(*) AS n FROM cur GROUP BY 1) ON origin_zone = zone_id)""", "cur"))
def zone_weights(spark, sf):
    visits = views.curated(spark, sf).groupBy(F.col("origin_zone").alias("zone_id")).agg(F.count("*").alias("n"))
    return rounded(zf.zone_weights(views.zones(spark, sf), visits), 9)


@query("origin_weights", sql("""SELECT zone_id, zone_name, ae_class, round(w, 4) AS weight, round(w / sum(w) OVER (), 9) AS p FROM (SELECT *,
    population * CASE ae_class WHEN 'A' THEN 1.8e0 WHEN 'B' THEN 1.3e0 WHEN 'C' THEN 1e0 WHEN 'D' THEN 0.7e0 ELSE 0.5e0 END AS w FROM zones)""", "zones"))
def origin_weights(spark, sf):
    return synth.origin_weights(views.zones(spark, sf)).withColumns({"weight": F.round("weight", 4), "p": F.round("p", 9)})


GRID_BOX = """SELECT r * 1000000 + c AS cell FROM
      (SELECT unnest(range(CAST(floor((min(lat_min) + 90e0) / 0.005e0) AS BIGINT), CAST(floor((max(lat_max) + 90e0) / 0.005e0) AS BIGINT) + 1)) AS r FROM zones),
      (SELECT unnest(range(CAST(floor((min(lon_min) + 180e0) / 0.005e0) AS BIGINT), CAST(floor((max(lon_max) + 180e0) / 0.005e0) AS BIGINT) + 1)) AS c FROM zones)"""


@query("cell_density", sql(f"""SELECT cell, visits, trips, visits * 15 AS dwell_s, round((rank() OVER (ORDER BY visits) + (count(*) OVER (PARTITION BY visits) - 1) / 2e0) / count(*) OVER (), 9) AS density_rank
    FROM (SELECT g.cell, coalesce(visits, 0) AS visits, coalesce(trips, 0) AS trips FROM ({GRID_BOX}) g
    LEFT JOIN (SELECT cell, count(*) AS visits, count(DISTINCT taxi_id) AS trips FROM feed WHERE cell IS NOT NULL GROUP BY 1) v ON v.cell = g.cell)""", "zones", "feed"))
def cell_density(spark, sf):
    points = views.table(spark, sf, "feed").where("cell IS NOT NULL").select("cell", F.col("taxi_id").alias("trip_id"))
    return rounded(zf.cell_density(points, spatial.box_cells(views.zones(spark, sf))), 9)


@query("grid_resolution_report", sql(" UNION ALL ".join(
    f"SELECT {s}e0 AS size_deg, count(DISTINCT {grid_sql('o_lat', 'o_lon', f'{s}e0')}) AS n_cells, round({s}e0 * {s}e0 * {KM2}, 6) AS cell_km2 FROM trips" for s in (0.04, 0.02, 0.01, 0.005, 0.0025)), "trips"))
def grid_resolution_report(spark, sf):
    return rounded(zf.grid_report(views.table(spark, sf, "trips"), "o_lat", "o_lon", [0.04, 0.02, 0.01, 0.005, 0.0025]))


@query("node_coverage", sql("""SELECT zone_id, zone_name, coalesce(n, 0) AS nodes, CASE WHEN coalesce(n, 0) >= 200 THEN 'OK' WHEN coalesce(n, 0) >= 50 THEN 'LOW' ELSE 'SPARSE' END AS flag FROM zones
    LEFT JOIN (SELECT zone_id, count(*) AS n FROM (""" + pip("(SELECT node_id, node_lat AS lat, node_lon AS lon FROM nodes)", "node_id") + ") GROUP BY 1) USING (zone_id)", "zones", "nodes", extra=POLY))
def node_coverage(spark, sf):
    hit = spatial.point_in_polygon(views.table(spark, sf, "nodes"), polygons(spark, sf), "node_lat", "node_lon")
    return quality.node_coverage(hit, views.zones(spark, sf))


@query("tag_classify", sql("""SELECT stop_id, CASE stop_id % 7 WHEN 0 THEN 'tram' WHEN 1 THEN 'tram_stop' WHEN 2 THEN 'tram_stop' WHEN 3 THEN 'brt' WHEN 4 THEN 'brt' WHEN 5 THEN 'brt_stop' END AS mode FROM stops""", "stops"))
def tag_classify(spark, sf):
    kinds = [{"railway": "tram"}, {"railway": "tram_stop"}, {"public_transport": "stop_position", "tram": "yes"}, {"highway": "busway"},
             {"busway": "lane"}, {"amenity": "bus_station"}, {"highway": "residential"}]
    tag_map = F.lit(None).cast("map<string,string>")
    for i, kv in enumerate(kinds):
        tag_map = F.when(F.col("stop_id") % 7 == i, F.create_map(*[F.lit(x) for p in kv.items() for x in p])).otherwise(tag_map)
    return views.table(spark, sf, "stops").select("stop_id", tags.classify(tag_map).alias("mode"))


# --- coordinate maps -------------------------------------------------------------------------

ENDS = "SELECT TRIP_ID AS trip_id, points[1][2] AS lat, points[1][1] AS lon FROM good"


def _starts(spark, sf):
    p = F.try_element_at("points", F.lit(1))
    return views.usable(spark, sf).select(F.col("TRIP_ID").alias("trip_id"), F.get(p, 1).alias("lat"), F.get(p, 0).alias("lon"))


def _aff(v, src, dst):
    s = (dst[1] - dst[0]) / (src[1] - src[0])
    return f"({v} * ({s!r}::DOUBLE) + ({dst[0] - src[0] * s!r}::DOUBLE))"


RLAT, RLON = remap_sql("lat", K.SOURCE_LAT, K.TARGET_LAT), remap_sql("lon", K.SOURCE_LON, K.TARGET_LON)


@query("geo_remap", sql(f"SELECT trip_id, round({RLAT}, 6) AS lat, round({RLON}, 6) AS lon FROM ({ENDS})", "good"))
def geo_remap(spark, sf):
    s = _starts(spark, sf)
    return rounded(s.select("trip_id", geo.remap(F.col("lat"), K.SOURCE_LAT, K.TARGET_LAT).alias("lat"), geo.remap(F.col("lon"), K.SOURCE_LON, K.TARGET_LON).alias("lon")))


@query("geo_affine", sql(f"SELECT trip_id, round({_aff('lat', K.URBAN_LAT, K.TARGET_LAT)}, 9) AS lat, round({_aff('lon', K.URBAN_LON, K.TARGET_LON)}, 9) AS lon FROM ({ENDS})", "good"))
def geo_affine(spark, sf):
    s = _starts(spark, sf)
    return rounded(s.select("trip_id", geo.affine(F.col("lat"), K.URBAN_LAT, K.TARGET_LAT).alias("lat"), geo.affine(F.col("lon"), K.URBAN_LON, K.TARGET_LON).alias("lon")), 9)


@query("geo_rotate", sql("""SELECT trip_id, round(cos(radians(-45e0)) * (o_lat - 33.565e0) - sin(radians(-45e0)) * (o_lon + 7.6e0) + 33.565e0, 6) AS lat,
    round(sin(radians(-45e0)) * (o_lat - 33.565e0) + cos(radians(-45e0)) * (o_lon + 7.6e0) - 7.6e0, 6) AS lon FROM trips""", "trips"))
def geo_rotate(spark, sf):
    lat, lon = geo.rotate(F.col("o_lat"), F.col("o_lon"), -45.0, K.TARGET_LAT, K.TARGET_LON)
    return rounded(views.table(spark, sf, "trips").select("trip_id", lat.alias("lat"), lon.alias("lon")))


@query("geo_jitter", sql(f"SELECT trip_id, round(o_lat + {gauss('trip_id', 'lat', 42)} * 0.0002e0, 6) AS lat, round(o_lon + {gauss('trip_id', 'lon', 42)} * 0.0002e0, 6) AS lon FROM trips", "trips"))
def geo_jitter(spark, sf):
    return rounded(views.table(spark, sf, "trips").select(
        "trip_id", (F.col("o_lat") + draws.gaussian(F.col("trip_id"), "lat", 42, 0.0, K.NOISE_SIGMA)).alias("lat"),
        (F.col("o_lon") + draws.gaussian(F.col("trip_id"), "lon", 42, 0.0, K.NOISE_SIGMA)).alias("lon")))


@query("anchor_pull", sql("SELECT trip_id, round(0.2e0 * o_lat + 0.8e0 * centroid_lat, 6) AS lat, round(0.2e0 * o_lon + 0.8e0 * centroid_lon, 6) AS lon FROM cur JOIN zones ON zone_id = origin_zone", "cur"))
def anchor_pull(spark, sf):
    dim = views.zones(spark, sf).select(F.col("zone_id").alias("origin_zone"), "centroid_lat", "centroid_lon")
    df = common.enrich(views.curated(spark, sf), dim, "origin_zone")
    a = K.ANCHOR_PULL
    return rounded(df.select("trip_id", ((1 - a) * F.col("o_lat") + a * F.col("centroid_lat")).alias("lat"), ((1 - a) * F.col("o_lon") + a * F.col("centroid_lon")).alias("lon")))


# --- balance ---------------------------------------------------------------------------------

GINI = """SELECT count(*) AS n_keys, CAST(sum(x) AS BIGINT) AS total, round(1e0 - 2e0 * sum(c) / (count(*) * sum(x)) + 1e0 / count(*), 6) AS gini
    FROM (SELECT x, sum(x) OVER (ORDER BY x, k ROWS UNBOUNDED PRECEDING) AS c FROM ({}))"""


@query("gini", sql(GINI.format("SELECT origin_zone AS k, count(*) AS x FROM cur GROUP BY 1"), "cur"))
def gini(spark, sf):
    return rounded(quality.gini(views.curated(spark, sf), "origin_zone"))


@query("quality_gate", sql(f"""SELECT count(*) AS samples, (SELECT count(DISTINCT zone) FROM g) AS zones_covered, round(avg((zone IS NULL)::INT) * 100, 6) AS outside_pct, round(avg(clamped::INT) * 100, 6) AS clamped_pct,
      (SELECT gini FROM ({GINI.format("SELECT zone AS k, count(*) AS x FROM g WHERE zone IS NOT NULL GROUP BY 1")})) AS gini,
      (SELECT round(sum(n) FILTER (WHERE r <= 5)::DOUBLE / sum(n)::DOUBLE * 100, 6) FROM (SELECT count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, zone) AS r FROM g WHERE zone IS NOT NULL GROUP BY zone)) AS top5_pct,
      'FAIL' AS verdict FROM g""", "good", "zones", extra={
    "g": f"""SELECT {zone_of('y', 'x')} AS zone, clamped FROM (SELECT {RLAT} AS y, {RLON} AS x, NOT (lat BETWEEN 41.135e0 AND 41.174e0 AND lon BETWEEN -8.65e0 AND -8.585e0) AS clamped
        FROM ({ENDS}) WHERE lat BETWEEN 41.10e0 AND 41.25e0 AND lon BETWEEN -8.72e0 AND -8.55e0)"""}))
def quality_gate(spark, sf):
    s = _starts(spark, sf).where(geo.inside(F.col("lat"), F.col("lon"), K.METRO_LAT, K.METRO_LON))
    s = s.withColumns({"y": geo.remap(F.col("lat"), K.SOURCE_LAT, K.TARGET_LAT), "x": geo.remap(F.col("lon"), K.SOURCE_LON, K.TARGET_LON)})
    return rounded(quality.quality_gate(s, views.zones(spark, sf), "y", "x", ~geo.inside(F.col("lat"), F.col("lon"), K.SOURCE_LAT, K.SOURCE_LON)))


@query("clamp_edges", sql(f"""SELECT count(*) AS n, count(*) FILTER (WHERE y <= 33.451e0) AS south, count(*) FILTER (WHERE y >= 33.679e0) AS north, count(*) FILTER (WHERE x <= -7.719e0) AS west, count(*) FILTER (WHERE x >= -7.481e0) AS east,
    round((count(*) FILTER (WHERE y <= 33.451e0) + count(*) FILTER (WHERE y >= 33.679e0) + count(*) FILTER (WHERE x <= -7.719e0) + count(*) FILTER (WHERE x >= -7.481e0)) / count(*)::DOUBLE * 100, 6) AS clamped_pct
    FROM (SELECT {RLAT} AS y, {RLON} AS x FROM ({ENDS}))""", "good"))
def clamp_edges(spark, sf):
    s = _starts(spark, sf)
    s = s.select(geo.remap(F.col("lat"), K.SOURCE_LAT, K.TARGET_LAT).alias("y"), geo.remap(F.col("lon"), K.SOURCE_LON, K.TARGET_LON).alias("x"))
    return rounded(quality.clamp_edges(s, "y", "x"))


@query("band_share", sql(" UNION ALL ".join(
    f"SELECT '{n}' AS band, count(*) FILTER (WHERE o_lat >= {a}e0 AND o_lat < {b}e0) AS trips, round(count(*) FILTER (WHERE o_lat >= {a}e0 AND o_lat < {b}e0) / count(*)::DOUBLE * 100, 6) AS pct FROM trips"
    for n, a, b in K.BANDS), "trips"))
def band_share(spark, sf):
    return rounded(quality.band_share(views.table(spark, sf, "trips"), "o_lat"))


LOWS, HIGHS, B1, B2, B3 = (41.135, 41.138, 41.140), (41.172, 41.174, 41.176), (33.50, 33.515), (33.545, 33.56), (33.61, 33.625)
CAL = {
    "cfg": "SELECT * FROM " + ", ".join(f"(SELECT unnest([{', '.join(f'{x}e0' for x in xs)}]) AS {n})" for n, xs in (("src_lo", LOWS), ("src_hi", HIGHS), ("b1", B1), ("b2", B2), ("b3", B3))),
    "sims": f"""SELECT cfg.*, lat, greatest(0e0, least(1e0, (lat - src_lo) / (src_hi - src_lo))) * ({33.68 - 33.45!r}::DOUBLE) + 33.45e0 AS sim FROM ({ENDS}), cfg""",
    "agg": """SELECT src_lo, src_hi, b1, b2, b3, avg((sim >= 33.45e0 AND sim < b1)::INT) * 100 AS p0, avg((sim >= b1 AND sim < b2)::INT) * 100 AS p1,
        avg((sim >= b2 AND sim < b3)::INT) * 100 AS p2, avg((sim >= b3 AND sim < 33.68e0)::INT) * 100 AS p3, avg((lat < src_lo OR lat > src_hi)::INT) * 100 AS cl FROM sims GROUP BY ALL""",
}


@query("calibrate_bands", sql("""SELECT src_lo, src_hi, b1, b2, b3, round(p0, 4) AS pct0, round(p1, 4) AS pct1, round(p2, 4) AS pct2, round(p3, 4) AS pct3, round(cl, 4) AS clamp_pct,
    round(pow(p0 - 15, 2) + pow(p1 - 23, 2) + pow(p2 - 35, 2) + pow(p3 - 22, 2) + cl * 2, 4) AS score FROM agg""", "good", extra=CAL))
def calibrate_bands(spark, sf):
    return rounded(quality.calibrate_bands(_starts(spark, sf), "lat", LOWS, HIGHS, B1, B2, B3), 4)


@query("calibrate_best", sql("""SELECT src_lo, src_hi, b1, b2, b3, round(sc, 4) AS score FROM (SELECT *, pow(p0 - 15, 2) + pow(p1 - 23, 2) + pow(p2 - 35, 2) + pow(p3 - 22, 2) + cl * 2 AS sc FROM agg)
    WHERE cl <= 70 AND least(p0, p1, p2, p3) >= 8 ORDER BY sc, 1, 2, 3, 4, 5 LIMIT 1""", "good", extra=CAL))
def calibrate_best(spark, sf):
    scored = quality.calibrate_bands(_starts(spark, sf), "lat", LOWS, HIGHS, B1, B2, B3)
    return rounded(quality.best_bands(scored, 70.0).select("src_lo", "src_hi", "b1", "b2", "b3", "score"), 4)


@query("density_splits", sql(" UNION ALL ".join(
    f"SELECT '{n}' AS band, {p}::DOUBLE AS p, round(quantile_cont(o_lon, {p}) FILTER (WHERE o_lat >= {a}e0 AND o_lat < {b}e0), 6) AS lon FROM trips" for n, a, b in K.BANDS for p in (0.25, 0.5, 0.75)), "trips"))
def density_splits(spark, sf):
    band = F.lit(None).cast("string")
    for n, a, b in K.BANDS:
        band = F.when((F.col("o_lat") >= a) & (F.col("o_lat") < b), n).otherwise(band)
    df = views.table(spark, sf, "trips").withColumn("band", band).where("band IS NOT NULL")
    return rounded(common.percentiles(df, "o_lon", [0.25, 0.5, 0.75], ["band"]).withColumnRenamed("value", "lon"))
