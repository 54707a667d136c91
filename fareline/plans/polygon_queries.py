"""Shapes with holes and parts: overlap, combined coverage, cells inside, claims by priority."""

from pyspark.sql import functions as F

from fareline.functions import geo
from fareline.operators import polygons, spatial
from fareline.operators import zonefeatures as zf
from fareline.plans import views
from fareline.plans.ctes import sql
from fareline.plans.registry import query, rounded
from fareline.plans.spatial_queries import KM2, POLY

# A zone's outline, a square hole around the centre of odd zones, a triangle east of every fourth.
SHAPES = {
    "polys": POLY["polys"],
    "shapes": """SELECT zone_id, ring FROM polys
        UNION ALL SELECT zone_id, [[centroid_lon - 0.006e0, centroid_lat - 0.005e0], [centroid_lon + 0.006e0, centroid_lat - 0.005e0], [centroid_lon + 0.006e0, centroid_lat + 0.005e0],
            [centroid_lon - 0.006e0, centroid_lat + 0.005e0], [centroid_lon - 0.006e0, centroid_lat - 0.005e0]] FROM polys WHERE zone_id % 2 = 1
        UNION ALL SELECT zone_id, [[lon_max + 0.011e0, lat_min], [lon_max + 0.043e0, lat_min + 0.007e0], [lon_max + 0.017e0, lat_max + 0.003e0], [lon_max + 0.011e0, lat_min]] FROM polys WHERE zone_id % 4 = 0""",
    "edges": """SELECT zone_id, ring[i][1] AS px, ring[i][2] AS py, ring[i+1][1] AS qx, ring[i+1][2] AS qy FROM (SELECT *, unnest(range(1, len(ring))) AS i FROM shapes) WHERE ring[i][2] <> ring[i+1][2]""",
    "lines": """SELECT row_number() OVER () AS eid, zone_id, CASE WHEN py < qy THEN px ELSE qx END AS xa, least(py, qy) AS ya, CASE WHEN py < qy THEN qx ELSE px END AS xb, greatest(py, qy) AS yb FROM edges""",
}
#: Heights between which no edge begins, ends or meets another, for groups g of shapes (members).
SLABS = {
    "own": "SELECT m.g, l.* FROM members m JOIN lines l ON l.zone_id = m.zone_id",
    "heights": """SELECT g, ya AS y FROM own UNION SELECT g, yb FROM own
        UNION SELECT g, y FROM (SELECT a.g, a.ya + ((b.ya - a.ya) * (b.xb - b.xa) / (b.yb - b.ya) - (b.xa - a.xa)) / ((b.xb - b.xa) / (b.yb - b.ya) - (a.xb - a.xa) / (a.yb - a.ya)) AS y, greatest(a.ya, b.ya) AS lo, least(a.yb, b.yb) AS hi
          FROM own a JOIN own b ON a.g = b.g AND a.eid < b.eid AND a.ya < b.yb AND b.ya < a.yb AND (b.xb - b.xa) / (b.yb - b.ya) <> (a.xb - a.xa) / (a.yb - a.ya)) WHERE y > lo AND y < hi""",
    "slabs": "SELECT * FROM (SELECT g, y AS y0, lead(y) OVER (PARTITION BY g ORDER BY y) AS y1 FROM heights) WHERE y1 IS NOT NULL",
    "hits": "SELECT s.g, s.y0, s.y1, o.zone_id, o.xa + ((s.y0 + s.y1) / 2 - o.ya) * (o.xb - o.xa) / (o.yb - o.ya) AS x FROM slabs s JOIN own o ON o.g = s.g AND o.ya <= s.y0 AND o.yb >= s.y1",
}


def shapes(spark, sf):
    z = zf.zone_polygons(views.zones(spark, sf))
    p = lambda x, y: F.array(x, y)
    y, x, e = F.col("centroid_lat"), F.col("centroid_lon"), F.col("lon_max")
    hole = F.array(p(x - 0.006, y - 0.005), p(x + 0.006, y - 0.005), p(x + 0.006, y + 0.005), p(x - 0.006, y + 0.005), p(x - 0.006, y - 0.005))
    part = F.array(p(e + 0.011, F.col("lat_min")), p(e + 0.043, F.col("lat_min") + 0.007), p(e + 0.017, F.col("lat_max") + 0.003), p(e + 0.011, F.col("lat_min")))
    more = z.where("zone_id % 2 = 1").select("zone_id", hole.alias("ring")).union(z.where("zone_id % 4 = 0").select("zone_id", part.alias("ring")))
    return z.select("zone_id", F.col("outline").alias("ring")).union(more)


@query("polygon_overlap", sql(f"""SELECT za AS zone_a, zb AS zone_b, round(sum((y1 - y0) * w) * {KM2}, 6) AS overlap_km2 FROM (
    SELECT za, zb, y0, y1, x, CASE WHEN sum(CASE WHEN zone_id = za THEN 1 ELSE 0 END) OVER w % 2 = 1 AND sum(CASE WHEN zone_id = zb THEN 1 ELSE 0 END) OVER w % 2 = 1
      THEN lead(x) OVER (PARTITION BY g, y0 ORDER BY x) - x ELSE 0 END AS w
    FROM hits JOIN pairs USING (g) WINDOW w AS (PARTITION BY g, y0 ORDER BY x ROWS UNBOUNDED PRECEDING)) GROUP BY 1, 2 HAVING sum((y1 - y0) * w) > 1e-8""", "zones", extra={
        **SHAPES, "pairs": "SELECT a.zone_id * 1000 + b.zone_id AS g, a.zone_id AS za, b.zone_id AS zb FROM zones a JOIN zones b ON a.zone_id < b.zone_id",
        "members": "SELECT g, za AS zone_id FROM pairs UNION ALL SELECT g, zb FROM pairs", **SLABS}))
def polygon_overlap(spark, sf):
    return rounded(polygons.overlaps(shapes(spark, sf)))


@query("polygon_coverage", sql(f"""SELECT round(sum(CASE WHEN g > 0 THEN (y1 - y0) * w END) * {KM2}, 6) AS sum_km2, round(sum(CASE WHEN g = 0 THEN (y1 - y0) * w END) * {KM2}, 6) AS covered_km2 FROM (
    SELECT g, y0, y1, CASE WHEN inside > 0 THEN lead(x) OVER (PARTITION BY g, y0 ORDER BY x, n) - x ELSE 0 END AS w FROM (
      SELECT g, y0, y1, x, n, sum(turn) OVER (PARTITION BY g, y0 ORDER BY x, n ROWS UNBOUNDED PRECEDING) AS inside FROM (
        SELECT *, CASE WHEN row_number() OVER (PARTITION BY g, y0, zone_id ORDER BY x) % 2 = 1 THEN 1 ELSE -1 END AS turn, row_number() OVER (PARTITION BY g, y0 ORDER BY x, zone_id) AS n FROM hits)))""", "zones", extra={
        **SHAPES, "members": "SELECT 0 AS g, zone_id FROM zones UNION ALL SELECT zone_id, zone_id FROM zones", **SLABS}))
def polygon_coverage(spark, sf):
    return rounded(polygons.coverage(shapes(spark, sf)).select("sum_km2", "covered_km2"))


_INSIDE = f"""SELECT c.zone_id, c.cell, c.cell_lat, c.cell_lon FROM (
    SELECT zone_id, r * 1000000 + c AS cell, (r + 0.5e0) * 0.005e0 - 90e0 AS cell_lat, (c + 0.5e0) * 0.005e0 - 180e0 AS cell_lon FROM (
      SELECT *, unnest(range(CAST(floor((x0 + 180e0) / 0.005e0) AS BIGINT) - 1, CAST(floor((x1 + 180e0) / 0.005e0) AS BIGINT) + 2)) AS c FROM (
      SELECT *, unnest(range(CAST(floor((y0 + 90e0) / 0.005e0) AS BIGINT) - 1, CAST(floor((y1 + 90e0) / 0.005e0) AS BIGINT) + 2)) AS r FROM (
      SELECT zone_id, min(least(xa, xb)) AS x0, max(greatest(xa, xb)) AS x1, min(ya) AS y0, max(yb) AS y1 FROM lines GROUP BY 1)))) c
    JOIN lines l ON l.zone_id = c.zone_id AND l.ya <= c.cell_lat AND c.cell_lat < l.yb AND c.cell_lon < l.xa + (c.cell_lat - l.ya) * (l.xb - l.xa) / (l.yb - l.ya)
    GROUP BY ALL HAVING count(*) % 2 = 1"""


@query("polyfill", sql("SELECT zone_id, cell FROM inside", "zones", extra={**SHAPES, "inside": _INSIDE}))
def polyfill(spark, sf):
    return polygons.polyfill(shapes(spark, sf)).select("zone_id", "cell")


@query("polyfill_claim", sql("SELECT cell, arg_min(zone_id, (zone_id % 3) * 1000 + zone_id) AS zone_id, min(zone_id % 3) AS priority FROM inside GROUP BY 1", "zones", extra={**SHAPES, "inside": _INSIDE}))
def polyfill_claim(spark, sf):
    """Cells from the shapes themselves; the better source first, then the lower zone."""
    cells = polygons.polyfill(shapes(spark, sf), geo.GRID_DEG).select("cell", "zone_id", (F.col("zone_id") % 3).alias("priority"))
    return spatial.claim_cells(cells)
