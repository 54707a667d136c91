"""Zone activity features: commerce, transit, area, score, class, weights."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareline import constants as K
from fareline.functions import geo
from fareline.operators import common
from fareline.operators.spatial import point_in_polygon
from fareline.session import cut_lineage, small_side

def _all():
    """One group over a zone-sized frame."""
    return Window.partitionBy(F.lit(0))


def zone_polygons(zones: DataFrame) -> DataFrame:
    """Outline of a zone: its box with cut corners, closed ring of [lon, lat]."""
    y0, y1, x0, x1 = (F.col(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max"))
    p = lambda x, y: F.array(x, y)
    ring = F.array(p(x0, y0), p(x1, y0 + 0.004), p(x1 - 0.004, y1), p(x0 + 0.004, y1 - 0.004), p(x0, y0))
    return zones.withColumn("outline", ring)


def polygon_summary(polys: DataFrame) -> DataFrame:
    ring = F.col("outline")
    lat, lon = geo.ring_centroid(ring)
    return polys.select(
        "zone_id", geo.km2(geo.ring_area(ring)).alias("area_km2"), lat.alias("centroid_lat"), lon.alias("centroid_lon"),
        F.array_min(F.transform(ring, lambda p: F.get(p, 1))).alias("lat_min"), F.array_max(F.transform(ring, lambda p: F.get(p, 1))).alias("lat_max"),
        F.array_min(F.transform(ring, lambda p: F.get(p, 0))).alias("lon_min"), F.array_max(F.transform(ring, lambda p: F.get(p, 0))).alias("lon_max"),
        F.size(ring).alias("n_vertices"))


def area_gate(polys: DataFrame, limits=K.POLYGON_AREA_DEG2) -> DataFrame:
    return polys.withColumn("area_deg2", geo.ring_area(F.col("outline"))).where(F.col("area_deg2").between(*limits))


def zone_area(polys: DataFrame) -> DataFrame:
    area = geo.km2(geo.ring_area(F.col("outline")))
    return polys.select("zone_id", "zone_name", "population", area.alias("area_km2")).withColumn("pop_density", F.col("population") / F.col("area_km2"))


def zone_commerce(sites: DataFrame, polys: DataFrame) -> DataFrame:
    """Commerce sums per zone and the number of distinct types. The type list is counted on
    distinct (zone, type) pairs after a partial aggregate, not on collected lists."""
    hit = point_in_polygon(sites, polys, "lat", "lon")
    sums = hit.groupBy("zone_id").agg(
        F.sum("commerce_count").alias("commerce_count_sum"), F.sum("commerce_weight").alias("commerce_weight_sum"),
        F.avg("opportunity").alias("opportunity_mean"), F.count("*").alias("cell_count"))
    kinds = hit.select("zone_id", F.explode(F.split("commerce_types", r"\|")).alias("t")).where("t <> ''").groupBy("zone_id").agg(
        F.count_distinct("t").alias("poi_diversity"))
    return sums.join(kinds, "zone_id", "left")


def zone_transit(stops: DataFrame, polys: DataFrame) -> DataFrame:
    hubs = stops.where(F.col("mode").isin("tram_stop", "brt_stop"))
    return point_in_polygon(hubs, polys, "lat", "lon").groupBy("zone_id").agg(F.count("*").alias("transit_hub_count"))


def zone_features(polys: DataFrame, commerce: DataFrame, transit: DataFrame) -> DataFrame:
    return zone_area(polys).join(commerce, "zone_id", "left").join(transit, "zone_id", "left").fillna(
        0, ["commerce_count_sum", "commerce_weight_sum", "opportunity_mean", "cell_count", "poi_diversity", "transit_hub_count"])


def activity_score(feats: DataFrame, weights=K.SCORE_WEIGHTS) -> DataFrame:
    """Weighted sum of min-max scaled metrics; a constant metric counts 0.5. Zone-sized input."""
    def unit(c):
        lo, hi = F.min(c).over(_all()), F.max(c).over(_all())
        return F.when(hi > lo, (F.col(c) - lo) / (hi - lo)).otherwise(0.5)

    parts = {"commerce": unit("commerce_weight_sum"), "density": unit("pop_density"),
             "diversity": unit("poi_diversity"), "transit": unit("transit_hub_count")}
    total = sum((parts[k] * w for k, w in weights.items()), F.lit(0.0))
    return feats.select("zone_id", "zone_name", *[v.alias(f"{k}_n") for k, v in parts.items()], F.round(total, 4).alias("ae_score"))


def rank_buckets(scored: DataFrame, counts=(2, 4, 5, 4, 1), labels=K.CLASSES) -> DataFrame:
    """Fixed-size classes from the top score down; what is left over joins the last class."""
    rn = F.row_number().over(_all().orderBy(F.desc("ae_score"), "zone_id"))
    out, edge = F.lit(labels[-1]), 0
    bounds = []
    for n in counts:
        edge += n
        bounds.append(edge)
    for label, b in reversed(list(zip(labels, bounds))[:-1]):
        out = F.when(F.col("rn") <= b, label).otherwise(out)
    return scored.withColumn("rn", rn).withColumn("ae_class", out).drop("rn")


def zone_weights(zones: DataFrame, visits: DataFrame) -> DataFrame:
    """Four sampling weights per zone: prior density and visit counts with coast bonus, damped box
    area, each normalised to 1. ``visits`` has zone_id, n."""
    prior = F.coalesce(*[F.when(F.col("zone_id") == z, w) for z, w in K.ZONE_PRIOR.items()], F.lit(1.0))
    bonus = geo.coast_bonus(F.col("centroid_lon"))
    area = (F.col("lat_max") - F.col("lat_min")) * (F.col("lon_max") - F.col("lon_min"))
    w = zones.join(visits, "zone_id", "left").select(
        "zone_id", (prior * bonus).alias("prior_w"),
        ((F.coalesce("n", F.lit(0)) + K.CLAIM_SMOOTHING) * bonus).alias("visit_w"), F.pow(area, 0.25).alias("area_w"))
    return w.select("zone_id", *[(F.col(c) / F.sum(c).over(_all())).alias(c) for c in ("prior_w", "visit_w", "area_w")])


def zone_edges(zones: DataFrame, symmetric: bool = False) -> DataFrame:
    """Adjacency text to directed edges; entries that are not digits are skipped."""
    e = zones.select("zone_id", F.explode(F.transform(F.split("adjacent_zones", ","), lambda s: F.trim(s))).alias("t")).where(
        F.col("t").rlike("^[0-9]+$")).select("zone_id", F.col("t").cast("int").alias("neighbour"))
    if symmetric:
        e = e.unionByName(e.select(F.col("neighbour").alias("zone_id"), F.col("zone_id").alias("neighbour"))).distinct()
    return e


def cell_density(points: DataFrame, grid: DataFrame) -> DataFrame:
    """Visits, distinct trips and dwell seconds for every grid cell, with the average-tie percent
    rank of visits. The rank comes from counts per visit value, not from sorting all cells."""
    per = points.groupBy("cell").agg(F.count("*").alias("visits"), F.count_distinct("trip_id").alias("trips"))
    full = grid.select("cell").join(per, "cell", "left").fillna(0, ["visits", "trips"])
    ranks = common.ordered_counts(full, "visits").select(F.col("value").alias("visits"), ((F.col("before") + (F.col("n") + 1) / 2) / F.col("total")).alias("density_rank"))
    rank = cut_lineage(ranks, "density-ranks")
    return full.join(small_side(rank), "visits").select(
        "cell", "visits", "trips", (F.col("visits") * K.POINT_STEP_S).alias("dwell_s"), "density_rank")


def grid_report(points: DataFrame, lat: str, lon: str, sizes: list[float]) -> DataFrame:
    """Occupied cells and cell area per grid size, from one pass: the finest occupied cells are
    found first and every size is derived from the point's own coordinates."""
    per = points.select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("size_deg"), geo.grid_cell(F.col(lat), F.col(lon), s).alias("cell")) for s in sizes])))
    return per.groupBy("size_deg").agg(F.count_distinct("cell").alias("n_cells")).withColumn(
        "cell_km2", geo.km2(F.col("size_deg") * F.col("size_deg")))
