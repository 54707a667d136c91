"""Spatial joins.

Every spatial join is an equi-join on grid cells: the dimension side is folded into an index with
one row per cell holding the candidate shapes, so a fact row meets at most one index row. Facts are
never multiplied by candidates and never shuffled when the index is small; beyond the broadcast
limit the same join runs as a shuffle join with AQE skew splitting.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.functions import geo
from fareline.session import BROADCAST_LIMIT_BYTES, small_side, spread

INDEX_DEG = 0.02
#: One node in a cell's list: a struct of three numbers with its offset and null bits.
INDEX_ENTRY_BYTES = 48


def zone_index(zones: DataFrame, size: float = INDEX_DEG) -> DataFrame:
    """Cell -> array of zone boxes touching it, ordered by zone id."""
    return (
        zones.select(
            F.explode(geo.covering_cells(F.col("lat_min"), F.col("lat_max"), F.col("lon_min"), F.col("lon_max"), size)).alias("ix_cell"),
            F.struct("zone_id", "zone_name", "lat_min", "lat_max", "lon_min", "lon_max").alias("z"),
        )
        .groupBy("ix_cell")
        .agg(F.sort_array(F.collect_list("z")).alias("ix_zones"))
    )


def box_index(zones: DataFrame) -> DataFrame:
    """The zone index, marked for broadcast if it is small enough."""
    return small_side(zone_index(zones), expand=64)


def centroid_list(zones: DataFrame) -> Column:
    """All zone centroids as one scalar-subquery value (a city has tens of zones)."""
    return zones.agg(
        F.sort_array(F.collect_list(F.struct("zone_id", "zone_name", "centroid_lat", "centroid_lon")))
    ).scalar()


def with_nearest_centroid(df: DataFrame, zones: DataFrame, lat: str, lon: str, metric: str = "degrees", only: Column | None = None) -> DataFrame:
    """Add struct ``ix_near`` (dist, zone_id, zone_name) of the closest centroid; ties go to the
    lower id. ``only`` limits the search to the rows that need it."""
    y, x = F.col(lat), F.col(lon)
    if metric == "degrees":
        def dist(z):
            return F.pow(y - z["centroid_lat"], 2) + F.pow(x - z["centroid_lon"], 2)
    else:
        def dist(z):
            return geo.haversine_km(y, x, z["centroid_lat"], z["centroid_lon"])
    best = F.array_min(
        F.transform("ix_all", lambda z: F.struct(dist(z).alias("dist"), z["zone_id"].alias("zone_id"), z["zone_name"].alias("zone_name")))
    )
    best = best if only is None else F.when(only, best)
    return df.withColumn("ix_all", centroid_list(zones)).withColumn("ix_near", best).drop("ix_all")


def assign_box_zone(
    df: DataFrame,
    zones: DataFrame,
    lat: str,
    lon: str,
    mode: str = "first",
    prefix: str = "",
    fallback: str | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """Add ``<prefix>zone`` and ``<prefix>zone_name`` by box containment.

    mode: ``all`` repeats the row for every zone hit, ``first`` / ``last`` take the lowest / highest
    zone id. Rows in no zone get nulls, or the nearest centroid with ``fallback`` = ``degrees`` or
    ``haversine``. ``index`` is a ready :func:`box_index`, to share it between both trip ends.
    """
    y, x = F.col(lat), F.col(lon)
    size = INDEX_DEG
    joined = df.withColumn("ix_cell", geo.grid_cell(y, x, size)).join(box_index(zones) if index is None else index, "ix_cell", "left")
    hits = F.filter(
        "ix_zones",
        lambda z: (y >= z["lat_min"]) & (y <= z["lat_max"]) & (x >= z["lon_min"]) & (x <= z["lon_max"]),
    )
    names = {
        "zone_id": f"{prefix}zone",
        "zone_name": f"{prefix}zone_name",
    }
    keep = [c for c in df.columns]
    if mode == "all":
        out = joined.select(*keep, F.explode_outer(hits).alias("ix_hit"))
    else:
        pick = F.array_min if mode == "first" else F.array_max
        out = joined.select(*keep, pick(hits).alias("ix_hit"))
    if fallback:
        out = with_nearest_centroid(out, zones, lat, lon, fallback, F.col("ix_hit").isNull())
        return out.select(
            *keep,
            *[F.coalesce(F.col(f"ix_hit.{k}"), F.col(f"ix_near.{k}")).alias(v) for k, v in names.items()],
        )
    return out.select(*keep, *[F.col(f"ix_hit.{k}").alias(v) for k, v in names.items()])


def zone_cells(zones: DataFrame, size: float = geo.GRID_DEG) -> DataFrame:
    """Cells whose centre lies in a zone box; a cell may belong to several zones."""
    cells = zones.select(
        "zone_id", "zone_name", "lat_min", "lat_max", "lon_min", "lon_max",
        F.explode(geo.covering_cells(F.col("lat_min"), F.col("lat_max"), F.col("lon_min"), F.col("lon_max"), size)).alias("cell"),
    )
    lat, lon = geo.cell_center(F.col("cell"), size)
    return (
        cells.withColumn("cell_lat", lat).withColumn("cell_lon", lon)
        .where("cell_lat BETWEEN lat_min AND lat_max AND cell_lon BETWEEN lon_min AND lon_max")
        .select("zone_id", "zone_name", "cell", "cell_lat", "cell_lon")
    )


def claim_cells(candidates: DataFrame, priority: str = "priority") -> DataFrame:
    """One owner per cell: best (lowest) priority, then lowest zone id. ``min_by`` combines before
    the shuffle, so a cell with very many claims is no hot spot."""
    cols = [c for c in candidates.columns if c != "cell"]
    return (
        candidates.groupBy("cell")
        .agg(F.min(F.struct(F.col(priority), F.col("zone_id"), *[F.col(c) for c in cols if c not in (priority, "zone_id")])).alias("w"))
        .select("cell", *[F.col(f"w.{c}").alias(c) for c in cols])
    )


def cell_lookup(zones: DataFrame, land_only: bool = False) -> DataFrame:
    """The cell -> zone dimension: lowest zone id wins."""
    cells = zone_cells(zones)
    if land_only:
        cells = cells.where(geo.is_on_land(F.col("cell_lat"), F.col("cell_lon")))
    return (
        cells.groupBy("cell").agg(F.min(F.struct("zone_id", "zone_name")).alias("z"))
        .select("cell", "z.zone_id", "z.zone_name")
    )


def ring_lookup(lookup: DataFrame, max_rings: int = 5) -> DataFrame:
    """Lookup widened by up to ``max_rings`` rings: each missing cell takes the zone of the
    nearest known ring. Widening the dimension keeps the fact side a plain equi-join."""
    grown = None
    for k in range(max_rings + 1):
        part = lookup.select(F.explode(geo.ring(F.col("cell"), k)).alias("cell"), F.lit(k).alias("ring"), "zone_id", "zone_name")
        grown = part if grown is None else grown.unionByName(part)
    return (
        grown.groupBy("cell").agg(F.min(F.struct("ring", "zone_id", "zone_name")).alias("z"))
        .select("cell", "z.ring", "z.zone_id", "z.zone_name")
    )


def assign_cell_zone(df: DataFrame, lookup: DataFrame, cell: str = "cell", max_rings: int = 0, how: str = "left") -> DataFrame:
    """Zone by cell id. Unknown cells get zone 0 / ``Outside`` in a left join."""
    dim = ring_lookup(lookup, max_rings) if max_rings else lookup
    dim = dim.select(F.col("cell").alias("lk_cell"), F.col("zone_id").alias("lk_zone"), F.col("zone_name").alias("lk_name"))
    out = df.join(small_side(dim, expand=64 if max_rings == 0 else 1024), F.col(cell) == F.col("lk_cell"), how)
    if how == "left":
        zone, name = F.coalesce("lk_zone", F.lit(0)), F.coalesce("lk_name", F.lit("Outside"))
    else:
        zone, name = F.col("lk_zone"), F.col("lk_name")
    return out.withColumn("zone_id", zone).withColumn("zone_name", name).drop("lk_cell", "lk_zone", "lk_name")


def polygon_index(polys: DataFrame, size: float = INDEX_DEG) -> DataFrame:
    """Cell -> candidate outlines. ``polys`` has zone_id, zone_name, outline (array of [lon, lat])."""
    boxed = polys.select(
        "zone_id", "zone_name", "outline",
        F.array_min(F.transform("outline", lambda p: p[1])).alias("y0"),
        F.array_max(F.transform("outline", lambda p: p[1])).alias("y1"),
        F.array_min(F.transform("outline", lambda p: p[0])).alias("x0"),
        F.array_max(F.transform("outline", lambda p: p[0])).alias("x1"),
    )
    return (
        boxed.select(
            F.explode(geo.covering_cells(F.col("y0"), F.col("y1"), F.col("x0"), F.col("x1"), size)).alias("ix_cell"),
            F.struct("zone_id", "zone_name", "outline").alias("z"),
        )
        .groupBy("ix_cell")
        .agg(F.sort_array(F.collect_list("z")).alias("ix_polys"))
    )


def point_in_polygon(df: DataFrame, polys: DataFrame, lat: str, lon: str, how: str = "inner") -> DataFrame:
    """One row per (point, polygon) hit; with ``how='left'`` points outside all keep nulls."""
    y, x = F.col(lat), F.col(lon)
    joined = df.withColumn("ix_cell", geo.grid_cell(y, x, INDEX_DEG)).join(small_side(polygon_index(polys), expand=64), "ix_cell", how)
    hits = F.filter("ix_polys", lambda z: geo.in_ring(y, x, z["outline"]))
    spread = F.explode(hits) if how == "inner" else F.explode_outer(hits)
    return joined.select(*df.columns, spread.alias("z")).select(*df.columns, "z.zone_id", "z.zone_name")


def node_index(nodes: DataFrame, size: float) -> DataFrame:
    """Cell -> distinct node positions in the 3x3 block around it."""
    spots = nodes.groupBy("node_lat", "node_lon").agg(F.min("node_id").alias("node_id"))
    home = geo.grid_cell(F.col("node_lat"), F.col("node_lon"), size)
    block = F.flatten(F.array(geo.ring(home, 0), geo.ring(home, 1)))
    return (
        spots.select(F.explode(block).alias("ix_cell"), F.struct("node_id", "node_lat", "node_lon").alias("n"))
        .groupBy("ix_cell")
        .agg(F.collect_list("n").alias("ix_nodes"))
    )


def snap_levels(rows: int, area: float, limit_deg: float) -> int:
    """Grid levels down to cells of about one node, so that the candidates of a point do not grow
    with the number of nodes."""
    pitch = math.sqrt(area / rows) if rows and area > 0 else 0.0
    return min(8, max(1, 1 + math.ceil(math.log(limit_deg / pitch, 4)))) if pitch else 1


def snap_nearest(df: DataFrame, nodes: DataFrame, lat: str, lon: str, limit_deg: float, levels: int | None = None) -> DataFrame:
    """Nearest node within ``limit_deg``, else nulls; ``snap_m`` is the distance in metres.

    The grid is refined in steps of 4. A hit closer than the cell size is final, because the 3x3
    block covers that radius; only unresolved points look at the next coarser level, so dense areas
    never meet their coarse candidate lists.

    The index holds nine entries a node, which the optimizer's estimate of compressed files does not
    show: the counted nodes decide between a broadcast and a sort-merge join. There a point without a
    cell to look up gets a key of its own that meets nothing, or all of them would be one task's rows.
    """
    y, x = F.col(lat), F.col(lon)
    seen = nodes.agg(
        F.count("*").alias("n"),
        ((F.max("node_lat") - F.min("node_lat")) * (F.max("node_lon") - F.min("node_lon"))).alias("area")).first()
    levels = levels or snap_levels(seen["n"], seen["area"] or 0.0, limit_deg)
    held = seen["n"] * 9 * INDEX_ENTRY_BYTES <= BROADCAST_LIMIT_BYTES
    alone = -1 - F.pmod(F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")]), F.lit(1 << 40))
    out = spread(df, lat).withColumn("sn", F.lit(None).cast("struct<d:double,node_id:bigint,node_lat:double,node_lon:double>"))
    for step in reversed(range(levels)):
        size = limit_deg / (4**step)
        key = F.coalesce(F.when(F.col("sn").isNull(), geo.grid_cell(y, x, size)), alone)
        found = F.array_min(
            F.transform(
                "ix_nodes",
                lambda n: F.struct(
                    F.sqrt(F.pow(y - n["node_lat"], 2) + F.pow(x - n["node_lon"], 2)).alias("d"),
                    n["node_id"].cast("bigint").alias("node_id"), n["node_lat"].alias("node_lat"), n["node_lon"].alias("node_lon"),
                ),
            )
        )
        out = (
            out.withColumn("ix_cell", key)
            .join(node_index(nodes, size).hint("broadcast" if held else "merge"), "ix_cell", "left")
            .withColumn("hit", found)
            .withColumn("sn", F.coalesce("sn", F.when(F.col("hit.d") <= size, F.col("hit"))))
            .select(*df.columns, "sn")
        )
    return out.select(
        *df.columns,
        F.col("sn.node_id").alias("node_id"),
        F.col("sn.node_lat").alias("snap_lat"),
        F.col("sn.node_lon").alias("snap_lon"),
        (F.col("sn.d") * 111000.0).alias("snap_m"),
    )


def zone_overlap(zones: DataFrame) -> DataFrame:
    """Pairs of zones whose boxes share area, found through shared cells."""
    keyed = zones.select(
        F.struct("zone_id", "zone_name", "lat_min", "lat_max", "lon_min", "lon_max").alias("z"),
        F.explode(geo.covering_cells(F.col("lat_min"), F.col("lat_max"), F.col("lon_min"), F.col("lon_max"), INDEX_DEG)).alias("ix_cell"),
    )
    a, b = keyed.select(F.col("z").alias("a"), "ix_cell"), keyed.select(F.col("z").alias("b"), "ix_cell")
    high = F.least("a.lat_max", "b.lat_max") - F.greatest("a.lat_min", "b.lat_min")
    wide = F.least("a.lon_max", "b.lon_max") - F.greatest("a.lon_min", "b.lon_min")
    return (
        a.join(b, "ix_cell").where("a.zone_id < b.zone_id").select("a", "b").distinct()
        .withColumn("area_deg2", F.greatest(high, F.lit(0.0)) * F.greatest(wide, F.lit(0.0)))
        .where("area_deg2 > 1e-8")
        .select(
            F.col("a.zone_id").alias("zone_a"), F.col("b.zone_id").alias("zone_b"),
            geo.km2(F.col("area_deg2")).alias("overlap_km2"),
        )
    )


def zone_adjacency(lookup: DataFrame) -> DataFrame:
    """Directed pairs of zones with touching cells."""
    near = lookup.select(F.col("zone_id").alias("zone_a"), F.explode(geo.ring(F.col("cell"), 1)).alias("cell"))
    return (
        near.join(lookup.select("cell", F.col("zone_id").alias("zone_b")), "cell")
        .where("zone_a <> zone_b").select("zone_a", "zone_b").distinct()
    )


def nearest_territory(cells: DataFrame, zones: DataFrame, claimed: DataFrame) -> DataFrame:
    """Zone of the nearest centroid for every cell not yet claimed."""
    free = cells.join(claimed.select("cell"), "cell", "left_anti")
    near = with_nearest_centroid(free, zones, "cell_lat", "cell_lon")
    return near.select("cell", "cell_lat", "cell_lon", F.col("ix_near.zone_id").alias("zone_id"))


def box_cells(zones: DataFrame, size: float = geo.GRID_DEG) -> DataFrame:
    """All cells of the bounding box around all zones."""
    edge = zones.agg(
        F.min("lat_min").alias("a"), F.max("lat_max").alias("b"), F.min("lon_min").alias("c"), F.max("lon_max").alias("d")
    )
    cells = edge.select(F.explode(geo.covering_cells(F.col("a"), F.col("b"), F.col("c"), F.col("d"), size)).alias("cell"))
    lat, lon = geo.cell_center(F.col("cell"), size)
    return cells.select("cell", lat.alias("cell_lat"), lon.alias("cell_lon"))
