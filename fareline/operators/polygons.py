"""Polygons with holes and parts: overlap, combined coverage, cells inside.

A shape is any number of closed rings of [lon, lat] points, one row each (zone_id, ring); a point is
inside if a ray from it meets an odd number of edges, so holes and separate parts need no marking.
Every step is keyed by grid cells: edges are cut at rows of cells, shapes meet only in cells that
both reach, and a cell's share of an area is exact.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.functions import geo

#: Side of the cells in which shapes meet, degrees; areas below LEAST_DEG2 are touching, not overlap.
MEET_DEG = 0.02
LEAST_DEG2 = 1e-8


def edges(rings: DataFrame) -> DataFrame:
    """(zone_id, xa, ya, xb, yb) with ya < yb; level edges enclose nothing and are left out. Rings that
    are null or have fewer than three points enclose nothing either."""
    n = F.size("ring")
    pairs = F.zip_with(F.slice("ring", 1, n - 1), F.slice("ring", 2, n - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    e = rings.where(n >= 3).select("zone_id", F.explode(pairs).alias("e")).select("zone_id", *(F.get(F.col(f"e.{k}"), i).cast("double").alias(f"{k}{i}") for k in "pq" for i in (0, 1)))
    up = F.col("p1") < F.col("q1")
    return e.where("p1 <> q1").select("zone_id", *(F.when(up, F.col(f"{a}{i}")).otherwise(F.col(f"{b}{i}")).alias(f"{n}{s}") for a, b, s in (("p", "q", "a"), ("q", "p", "b")) for i, n in ((0, "x"), (1, "y"))))


def _x_at(y: Column) -> Column:
    return F.col("xa") + (y - F.col("ya")) * (F.col("xb") - F.col("xa")) / (F.col("yb") - F.col("ya"))


def shape_cells(rings: DataFrame, size: float = MEET_DEG) -> DataFrame:
    """(cell, x0, x1, zone_id, edges) for every cell a shape reaches: the shape's edges inside the
    cell's row. Edges beside the cell stay, since they decide what is inside it."""
    row = F.explode(F.sequence(geo.grid_index(F.col("ya"), size, 90.0), geo.grid_index(F.col("yb"), size, 90.0)))
    cut = edges(rings).withColumn("row", row)
    low, high = F.greatest("ya", F.col("row") * size - 90.0), F.least("yb", (F.col("row") + 1) * size - 90.0)
    cut = cut.withColumn("y0", low).withColumn("y1", high).where("y0 < y1")
    cut = cut.select("zone_id", "row", F.array(_x_at(F.col("y0")), "y0", _x_at(F.col("y1")), "y1").alias("e"))
    strips = cut.groupBy("zone_id", "row").agg(F.collect_list("e").alias("edges"), F.min(F.least(F.col("e")[0], F.col("e")[2])).alias("w"), F.max(F.greatest(F.col("e")[0], F.col("e")[2])).alias("o"))
    col = F.explode(F.sequence(geo.grid_index(F.col("w"), size, 180.0), geo.grid_index(F.col("o"), size, 180.0)))
    cells = strips.withColumn("col", col)
    return cells.select((F.col("row") * geo.CELL_STRIDE + F.col("col")).alias("cell"), (F.col("col") * size - 180.0).alias("x0"), ((F.col("col") + 1) * size - 180.0).alias("x1"), "zone_id", "edges")


def covered_area(edge: np.ndarray, owner: np.ndarray, x0: float, x1: float, every: bool) -> float:
    """Area between x0 and x1 that lies in all owners' shapes (`every`) or in any, in square units.

    edge: (n, 4) of xa, ya, xb, yb with ya < yb. Between two heights at which an edge begins, ends,
    leaves the cell or meets another edge, all widths change linearly: their middle gives the area."""
    xa, ya, xb, yb = edge.T
    slope = (xb - xa) / (yb - ya)
    with np.errstate(divide="ignore", invalid="ignore"):
        sides = np.concatenate([ya + (x - xa) / slope for x in (x0, x1)])
    inner = np.isfinite(sides) & (sides > np.tile(ya, 2)) & (sides < np.tile(yb, 2))
    heights, total = np.unique(np.concatenate([ya, yb, sides[inner]])), 0.0
    kinds = int(owner.max()) + 1
    for lo, hi in zip(heights, heights[1:]):
        own = np.flatnonzero((ya <= lo) & (yb >= hi))
        if not len(own):
            continue
        left, right = (xa[own] + (y - ya[own]) * slope[own] for y in (lo, hi))
        cuts = np.array([lo, hi])
        order = np.lexsort((right, left))
        if (np.diff(right[order]) < 0).any():
            i, j = np.triu_indices(len(own), 1)
            d0, d1 = left[i] - left[j], right[i] - right[j]
            cross = d0 * d1 < 0
            cuts = np.unique(np.r_[cuts, lo + (hi - lo) * d0[cross] / (d0[cross] - d1[cross])])
        for a, b in zip(cuts, cuts[1:]):
            x = np.clip(xa[own] + ((a + b) / 2 - ya[own]) * slope[own], x0, x1)
            by_x = np.argsort(x, kind="stable")
            odd = np.cumsum(owner[own][by_x][:, None] == np.arange(kinds), axis=0) % 2 == 1
            hit = odd.all(axis=1) if every else odd.any(axis=1)
            total += (b - a) * (np.diff(x[by_x]) * hit[:-1]).sum()
    return total


def _areas(groups: DataFrame, every: bool) -> DataFrame:
    """Adds `deg2` to rows (x0, x1, shapes): shapes is a list of edge lists."""
    names = [c for c in groups.columns if c != "shapes"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in groups.schema if f.name != "shapes") + ", deg2 double"

    def run(batches):
        for batch in batches:
            out = []
            x0, x1 = (batch.column(c).to_pylist() for c in ("x0", "x1"))
            for i, shapes in enumerate(batch.column("shapes")):
                own = [np.array(s, np.float64).reshape(-1, 4) for s in shapes.as_py()]
                out.append(covered_area(np.concatenate(own), np.repeat(np.arange(len(own)), [len(s) for s in own]), x0[i], x1[i], every))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out, pa.float64())], [*names, "deg2"])

    return groups.mapInArrow(run, schema)


def overlaps(rings: DataFrame, size: float = MEET_DEG) -> DataFrame:
    """(zone_a, zone_b, overlap_km2) of the pairs whose shapes share more than LEAST_DEG2."""
    cells = shape_cells(rings, size)
    side = lambda k: cells.select("cell", "x0", "x1", F.col("zone_id").alias(f"zone_{k}"), F.col("edges").alias(k))
    met = side("a").join(side("b").drop("x0", "x1"), "cell").where("zone_a < zone_b")
    parts = _areas(met.select("zone_a", "zone_b", "x0", "x1", F.array("a", "b").alias("shapes")), True)
    return parts.groupBy("zone_a", "zone_b").agg(F.sum("deg2").alias("deg2")).where(F.col("deg2") > LEAST_DEG2).select("zone_a", "zone_b", geo.km2(F.col("deg2")).alias("overlap_km2"))


def coverage(rings: DataFrame, size: float = MEET_DEG) -> DataFrame:
    """One row (cells, sum_km2, covered_km2): the shapes' own areas, and that of their union. A cell
    needs its shapes together; no more of a shape than its edges in the cell's row."""
    cells = shape_cells(rings, size)
    alone = cells.select("x0", "x1", F.array("edges").alias("shapes"), F.lit(False).alias("whole"))
    met = cells.groupBy("cell").agg(F.first("x0").alias("x0"), F.first("x1").alias("x1"), F.collect_list("edges").alias("shapes"))
    parts = _areas(alone.unionByName(met.select("x0", "x1", "shapes", F.lit(True).alias("whole"))), False)
    total = lambda whole: geo.km2(F.coalesce(F.sum(F.when(F.col("whole") == whole, F.col("deg2"))), F.lit(0.0)))
    return parts.agg(F.count_if("whole").alias("cells"), total(False).alias("sum_km2"), total(True).alias("covered_km2"))


def polyfill(rings: DataFrame, size: float = geo.GRID_DEG) -> DataFrame:
    """(zone_id, cell, cell_lat, cell_lon) of the cells whose centre lies in a shape.

    Each row of cells is one scan line: the edges that cross it, sorted, bound the spans inside; a
    centre on a span's west end is in, on its east end out."""
    row = F.explode(F.sequence(geo.grid_index(F.col("ya"), size, 90.0), geo.grid_index(F.col("yb"), size, 90.0)))
    lines = edges(rings).withColumn("row", row).withColumn("y", (F.col("row") + 0.5) * size - 90.0).where("ya <= y AND y < yb")
    spans = lines.groupBy("zone_id", "row", "y").agg(F.sort_array(F.collect_list(_x_at(F.col("y")))).alias("x"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.floor(F.size("x") / 2).cast("int") - 1), lambda k: F.struct(F.get("x", 2 * k).alias("w"), F.get("x", 2 * k + 1).alias("o"))))
    spans = spans.select("zone_id", "row", pair.alias("s"))
    # Rounding may move a border cell by one: take one more on both sides and test the centre itself.
    col = F.explode(F.sequence(geo.grid_index(F.col("s.w"), size, 180.0) - 1, geo.grid_index(F.col("s.o"), size, 180.0) + 1))
    cells = spans.withColumn("col", col).withColumn("cell_lon", (F.col("col") + 0.5) * size - 180.0).where("s.w <= cell_lon AND cell_lon < s.o")
    return cells.select("zone_id", (F.col("row") * geo.CELL_STRIDE + F.col("col")).alias("cell"), ((F.col("row") + 0.5) * size - 90.0).alias("cell_lat"), "cell_lon")
