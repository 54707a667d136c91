"""Expressions over point arrays. A point is ``[lon, lat]`` in an ``array<array<double>>``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareline import constants as K
from fareline.functions import geo

POINTS = "array<array<double>>"


def parse_polyline(text: Column) -> Column:
    """JSON text to points; broken text gives null."""
    return F.from_json(text, POINTS)


def valid_points(points: Column) -> Column:
    """Only two-number points within the lat/lon range."""
    return F.filter(
        points,
        lambda p: (F.size(p) == 2) & F.get(p, 1).between(-90.0, 90.0) & F.get(p, 0).between(-180.0, 180.0),
    )


def parse_linestring(text: Column) -> Column:
    """``LINESTRING (lon lat, ...)`` to points."""
    body = F.regexp_extract(text, r"\((.*)\)", 1)
    return F.transform(F.split(body, r"\s*,\s*"), lambda s: F.transform(F.split(F.trim(s), r"\s+"), lambda x: x.cast("double")))


def to_linestring(points: Column) -> Column:
    return F.concat(
        F.lit("LINESTRING ("),
        F.array_join(F.transform(points, lambda p: F.concat_ws(" ", F.get(p, 0).cast("string"), F.get(p, 1).cast("string"))), ", "),
        F.lit(")"),
    )


def legs(points: Column, fn) -> Column:
    """Apply ``fn(a, b)`` to each pair of neighbours."""
    n = F.greatest(F.size(points) - 1, F.lit(0))
    return F.zip_with(F.slice(points, 1, n), F.slice(points, 2, n), fn)


def path_km(points: Column) -> Column:
    hops = legs(points, lambda a, b: geo.haversine_km(F.get(a, 1), F.get(a, 0), F.get(b, 1), F.get(b, 0)))
    return F.aggregate(hops, F.lit(0.0), lambda s, x: s + x)


def despike(points: Column, vmax: float, skip_repeats: bool = False, step_s: float = K.POINT_STEP_S) -> Column:
    """Drop points that would need more than ``vmax`` km/h from the last *kept* point. A fold,
    because the comparison point depends on earlier decisions."""

    def visit(kept, p):
        last = F.try_element_at(kept, F.lit(-1))
        kmh = geo.haversine_km(F.get(last, 1), F.get(last, 0), F.get(p, 1), F.get(p, 0)) / (step_s / 3600)
        good = kmh <= vmax
        if skip_repeats:
            good = good & ~((F.get(last, 0) == F.get(p, 0)) & (F.get(last, 1) == F.get(p, 1)))
        return F.when(good, F.concat(kept, F.array(p))).otherwise(kept)

    rest = F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0)))
    return F.aggregate(rest, F.slice(points, 1, 1), visit)


def bind(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once, however often ``fn`` uses it: lambda bodies and
    CASE branches are not searched for common parts."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def reversals(points: Column) -> Column:
    """Number of near U-turns between consecutive legs (cosine below -0.85)."""
    steps = legs(points, lambda a, b: F.array(F.get(b, 0) - F.get(a, 0), F.get(b, 1) - F.get(a, 1)))

    def sharp(u, v):
        dot = F.get(u, 0) * F.get(v, 0) + F.get(u, 1) * F.get(v, 1)
        norm = F.get(u, 2) * F.get(v, 2)
        return F.when((norm > 1e-12) & (dot / norm < -0.85), 1).otherwise(0)

    measured = F.transform(steps, lambda u: F.array(F.get(u, 0), F.get(u, 1), F.sqrt(F.get(u, 0) * F.get(u, 0) + F.get(u, 1) * F.get(u, 1))))
    return bind(measured, lambda m: F.aggregate(legs(m, sharp), F.lit(0), lambda s, x: s + x))


def route_verdict(points: Column, max_km: float = 60.0, min_points: int = 3) -> Column:
    """``ok`` or the first rule broken."""
    n = F.size(points)
    zigzag = reversals(points) / F.greatest(n - 2, F.lit(1)) > 0.30
    by_length = bind(path_km(points), lambda km: F.when(km < 0.05, "too_short").when(km > max_km, "too_long").when(zigzag, "zigzag").otherwise("ok"))
    return F.when(n < min_points, "too_few_points").otherwise(by_length)


def resample(points: Column, n: Column) -> Column:
    """``n`` points at equal index spacing, linearly blended between neighbours."""

    def at(k):
        pos = k * (F.size(points) - 1) / F.greatest(n - 1, F.lit(1))
        i0 = F.floor(pos).cast("int")
        i1 = F.least(i0 + 1, F.size(points) - 1)
        t = pos - i0
        a, b = F.try_element_at(points, i0 + 1), F.try_element_at(points, i1 + 1)
        return F.array(F.get(a, 0) * (1 - t) + F.get(b, 0) * t, F.get(a, 1) * (1 - t) + F.get(b, 1) * t)

    return F.transform(F.sequence(F.lit(0), n - 1), at)


def subsample(points: Column, n_inner: int) -> Column:
    """First, last and ``n_inner`` equally spaced points between (indexes cut to integers)."""
    m = F.least(F.lit(n_inner + 2), F.size(points))
    return F.transform(
        F.sequence(F.lit(0), m - 1),
        lambda k: F.try_element_at(points, F.floor(k * (F.size(points) - 1) / F.greatest(m - 1, F.lit(1))).cast("int") + 1),
    )


def replay_steps(points: Column, start: Column, lon_scale: float, lat_scale: float, lon_box: tuple, lat_box: tuple, outline: Column | None = None) -> Column:
    """Rebuild a path from a new start with scaled steps. A step leaving the box is mirrored; with an
    ``outline`` (closed ring) a step that still ends outside of it is not taken."""
    steps = legs(points, lambda a, b: F.array((F.get(b, 0) - F.get(a, 0)) * lon_scale, (F.get(b, 1) - F.get(a, 1)) * lat_scale))

    def visit(path, d):
        cur = F.try_element_at(path, F.lit(-1))
        lon, lat = F.get(cur, 0) + F.get(d, 0), F.get(cur, 1) + F.get(d, 1)
        lon = F.when(lon.between(*lon_box), lon).otherwise(F.get(cur, 0) - F.get(d, 0))
        lat = F.when(lat.between(*lat_box), lat).otherwise(F.get(cur, 1) - F.get(d, 1))
        if outline is not None:
            stay = ~geo.in_ring(lat, lon, outline)
            lon, lat = F.when(stay, F.get(cur, 0)).otherwise(lon), F.when(stay, F.get(cur, 1)).otherwise(lat)
        return F.concat(path, F.array(F.array(lon, lat)))

    return F.aggregate(steps, F.array(start), visit)
