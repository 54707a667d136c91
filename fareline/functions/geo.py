"""Coordinate, distance and grid expressions. All take and return Columns and stay JVM-side."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareline import constants as K

GRID_DEG = 0.005
#: Cell ids are ``row * CELL_STRIDE + col``; neighbours are plain arithmetic on the id.
CELL_STRIDE = 1_000_000


def remap(value: Column, src: tuple, dst: tuple) -> Column:
    """Linear map of one range onto another; values beyond the source range stick to its edge."""
    ratio = (value - F.lit(src[0])) / F.lit(src[1] - src[0])
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), ratio)) * F.lit(dst[1] - dst[0]) + F.lit(dst[0])


def affine(value: Column, src: tuple, dst: tuple) -> Column:
    """Scale-and-shift without clamping."""
    scale = (dst[1] - dst[0]) / (src[1] - src[0])
    return value * F.lit(scale) + F.lit(dst[0] - src[0] * scale)


def rotate(lat: Column, lon: Column, degrees: float, lat_box: tuple, lon_box: tuple) -> tuple[Column, Column]:
    """Rotate about the centre of a box."""
    mid_lat, mid_lon = (lat_box[0] + lat_box[1]) / 2, (lon_box[0] + lon_box[1]) / 2
    turn = F.radians(F.lit(degrees))
    dy, dx = lat - mid_lat, lon - mid_lon
    return F.cos(turn) * dy - F.sin(turn) * dx + mid_lat, F.sin(turn) * dy + F.cos(turn) * dx + mid_lon


def _half_chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    sy = F.sin(F.radians(lat2 - lat1) / 2)
    sx = F.sin(F.radians(lon2 - lon1) / 2)
    return sy * sy + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * sx * sx


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.lit(2 * K.EARTH_KM) * F.asin(F.sqrt(_half_chord(lat1, lon1, lat2, lon2)))


def haversine_atan_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    h = _half_chord(lat1, lon1, lat2, lon2)
    return F.lit(2 * K.EARTH_KM) * F.atan2(F.sqrt(h), F.sqrt(F.lit(1.0) - h))


def sphcos_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Spherical law of cosines, argument clamped from above only."""
    cosine = (
        F.sin(F.radians(lat1)) * F.sin(F.radians(lat2))
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(F.radians(lon2) - F.radians(lon1))
    )
    return F.lit(K.EARTH_KM) * F.acos(F.least(F.lit(1.0), cosine))


def flat_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Degrees times 111 km, the cheap form used for short snap distances."""
    return F.sqrt(F.pow(lat1 - lat2, 2) + F.pow(lon1 - lon2, 2)) * K.KM_PER_DEG


def inside(lat: Column, lon: Column, lat_box: tuple, lon_box: tuple) -> Column:
    return lat.between(*lat_box) & lon.between(*lon_box)


def grid_index(value: Column, size: float, origin: float) -> Column:
    return F.floor((value + F.lit(origin)) / F.lit(size))


def grid_cell(lat: Column, lon: Column, size: float = GRID_DEG) -> Column:
    """Id of the fixed-size grid cell holding a point."""
    return grid_index(lat, size, 90.0) * CELL_STRIDE + grid_index(lon, size, 180.0)


def cell_center(cell: Column, size: float = GRID_DEG) -> tuple[Column, Column]:
    row = F.floor(cell / F.lit(float(CELL_STRIDE)))
    col = cell % CELL_STRIDE
    return (row + 0.5) * size - 90.0, (col + 0.5) * size - 180.0


def ring(cell: Column, k: int) -> Column:
    """Array of the cells at exactly ``k`` steps (square ring)."""
    if k == 0:
        return F.array(cell)
    steps = [(r, c) for r in range(-k, k + 1) for c in range(-k, k + 1) if max(abs(r), abs(c)) == k]
    return F.array(*[cell + F.lit(r * CELL_STRIDE + c) for r, c in steps])


def parent_cell(cell: Column, factor: int) -> Column:
    """Cell of a grid ``factor`` times coarser."""
    row = F.floor(F.floor(cell / F.lit(float(CELL_STRIDE))) / F.lit(float(factor)))
    col = F.floor((cell % CELL_STRIDE) / F.lit(float(factor)))
    return row * CELL_STRIDE + col


def covering_cells(lat_min: Column, lat_max: Column, lon_min: Column, lon_max: Column, size: float) -> Column:
    """Array of all grid cells a box touches."""
    rows = F.sequence(grid_index(lat_min, size, 90.0), grid_index(lat_max, size, 90.0))
    cols = F.sequence(grid_index(lon_min, size, 180.0), grid_index(lon_max, size, 180.0))
    return F.flatten(F.transform(rows, lambda r: F.transform(cols, lambda c: r * CELL_STRIDE + c)))


def hash32(text: Column) -> Column:
    """First 32 bits of md5 as a long; the same on every engine and on every run."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def privacy_point(key: Column, clat: Column, clon: Column, box: tuple[Column, Column, Column, Column]):
    """Zone centre plus a stable offset per vehicle, kept inside the zone box."""
    h = hash32(key)
    angle = F.radians((h % 360).cast("double"))
    radius = F.lit(0.0008) + (h % 1000) / F.lit(1000000.0)
    lat = clat + radius * F.cos(angle)
    lon = clon + radius * F.sin(angle)
    return (
        F.greatest(box[0], F.least(box[1], lat)),
        F.greatest(box[2], F.least(box[3], lon)),
    )


def ring_area(points: Column) -> Column:
    """Shoelace area of a closed ring of [lon, lat] points, square degrees."""
    n = F.size(points)
    crossed = F.zip_with(
        F.slice(points, 1, n - 1),
        F.slice(points, 2, n - 1),
        lambda a, b: F.get(a, 0) * F.get(b, 1) - F.get(b, 0) * F.get(a, 1),
    )
    return F.abs(F.aggregate(crossed, F.lit(0.0), lambda s, x: s + x)) / 2


def ring_centroid(points: Column) -> tuple[Column, Column]:
    """(lat, lon) of the area centroid of a closed ring."""
    n = F.size(points)
    a, b = F.slice(points, 1, n - 1), F.slice(points, 2, n - 1)

    def total(term):
        return F.aggregate(F.zip_with(a, b, term), F.lit(0.0), lambda s, x: s + x)

    twice = total(lambda p, q: F.get(p, 0) * F.get(q, 1) - F.get(q, 0) * F.get(p, 1))
    lon = total(lambda p, q: (F.get(p, 0) + F.get(q, 0)) * (F.get(p, 0) * F.get(q, 1) - F.get(q, 0) * F.get(p, 1)))
    lat = total(lambda p, q: (F.get(p, 1) + F.get(q, 1)) * (F.get(p, 0) * F.get(q, 1) - F.get(q, 0) * F.get(p, 1)))
    return lat / (twice * 3), lon / (twice * 3)


def in_ring(lat: Column, lon: Column, points: Column) -> Column:
    """Ray cast: odd number of edges crossed to the east of the point."""
    n = F.size(points)

    def crosses(p, q):
        spans = (F.get(p, 1) > lat) != (F.get(q, 1) > lat)
        return F.when(spans, lon < (F.get(q, 0) - F.get(p, 0)) * (lat - F.get(p, 1)) / (F.get(q, 1) - F.get(p, 1)) + F.get(p, 0)).otherwise(F.lit(False))

    hits = F.zip_with(F.slice(points, 1, n - 1), F.slice(points, 2, n - 1), crosses)
    return F.size(F.filter(hits, lambda h: h)) % 2 == 1


def km2(area_deg2: Column, ref_lat: Column | float = K.CITY_REF_LAT) -> Column:
    ref = F.lit(ref_lat) if not isinstance(ref_lat, Column) else ref_lat
    return area_deg2 * (K.KM_PER_DEG**2) * F.cos(F.radians(ref))


def coast_min_lon(lat: Column, line=K.COAST) -> Column:
    """Piecewise-linear western land limit at a latitude; flat beyond both ends."""
    out = F.when(lat <= line[0][0], F.lit(line[0][1]))
    for (y0, x0), (y1, x1) in zip(line, line[1:]):
        out = out.when(lat <= y1, F.lit(x0) + (lat - y0) * ((x1 - x0) / (y1 - y0)))
    return out.otherwise(F.lit(line[-1][1]))


def is_on_land(lat: Column, lon: Column, line=K.COAST) -> Column:
    return lon > coast_min_lon(lat, line)


def coast_bonus(lon: Column, alpha: float = K.COAST_ALPHA, coast_lon: float = K.COAST_LON) -> Column:
    return F.lit(1.0) + F.lit(alpha) / (F.lit(1.0) + F.abs(lon - coast_lon))
