"""Overlap, coverage and cells of shapes with holes and parts, against plain geometry."""

import math
import random

import pytest

from fareline.constants import CITY_REF_LAT, KM_PER_DEG
from fareline.functions import geo
from fareline.operators import polygons

KM2 = KM_PER_DEG**2 * math.cos(math.radians(CITY_REF_LAT))


def frame(spark, shapes):
    return spark.createDataFrame([(i, r) for i, rings in shapes.items() for r in rings], "zone_id int, ring array<array<double>>")


def star(rng, x, y, r, n):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    far = [r * rng.uniform(0.3, 1) for _ in turns]
    pts = [[x + d * math.cos(t), y + d * math.sin(t)] for d, t in zip(far, turns)]
    return [*pts, pts[0]]


def box(x0, y0, x1, y1):
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]


def area(ring):
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:]))) / 2


def clipped(ring, convex):
    """Sutherland-Hodgman: a ring cut by a convex one that turns left."""
    out = ring[:-1]
    for (ax, ay), (bx, by) in zip(convex, convex[1:]):
        side = lambda p: (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)
        new = []
        for p, q in zip(out, out[1:] + out[:1]):
            s, t = side(p), side(q)
            if s >= 0:
                new.append(p)
            if s * t < 0:
                new.append([p[0] + (q[0] - p[0]) * s / (s - t), p[1] + (q[1] - p[1]) * s / (s - t)])
        out = new
        if not out:
            return [[0, 0], [0, 0]]
    return [*out, out[0]]


def test_overlap_equals_clipping(spark):
    rng = random.Random(4)
    convex = {i: [[x + 0.05 * math.cos(t), y + 0.04 * math.sin(t)] for t in [k * math.pi / 4 for k in range(8)]] for i, (x, y) in enumerate([(-7.6, 33.5), (-7.55, 33.52), (-7.62, 33.56)])}
    convex = {i: [*r, r[0]] for i, r in convex.items()}
    stars = {10 + i: star(rng, -7.6 + rng.uniform(-0.05, 0.05), 33.52 + rng.uniform(-0.05, 0.05), 0.06, rng.randint(3, 20)) for i in range(12)}
    got = {(r.zone_a, r.zone_b): r.overlap_km2 for r in polygons.overlaps(frame(spark, {k: [r] for k, r in {**convex, **stars}.items()})).collect()}
    for a, c in convex.items():
        for b, s in stars.items():
            want = area(clipped(s, c))
            assert got.get((a, b), 0.0) / KM2 == pytest.approx(want, abs=1e-9 if want > 2e-8 else 2e-8)


def test_holes_parts_and_union(spark):
    outer, hole, island, far = box(-7.7, 33.5, -7.6, 33.6), box(-7.68, 33.52, -7.62, 33.58), box(-7.66, 33.54, -7.64, 33.56), box(-7.5, 33.5, -7.48, 33.51)
    shapes = {1: [outer, hole, island], 2: [box(-7.69, 33.51, -7.55, 33.55), far], 3: [box(-7.67, 33.53, -7.63, 33.57)], 4: [box(-7.6, 33.5, -7.5, 33.505)], 5: [None, [[-7.6, 33.5]], []]}
    one = 0.1 * 0.1 - 0.06 * 0.06 + 0.02 * 0.02
    # 1 and 2: the outer box cut, less the hole's part, plus the island's part.
    want = {(1, 2): 0.09 * 0.04 - 0.06 * 0.03 + 0.02 * 0.01, (1, 3): 0.02 * 0.02, (2, 3): 0.04 * 0.02}
    got = {(r.zone_a, r.zone_b): r.overlap_km2 / KM2 for r in polygons.overlaps(frame(spark, shapes)).collect()}
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-9)
    total = polygons.coverage(frame(spark, shapes)).collect()[0]
    two, three, four = 0.14 * 0.04 + 0.02 * 0.01, 0.04 * 0.04, 0.1 * 0.005
    three_in = 0.02 * 0.02 + 0.04 * 0.02 - 0.02 * 0.01  # of 3: in the island or in 2
    assert total.sum_km2 / KM2 == pytest.approx(one + two + three + four, abs=1e-9)
    assert total.covered_km2 / KM2 == pytest.approx(one + two + three + four - want[1, 2] - three_in, abs=1e-9)
    empty = frame(spark, shapes).limit(0)
    assert polygons.overlaps(empty).collect() == [] and polygons.polyfill(empty).collect() == []
    assert polygons.coverage(empty).collect()[0].covered_km2 == 0


def test_union_of_self_crossing_and_equal_shapes(spark):
    bow = [[-7.6, 33.5], [-7.5, 33.6], [-7.5, 33.5], [-7.6, 33.6], [-7.6, 33.5]]
    r = polygons.coverage(frame(spark, {1: [bow], 2: [bow], 3: [bow]})).collect()[0]
    assert r.covered_km2 / KM2 == pytest.approx(0.005, abs=1e-9) and r.sum_km2 / KM2 == pytest.approx(0.015, abs=1e-9)


def test_polyfill_equals_testing_each_centre(spark):
    rng, size = random.Random(9), geo.GRID_DEG
    shapes = {i: [star(rng, -7.6, 33.5, 0.1, rng.randint(3, 25)), star(rng, -7.6, 33.5, 0.04, 7)] for i in range(8)}
    shapes[20] = [box(-7.6 + size / 2, 33.5 + size / 2, -7.55 + size / 2, 33.55 + size / 2)]
    got = {(r.zone_id, r.cell) for r in polygons.polyfill(frame(spark, shapes)).collect()}
    want = set()
    for i, rings in shapes.items():
        for row in range(int((33.3 + 90) / size), int((33.7 + 90) / size)):
            for col in range(int((-7.8 + 180) / size), int((-7.4 + 180) / size)):
                y, x = (row + 0.5) * size - 90.0, (col + 0.5) * size - 180.0
                odd = False
                for r in rings:
                    for p, q in zip(r, r[1:]):
                        a, b = (p, q) if p[1] < q[1] else (q, p)
                        if a[1] <= y < b[1] and x < a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]):
                            odd = not odd
                if odd:
                    want.add((i, row * geo.CELL_STRIDE + col))
    assert got == want and len(got) > 1000
