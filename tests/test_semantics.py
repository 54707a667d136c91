"""Hand-made frames for the edge cases the generated tables do not pin down."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareline.functions import draws, geo, paths, pricing, timeparts
from fareline.operators import common, features, gps, kpi, matching, quality, spatial, synth, trips
from fareline.operators import zonefeatures as zf
from fareline.sources import readers, sinks

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def zones(spark):
    rows = [
        (1, "a", 33.50, 33.56, -7.70, -7.62, 33.53, -7.66, 100, "A", "2, x,3"),
        (2, "b", 33.54, 33.60, -7.66, -7.58, 33.57, -7.62, 200, "A", ""),
        (3, "c", 33.62, 33.66, -7.58, -7.52, 33.64, -7.55, 300, "B", "1"),
    ]
    return spark.createDataFrame(
        rows, "zone_id int, zone_name string, lat_min double, lat_max double, lon_min double, lon_max double,"
        " centroid_lat double, centroid_lon double, population int, ae_class string, adjacent_zones string")


def one(df):
    return df.collect()[0]


def test_tie_modes_and_gap(spark):
    pts = spark.createDataFrame([("both", 33.55, -7.65), ("none", 33.46, -7.50), ("edge", 33.50, -7.70)], "id string, lat double, lon double")
    z = zones(spark)
    got = {m: {(r.id, r.zone) for r in spatial.assign_box_zone(pts, z, "lat", "lon", m).collect()} for m in ("all", "first", "last")}
    assert got["all"] == {("both", 1), ("both", 2), ("none", None), ("edge", 1)}
    assert got["first"] == {("both", 1), ("none", None), ("edge", 1)}
    assert got["last"] == {("both", 2), ("none", None), ("edge", 1)}
    near = {r.id: r.zone for r in spatial.assign_box_zone(pts, z, "lat", "lon", fallback="degrees").collect()}
    assert near == {"both": 1, "none": 2, "edge": 1}


def test_dedupe_runs_before_validation(spark):
    rows = [("t", at(10), 1, 500.0), ("t", at(5), 2, 10.0), ("t", at(10), 3, 10.0), ("t", at(11), 4, 10.0)]
    df = spark.createDataFrame(rows, "taxi_id string, event_time timestamp, event_id long, speed_kmh double").withColumn("arrival", F.timestamp_seconds(F.col("event_id")))
    assert [r.event_id for r in gps.strictly_increasing(df).orderBy("event_id").collect()] == [1, 4]


def test_dedupe_is_exact_for_a_hot_key(spark):
    rnd = random.Random(1)
    rows = [(("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(9)}"), rnd.randrange(5000), i, rnd.randrange(4000)) for i in range(3000)]
    df = spark.createDataFrame(rows, "taxi_id string, e long, event_id long, a long").select(
        "taxi_id", "event_id", F.timestamp_seconds("e").alias("event_time"), F.timestamp_seconds("a").alias("arrival"))
    best, want = {}, []
    for k, e, i, a in sorted(rows, key=lambda r: (r[3], r[2])):
        if k not in best or e > best[k]:
            want.append(i)
        best[k] = max(best.get(k, e), e)
    assert sorted(r.event_id for r in gps.strictly_increasing(df).collect()) == sorted(want)


def test_speed_limits(spark):
    rows = [(None,), (-0.1,), (0.0,), (150.0,), (150.1,)]
    df = spark.createDataFrame(rows, "s double").select(
        "s", gps.is_valid(F.lit(33.5), F.lit(-7.6), F.col("s"), F.lit(None).cast("double"), F.lit(1)).alias("ok"))
    assert [r.ok for r in df.collect()] == [True, False, True, True, False]


def test_calendar_and_row_lag_differ_on_a_missing_date(spark):
    days = [d for d in range(12) if d != 6]
    rows = [(1, dt.date(2024, 1, 1 + d), 10, 100 + d, 1, 0, 0, 5) for d in days]
    s = spark.createDataFrame(rows, "origin_zone int, trip_date date, slot_of_day int, demand long, supply long, day_of_week int, is_weekend int, hour_of_day int")
    row = {r.trip_date.day: r.demand_lag_7d for r in features.build_features(s).collect()}
    cal = {r.trip_date.day: r.demand_lag_7d for r in features.build_features(s, calendar_lag=True).collect()}
    assert row[12] == 103 and cal[12] == 104
    assert 9 in row and 9 in cal


def test_polylines(spark):
    rows = [("[]",), ("",), ("[[oops",), ("[[-8.6, 41.1]]",), ("[[-8.6, 41.1], [-8.6, 41.101], [-8.0, 41.2], [-8.6, 41.102]]",)]
    df = spark.createDataFrame(rows, "POLYLINE string")
    p = trips.with_points(df)
    kept = p.where(F.size("points") >= 2).select(F.size(paths.despike(F.col("points"), 150.0)).alias("n")).collect()
    assert [r.n for r in kept] == [3]


def test_route_verdicts(spark):
    rows = [
        ([[0.0, 0.0], [0.0, 0.001]],), ([[0.0, 0.0], [0.0, 0.0001], [0.0, 0.0002]],), ([[0.0, 0.0], [1.0, 0.0], [2.0, 0.0]],),
        ([[0.0, 0.0], [0.01, 0.0], [0.0, 0.0], [0.01, 0.0]],), ([[0.0, 0.0], [0.01, 0.0], [0.02, 0.0]],)]
    df = spark.createDataFrame(rows, "points array<array<double>>")
    assert [r.v for r in df.select(paths.route_verdict(F.col("points")).alias("v")).collect()] == ["too_few_points", "too_short", "too_long", "zigzag", "ok"]


def test_fares(spark):
    df = spark.createDataFrame([(2.0, 10, "petit", 1), (1.0, 10, "petit", 1), (5.0, 23, "petit", 2), (8.0, 13, "grand", 1), (0.1, 5, "grand", 3)], "km double, h int, f string, p int")
    got = [round(r.x, 2) for r in df.select(pricing.two_fleet_fare(F.col("km"), F.col("h"), F.col("f"), F.col("p")).alias("x")).collect()]
    assert got == [10.6, 10.0, 20.5, 37.6, 25.0]
    d = one(spark.range(1).select(pricing.live_fare(F.lit(0.2)).alias("a"), pricing.pickup_eta_s(F.lit(0.1)).alias("b"), pricing.pickup_eta_s(F.lit(2.0)).alias("c")))
    assert (d.a, d.b, d.c) == (13.0, 60, 240)


def brute_match(reqs, pings, neighbours, ttl_ms=60000):
    """Per (trip, zone): vehicles alive at the instant, best by (idle, id)."""
    out = {}
    for trip, zone, t in reqs:
        for z in [zone, *neighbours.get(zone, [])]:
            state = {}
            for taxi, pz, pt, speed in sorted(pings, key=lambda p: p[2]):
                if pz == z and pt <= t:
                    state[taxi] = (pt, speed)
            live = [(int(s < 5), taxi) for taxi, (pt, s) in state.items() if t - pt < ttl_ms]
            out[trip, z] = (len(live), min(live)[1] if live else None)
    return out


def _match_frames(spark, n_req=60, n_ping=600, seed=3):
    rnd = random.Random(seed)
    pings = {}
    for _ in range(n_ping):
        z = 1 if rnd.random() < 0.6 else rnd.choice([2, 3])
        key = (f"t{rnd.randrange(25):02d}", z, rnd.randrange(0, 600_000))
        pings[key] = rnd.choice([0.0, 4.9, 5.0, 40.0])
    pings = [(a, z, t, s) for (a, z, t), s in pings.items()]
    reqs = [(f"r{i}", rnd.choice([1, 1, 2, 3]), rnd.randrange(0, 660_000)) for i in range(n_req)]
    p = spark.createDataFrame(pings, "taxi_id string, zone_id int, ms long, speed_kmh double").select(
        "taxi_id", "zone_id", "speed_kmh", F.lit("moving").alias("status"), F.timestamp_millis("ms").alias("event_time"))
    r = spark.createDataFrame(reqs, "trip_id string, origin_zone int, ms long").select(
        "trip_id", F.lit("x").alias("rider_id"), "origin_zone", F.lit(33.53).alias("origin_lat"), F.lit(-7.66).alias("origin_lon"),
        F.lit(33.6).alias("dest_lat"), F.lit(-7.6).alias("dest_lon"), F.timestamp_millis("ms").alias("event_time"))
    return p, r, pings, reqs


def test_match_candidates_against_brute_force(spark):
    p, r, pings, reqs = _match_frames(spark)
    want = brute_match(reqs, pings, {1: [2, 3], 3: [1]})
    got = {(x.trip_id, x.zone_id): (x.candidates, x.taxi_id) for x in matching.match_candidates(r, p, zones(spark)).collect()}
    assert got == want
    best = matching.match_best(matching.match_candidates(r, p, zones(spark)))
    assert best.count() == len(reqs)


@pytest.mark.parametrize("ttl_s", [120, 600])
def test_match_candidates_with_longer_lifetimes(spark, ttl_s):
    p, r, pings, reqs = _match_frames(spark, n_ping=40, seed=8)
    want = brute_match(reqs, pings, {1: [2, 3], 3: [1]}, ttl_s * 1000)
    assert {(x.trip_id, x.zone_id): (x.candidates, x.taxi_id) for x in matching.match_candidates(r, p, zones(spark), ttl_s).collect()} == want


@pytest.mark.parametrize("slice_s", [60, 240, 3600])
def test_exclusive_matching_does_not_depend_on_slices(spark, slice_s):
    p, r, pings, reqs = _match_frames(spark, n_req=80, n_ping=150, seed=5)
    got = {(x.trip_id, x.zone_id, x.taxi_id, x.ping_ms) for x in matching.match_exclusive(r, p, zones(spark), slice_s=slice_s).collect()}
    order = {x.trip_id: x.h for x in r.select("trip_id", F.xxhash64("trip_id").alias("h")).collect()}
    used, want, near = set(), set(), {1: [2, 3], 3: [1]}
    for trip, zone, t in sorted(reqs, key=lambda q: (q[2], order[q[0]])):
        for z in [zone, *near.get(zone, [])]:
            state = {}
            for taxi, pz, pt, speed in sorted(pings, key=lambda q: q[2]):
                if pz == z and pt <= t:
                    state[taxi] = (pt, int(speed < 5))
            free = [(i, taxi, pt) for taxi, (pt, i) in state.items() if t - pt < 60000 and (z, taxi, pt) not in used]
            if free:
                _, taxi, pt = min(free)
                used.add((z, taxi, pt))
                want.add((trip, z, taxi, pt))
                break
    assert got == want


def test_vehicle_that_changed_zone_stays_until_it_expires(spark):
    p = spark.createDataFrame([("t1", 1, at(0), 20.0), ("t1", 2, at(10), 20.0)], "taxi_id string, zone_id int, event_time timestamp, speed_kmh double").withColumn("status", F.lit("moving"))
    r = spark.createDataFrame([("a", "x", 1, 33.53, -7.66, 33.6, -7.6, at(30))], "trip_id string, rider_id string, origin_zone int, origin_lat double, origin_lon double, dest_lat double, dest_lon double, event_time timestamp")
    got = {x.zone_id: x.taxi_id for x in matching.match_candidates(r, p, zones(spark)).collect()}
    assert got == {1: "t1", 2: "t1", 3: None}


def test_snap_levels_agree_with_brute_force(spark):
    rnd = random.Random(4)
    nodes = [(i, 33.5 + rnd.random() * 0.02, -7.6 + rnd.random() * 0.02) for i in range(300)] + [(999, 33.55, -7.55)]
    pts = [(i, 33.495 + rnd.random() * 0.06, -7.605 + rnd.random() * 0.06) for i in range(200)]
    n = spark.createDataFrame(nodes, "node_id long, node_lat double, node_lon double")
    p = spark.createDataFrame(pts, "id long, lat double, lon double")
    got = {r.id: r.node_id for r in spatial.snap_nearest(p, n, "lat", "lon", 0.003).collect()}
    for i, la, lo in pts:
        d, node = min((((la - y) ** 2 + (lo - x) ** 2) ** 0.5, k) for k, y, x in nodes)
        assert got[i] == (node if d <= 0.003 else None)


def test_percentiles_with_outliers_and_hot_values(spark):
    rnd = random.Random(2)
    xs = [rnd.random() for _ in range(2000)] + [0.5] * 1500 + [1e12, -1e12]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = {r.p: r.value for r in common.percentiles(df, "x", [0.0, 0.05, 0.5, 0.95, 1.0]).collect()}
    s = sorted(xs)
    for p, v in got.items():
        pos = p * (len(s) - 1)
        lo = int(pos)
        hi = min(lo + 1, len(s) - 1)
        assert v == pytest.approx(s[lo] + (s[hi] - s[lo]) * (pos - lo), rel=1e-12)


def test_global_positions(spark):
    rows = [(f"t{i}", i % 7 if i % 3 else 3) for i in range(500)]
    df = spark.createDataFrame(rows, "trip_id string, s long").select("trip_id", F.timestamp_seconds("s").alias("event_time"))
    got = common.ranked(df, "event_time", "trip_id").withColumn("h", geo.hash32(F.col("trip_id"))).collect()
    want = sorted(got, key=lambda r: (r.event_time, r.h, r.trip_id))
    assert [r.position for r in want] == list(range(500))


def test_gini(spark):
    df = spark.createDataFrame([(1,)] * 10 + [(2,)] * 10 + [(3,)] * 10, "k int")
    assert one(quality.gini(df, "k")).gini == pytest.approx(0.0)
    xs = sorted([1, 2, 2, 5, 40])
    df = spark.createDataFrame([(i,) for i, x in enumerate(xs) for _ in range(x)], "k int")
    cum = [sum(xs[: i + 1]) for i in range(len(xs))]
    assert one(quality.gini(df, "k")).gini == pytest.approx(1 - 2 * sum(cum) / (len(xs) * sum(xs)) + 1 / len(xs))


def test_constant_metric_scores_half(spark):
    f = spark.createDataFrame([(1, "a", 3.0, 1.0, 5, 2), (2, "b", 3.0, 2.0, 9, 2)],
                              "zone_id int, zone_name string, commerce_weight_sum double, pop_density double, poi_diversity int, transit_hub_count int")
    got = {r.zone_id: (r.commerce_n, r.transit_n, r.ae_score) for r in zf.activity_score(f).collect()}
    assert got[1] == (0.5, 0.5, 0.2) and got[2] == (0.5, 0.5, 0.8)


def test_demand_ratio_without_vehicles(spark):
    p = spark.createDataFrame([], "zone_id int, taxi_id string, event_time timestamp")
    r = spark.createDataFrame([(1, at(1)), (1, at(2)), (1, at(31))], "zone_id int, event_time timestamp")
    rows = gps.demand_window(p, r).orderBy("window_start").collect()
    assert [(x.unique_vehicles, x.pending_requests, x.ratio) for x in rows] == [(0, 2, 2.0), (0, 1, 1.0)]


def test_upsert_and_insert_absent(spark, tmp_path):
    a = spark.createDataFrame([(1, "x", 1), (1, "y", 1), (2, "z", 1)], "p int, k string, v int")
    b = spark.createDataFrame([(1, "x", 3), (1, "y", 0), (3, "w", 1)], "p int, k string, v int")
    path = str(tmp_path / "up")
    sinks.upsert(a, path, ["p", "k"], "p", "v")
    sinks.upsert(b, path, ["p", "k"], "p", "v")
    sinks.upsert(b, path, ["p", "k"], "p", "v")
    assert {(r.p, r.k, r.v) for r in spark.read.parquet(path).collect()} == {(1, "x", 3), (1, "y", 1), (2, "z", 1), (3, "w", 1)}
    path = str(tmp_path / "ins")
    for df in (a, b, b):
        sinks.insert_absent(df, path, ["k"], [F.col("v")])
    assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == {("x", 1), ("y", 1), ("z", 1), ("w", 1)}


def test_enrich_can_require_a_match(spark):
    dim = spark.createDataFrame([(1, "a")], "k int, n string")
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert common.enrich(df, dim, "k").count() == 2
    with pytest.raises(Exception, match="no k row for 2"):
        common.enrich(df, dim, "k", require=True).collect()


def test_symmetric_edges_and_digit_filter(spark):
    assert {(r.zone_id, r.neighbour) for r in zf.zone_edges(zones(spark)).collect()} == {(1, 2), (1, 3), (3, 1)}
    assert {(r.zone_id, r.neighbour) for r in zf.zone_edges(zones(spark), symmetric=True).collect()} == {(1, 2), (1, 3), (3, 1), (2, 1)}


def test_both_zone_layouts_load(spark, tmp_path):
    v3, v4 = str(tmp_path / "v3"), str(tmp_path / "v4")
    z = zones(spark)
    sinks.write_csv(z.select("zone_id", F.col("zone_name").alias("arrondissement_name"), F.col("centroid_lat").alias("casa_centroid_lat"), F.col("centroid_lon").alias("casa_centroid_lon")), v3)
    sinks.write_csv(z.select("zone_id", F.col("zone_name").alias("name"), "centroid_lat", "centroid_lon"), v4)
    assert readers.read_zones(spark, v3).select("zone_id", "zone_name", "centroid_lat").orderBy("zone_id").collect() == readers.read_zones(
        spark, v4).select("zone_id", "zone_name", "centroid_lat").orderBy("zone_id").collect()


def test_weekday_numberings(spark):
    r = one(spark.sql("SELECT TIMESTAMP '2024-01-07 12:30:00' AS t").select(
        F.weekday("t").alias("a"), F.dayofweek("t").alias("b"), timeparts.slot_of_day(F.col("t")).alias("c"), timeparts.is_weekend(F.col("t")).alias("d")))
    assert (r.a, r.b, r.c, r.d) == (6, 1, 25, 1)


def test_draws_do_not_depend_on_partitioning(spark):
    def run(n):
        df = spark.range(2000).repartition(n).select("id", draws.uniform(F.col("id"), "s", 1).alias("u"), draws.gaussian(F.col("id"), "g", 1).alias("g"))
        return df.orderBy("id").collect()

    a, b = run(1), run(13)
    assert a == b
    us, gs = [r.u for r in a], [r.g for r in a]
    assert abs(sum(us) / len(us) - 0.5) < 0.03 and abs(sum(gs) / len(gs)) < 0.1


def test_every_row_gets_exactly_one_draw(spark):
    w = spark.createDataFrame([(i, float(i)) for i in range(10)], "v int, w double")
    df = spark.range(5000)
    out = synth.sample_categorical(df, synth.cdf_table(w, "v", "w"), "v", draws.uniform(F.col("id"), "x", 9), "v")
    assert out.count() == 5000 and out.select("id").distinct().count() == 5000
    share = one(out.agg((F.count_if(F.col("v") == 9) / F.count("*")).alias("s"))).s
    assert abs(share - 9 / 45) < 0.02
    assert out.where("v = 0").count() == 0


def test_coverage_thresholds(spark):
    df = spark.createDataFrame([(1, "a", 8, f"t{i % 2}") for i in range(30)], "origin_zone int, origin_zone_name string, hour_of_day int, taxi_id string")
    assert kpi.coverage_gaps(df).count() == 1
    assert kpi.coverage_gaps(df, vehicles_below=2).count() == 0


def test_partition_count_does_not_change_results(spark, sf):
    import __spark_entry__ as entry

    q = entry.queries()
    for name in ("kpi_trips_per_zone", "gps_dedupe", "match_best", "fleet_assign", "features"):
        seen = []
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append(sorted(map(str, q[name](spark, sf).collect())))
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert seen[0] == seen[1], name


def test_replay_mirrors_at_the_box_and_stays_inside_an_outline(spark):
    df = spark.createDataFrame([([[0.0, 0.0], [2.0, 0.0], [2.5, 0.0], [2.5, 0.5]],)], "points array<array<double>>")
    start = F.array(F.lit(4.0), F.lit(1.0))
    plain = one(df.select(paths.replay_steps(F.col("points"), start, 1.0, 1.0, (0.0, 5.0), (0.0, 5.0)).alias("p"))).p
    assert plain == [[4.0, 1.0], [2.0, 1.0], [2.5, 1.0], [2.5, 1.5]]
    ring = F.array(*[F.array(F.lit(x), F.lit(y)) for x, y in ((0.0, 0.0), (2.25, 0.0), (2.25, 5.0), (0.0, 5.0), (0.0, 0.0))])
    held = one(df.select(paths.replay_steps(F.col("points"), start, 1.0, 1.0, (0.0, 5.0), (0.0, 5.0), ring).alias("p"))).p
    assert held == [[4.0, 1.0], [2.0, 1.0], [2.0, 1.0], [2.0, 1.5]]


def test_ordered_counts_and_percentiles_with_a_hot_value_and_null_groups(spark):
    rnd = random.Random(2)
    rows = [(None if i % 7 == 0 else i % 2, 5.0 if rnd.random() < 0.7 else rnd.choice([None, round(rnd.gauss(0, 50), 1)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {(r.g, r.value): (r.n, r.before, r.total) for r in common.ordered_counts(df, "v", ["g"]).collect()}
    for g in (None, 0, 1):
        own = sorted(v for k, v in rows if k == g and v is not None)
        for v in set(own):
            assert got.pop((g, v)) == (own.count(v), sum(x < v for x in own), len(own))
        for r in common.percentiles(df.where(F.col("g").eqNullSafe(F.lit(g))), "v", [0.0, 0.1, 0.5, 0.975, 1.0]).collect():
            assert r.value == pytest.approx(np.quantile(own, r.p), abs=1e-9)
    assert not got
    assert common.ordered_counts(df.limit(0), "v").collect() == []
    assert common.percentiles(df.limit(0), "v", [0.5]).collect() == []
