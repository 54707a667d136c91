"""Steps whose cost must not outgrow the input."""

import random
import time

import pandas as pd
from pyspark.sql import functions as F

from fareline import session
from fareline.functions import paths
from fareline.operators import features, matching, spatial, synth
from fareline.plans import forecast_queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_nodes_are_not_broadcast(spark):
    pts = spark.createDataFrame([(1, 33.5, -7.6), (2, 33.5, None), (3, 10.0, 10.0)], "id long, lat double, lon double")
    spots = lambda n: spark.range(n).select(
        F.col("id").alias("node_id"), (33.4 + (F.col("id") % 400) * 0.0005).alias("node_lat"), (-7.7 + F.floor(F.col("id") / 400) * 0.0005).alias("node_lon"))
    few, many = (spatial.snap_nearest(pts, spots(n), "lat", "lon", 0.003) for n in (400 * 300, 400 * 500))
    assert "BroadcastHashJoin" in plan(few)
    assert "Broadcast" not in plan(many)
    key = lambda rows: sorted((r.id, r.node_id) for r in rows)
    assert key(many.collect()) == key(few.collect()) == [(1, 200 * 400 + 200), (2, None), (3, None)]


def test_model_rows_are_computed_once(spark, sf):
    """Training, scores and baseline read one stored feature matrix instead of deriving it from the trips each time."""
    rows = forecast_queries.test_rows(spark, sf)
    assert "Window" not in plan(rows) and "Aggregate" not in plan(rows)
    assert rows.inputFiles() and {*rows.inputFiles()} <= {*forecast_queries.test_rows(spark, sf).inputFiles()}
    key = lambda df: sorted((r.origin_zone, r.trip_date, r.slot_of_day, r.demand, r.supply, r.demand_lag_1d, r.demand_lag_7d, r.rolling_7d_mean) for r in df.collect())
    assert key(rows) == key(features.split_at(forecast_queries.matrix(spark, sf), forecast_queries.SPLIT)[1])


def test_snap_levels_follow_the_density():
    assert [spatial.snap_levels(n, 0.065, 0.003) for n in (0, 10, 900_000, 5_400_000)] == [1, 1, 3, 4]


def slice_rows(pings, asks, used=()):
    cols = ["slice", "kind", "t", "seq", "hop", "trip_id", "zone_id", "taxi_id", "idle", "ping_ms"]
    rows = [(0, 0, -1, 0, 0, "", z, x, 0, ms) for z, x, ms in used]
    rows += [(0, 1, ms, 0, 0, "", z, x, idle, ms) for z, x, idle, ms in pings]
    return pd.DataFrame(rows + [(0, 2, t, i, hop, f"r{i}", z, "", 0, 0) for i, (t, zones) in enumerate(asks) for hop, z in enumerate(zones)], columns=cols)


def test_slice_replay_is_the_greedy_one():
    rnd = random.Random(3)
    pings = sorted({(rnd.randrange(3), f"x{rnd.randrange(15)}", rnd.randrange(120_000)): rnd.randrange(2) for _ in range(150)}.items())
    pings = [(z, x, idle, ms) for (z, x, ms), idle in pings]
    asks = [(rnd.randrange(120_000), rnd.sample(range(4), 2)) for _ in range(120)]
    used = {(z, x, ms) for z, x, _, ms in pings[::9]}
    taken, want = set(used), []
    for t, i, zones in sorted((t, i, z) for i, (t, z) in enumerate(asks)):
        for zone in zones:
            last = {x: (idle, x, ms) for z, x, idle, ms in sorted(pings, key=lambda p: p[3]) if z == zone and ms <= t}
            free = sorted(p for p in last.values() if t - p[2] < 60_000 and (zone, p[1], p[2]) not in taken)
            if free:
                taken.add((zone, *free[0][1:]))
                want.append((f"r{i}", zone, *free[0][1:]))
                break
    got = matching._run_slice(slice_rows(pings, asks, used))
    assert len(want) > 30 and list(got[["trip_id", "zone_id", "taxi_id", "ping_ms"]].itertuples(index=False, name=None)) == want
    assert matching._run_slice(slice_rows(pings, [])).empty


def test_a_request_does_not_scan_its_zone():
    pings = [(1, f"x{i:05d}", 0, i % 1000) for i in range(20_000)]
    started = time.monotonic()
    got = matching._run_slice(slice_rows(pings, [(2000 + i, [1]) for i in range(20_000)]))
    assert len(got) == 20_000 and time.monotonic() - started < 10


def test_spread_bounds_the_rows_of_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 500)
    spark.range(10_000).coalesce(1).write.parquet(str(tmp_path / "t"))
    got = session.spread(spark.read.parquet(str(tmp_path / "t")), "id")
    sizes = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert got.rdd.getNumPartitions() == 20 and sum(sizes) == 10_000 and max(sizes) < 700


def test_verdict_measures_a_path_once(spark):
    line = "array(array(-8.60D, 41.10D), array(-8.61D, 41.11D), array(-8.60D, 41.10D), array(-8.61D, 41.11D))"
    df = spark.sql(f"SELECT {line} AS points UNION ALL SELECT slice({line}, 1, 2) UNION ALL SELECT array(array(0D, 0D), array(0D, 0D), array(0D, 0D)) UNION ALL SELECT array(array(0D, 0D), array(1D, 0D), array(2D, 0D))")
    out = df.select(paths.route_verdict(F.col("points"), max_km=20.0).alias("v"))
    assert [r.v for r in out.collect()] == ["zigzag", "too_few_points", "too_short", "too_long"]
    assert plan(out).split("Project", 2)[1].upper().count("ASIN") == 1


def test_intervals_keep_their_partitions(spark):
    p = spark.range(200).select(
        (F.col("id") % 3 + 1).cast("int").alias("zone_id"), F.concat(F.lit("x"), F.col("id") % 20).alias("taxi_id"),
        F.timestamp_seconds(1_704_067_200 + F.col("id") * 7).alias("event_time"), F.lit(3.0).alias("speed_kmh"))
    assert matching.intervals(p).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_draws_are_not_hashed_again_below_the_shuffle(spark, sf):
    """A null test of a draw's bucket moved below the spread of the rows and hashed every draw twice."""
    from fareline.plans import synth_queries

    text = synth_queries.generated(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    below = text[text.index("RepartitionByExpression"):]
    assert "md5" not in below.split("\n", 3)[1] + below.split("\n", 3)[2]


def test_a_null_draw_takes_nothing(spark):
    rows = spark.createDataFrame([(1, 0.2), (2, None)], "id int, x double")
    table = synth.cdf_table(synth._table(spark, [("a", 1), ("b", 1)]), "value", "w")
    drawn = lambda how: sorted((r.id, r.v) for r in synth.sample_categorical(rows, table, "value", F.col("x"), "v", how=how).collect())
    assert drawn("inner") == [(1, "a")]
    assert drawn("left") == [(1, "a"), (2, None)]
