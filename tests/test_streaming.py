"""Streams against their batch twins."""

import datetime as dt
import re
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fareline.operators import gps
from fareline.plans import stream_queries, views
from fareline.plans.live_queries import asked, normalized
from fareline.plans.stream_queries import ONCE, POSITION, REQUEST, _asked, _positions, feed, replay, run
from fareline.session import scratch
from fareline.streaming import jobs

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
POS = "zone_id int, taxi_id string, speed_kmh double, status string, event_time timestamp, arrival timestamp"


def at(s):
    return T0 + dt.timedelta(seconds=s)


def test_demand_stream_equals_batch_when_nothing_is_late(spark, sf):
    pos = _positions(spark, sf).withColumn("arrival", F.col("event_time"))
    req = _asked(spark, sf).withColumn("arrival", F.col("event_time"))
    p = replay(spark, feed(spark, pos, "event_time", "p"), POSITION)
    r = replay(spark, feed(spark, req, "event_time", "r"), REQUEST).withColumnRenamed("origin_zone", "zone_id")
    out, _ = run(jobs.stream_demand(p, r, delay="10 minutes"), "d")
    got = {(x.zone_id, x.window_start, x.unique_vehicles, x.pending_requests) for x in spark.read.parquet(out).collect()}
    want = {
        (x.zone_id, x.window_start, x.unique_vehicles, x.pending_requests)
        for x in gps.demand_window(pos, req.withColumnRenamed("origin_zone", "zone_id")).collect()
    }
    # windows still open at the end of the bounded stream are not emitted in append mode
    assert got and got <= want
    last = max(w[1] for w in want)
    assert {w for w in want if w[1] < last - dt.timedelta(minutes=11)} <= got


@pytest.mark.parametrize("batches", [2, 9])
def test_gps_stream_equals_batch_for_any_cut(spark, sf, batches):
    key = lambda x: (x.taxi_id, x.zone_id, x.event_time, round(x.lat, 6), round(x.lon, 6))
    got = sorted(key(x) for x in stream_queries.stream_gps(spark, sf, batches).collect())
    want = sorted(key(x) for x in normalized(spark, sf).collect())
    assert got == want


def test_demand_stream_closes_every_window_for_any_cut(spark, sf):
    each = [{tuple(x) for x in stream_queries.stream_demand_closed(spark, sf, n).collect()} for n in (2, 7)]
    want = gps.demand_window(_positions(spark, sf), _asked(spark, sf).withColumnRenamed("origin_zone", "zone_id"))
    assert each[0] == each[1] == {tuple(x) for x in want.select("zone_id", "window_start", "unique_vehicles", "pending_requests").collect()}


def test_join_match_answers_every_request(spark, sf):
    rows = stream_queries.stream_match_join(spark, sf, 3).collect()
    trips = {r.trip_id for r in _asked(spark, sf).select("trip_id").collect()}
    assert len(rows) == len(trips) and {r.trip_id for r in rows} == trips
    assert {r.status for r in rows} == {"matched", "no_vehicle"}


def test_heartbeat_moves_the_watermark_of_a_silent_feed(spark, tmp_path):
    now = dt.datetime.now(dt.timezone.utc)
    live, silent = str(tmp_path / "live"), str(tmp_path / "silent")
    schema = "zone_id int, event_time timestamp, taxi_id string"
    spark.createDataFrame([(1, now - dt.timedelta(seconds=90), "a")], schema).write.json(live)
    spark.createDataFrame([], schema).write.json(silent)
    feed_of = lambda path: jobs.with_heartbeat(spark.readStream.schema(schema).json(path), idle_s=15)
    q = jobs.stream_demand(feed_of(live), feed_of(silent).drop("taxi_id"), delay="5 seconds").writeStream.format("memory").queryName("beats").outputMode("append").trigger(processingTime="1 second").start()
    try:
        until = time.monotonic() + 90
        while time.monotonic() < until and not spark.table("beats").count():
            time.sleep(1)
    finally:
        q.stop()
    assert [(r.zone_id, r.unique_vehicles, r.pending_requests) for r in spark.table("beats").collect()] == [(1, 1, 0)]


def test_late_rows_are_dropped_and_counted(spark):
    rows = [(1, "a", 10.0, "moving", at(0), at(0)), (1, "b", 10.0, "moving", at(90), at(90)), (1, "c", 10.0, "moving", at(120), at(120)),
            (1, "d", 10.0, "moving", at(200), at(200)), (1, "late", 10.0, "moving", at(1), at(320)), (1, "e", 10.0, "moving", at(400), at(400))]
    df = spark.createDataFrame(rows, POS)
    req = spark.createDataFrame([(1, at(s), at(s)) for s in (0, 90, 120, 200, 320, 400)], "zone_id int, event_time timestamp, arrival timestamp")
    p = replay(spark, feed(spark, df, "event_time", "lp", batches=8), POSITION)
    r = replay(spark, feed(spark, req, "event_time", "lr", batches=8), "zone_id INT, event_time TIMESTAMP")
    seen = jobs.LateRows(spark, scratch(spark, "late-counts"), group=2)
    spark.streams.addListener(seen)
    out, _ = run(jobs.stream_demand(p, r), "late")
    assert seen.done.wait(60)
    spark.streams.removeListener(seen)
    first = spark.read.parquet(out).where(F.col("window_start") == F.lit(at(0))).collect()
    assert [x.unique_vehicles for x in first] == [1]
    told = spark.read.parquet(seen.path).collect()
    assert sum(r.dropped for r in told) >= 1
    assert len({r.batch_id for r in told}) == len(told) >= 8


def test_stream_match_is_exclusive_and_resolved(spark, sf):
    rows = entry.queries()["stream_match"](spark, sf).collect()
    trips = asked(spark, sf).where("origin_zone <> 0").count()
    assert len(rows) == trips == len({r.trip_id for r in rows})
    assert {r.status for r in rows} <= {"matched", "no_vehicle"}
    assert any(r.status == "matched" for r in rows)


def test_resolution_prefers_a_match(spark):
    rows = [("t", 1, None, None, None, "no_vehicle", at(0)), ("t", 2, "x", 5, 0.4, "matched", at(0)), ("u", 1, None, None, None, "no_vehicle", at(0))]
    df = spark.createDataFrame(rows, "trip_id string, zone_id int, taxi_id string, ping_ms long, score double, status string, event_time timestamp")
    got = {r.trip_id: (r.status, r.taxi_id) for r in jobs.resolve_outcomes(df).collect()}
    assert got == {"t": ("matched", "x"), "u": ("no_vehicle", None)}


def test_messages_and_once_trigger(spark):
    assert ONCE == {"availableNow": True}
    row = jobs.as_messages(spark.createDataFrame([(1, "a")], "k int, v string")).collect()[0]
    assert row.value == '{"k":1,"v":"a"}'


def test_normalized_has_no_raw_position(spark, sf):
    n = normalized(spark, sf).join(views.pings(spark, sf).select("event_id", F.col("lat").alias("y"), F.col("lon").alias("x")), "event_id")
    assert n.where("lat = y OR lon = x").count() == 0


def test_serving_tables_from_a_stream(spark, sf, tmp_path):
    pos = _positions(spark, sf)
    path = feed(spark, pos, "event_time", "serve", batches=3)
    latest, first = str(tmp_path / "latest"), str(tmp_path / "first")
    for q in (
        jobs.serve_latest(replay(spark, path, POSITION), latest, ["zone_id", "taxi_id"], "zone_id", "event_time", str(tmp_path / "c1"), ONCE),
        jobs.serve_first(replay(spark, path, POSITION), first, ["zone_id", "taxi_id"], ["event_time"], str(tmp_path / "c2"), "zone_id", ONCE),
    ):
        assert q.awaitTermination(300)
    rows = pos.select("zone_id", "taxi_id", "event_time", "arrival").collect()
    want = {}
    for r in rows:
        k = (r.zone_id, r.taxi_id)
        want[k] = max(want.get(k, r.event_time), r.event_time)
    assert {((r.zone_id, r.taxi_id), r.event_time) for r in spark.read.parquet(latest).collect()} == set(want.items())
    kept = spark.read.parquet(first).select("zone_id", "taxi_id").collect()
    assert len(kept) == len(set(kept)) == len(want)


def test_event_time_falls_back_to_record_time(spark):
    from fareline.sources import readers

    df = spark.createDataFrame([('{"taxi_id":"a","event_time":"2024-01-01T00:00:00Z"}', at(9)), ('{"taxi_id":"b"}', at(9)), ("{oops", at(9))], "value string, record_time timestamp")
    got = {r.taxi_id: r.event_time for r in readers.decode_events(df, readers.PING_JSON, "gps", record_time="record_time").collect()}
    assert {k: v.timestamp() for k, v in got.items()} == {"a": at(0).timestamp(), "b": at(9).timestamp()}
    assert {r.taxi_id for r in readers.decode_events(df, readers.PING_JSON, "gps").collect()} == {"a"}


def test_a_step_of_the_feed_reads_its_own_rows_alone(spark, monkeypatch):
    stored = []
    cut = stream_queries.cut_lineage
    monkeypatch.setattr(stream_queries, "cut_lineage", lambda *a: stored.append(cut(*a)) or stored[-1])
    rows = [(i, at(s), at(s)) for i, s in enumerate((0, 1, 70, 71, 130, 200, 299))]
    df = spark.createDataFrame(rows, "n int, event_time timestamp, arrival timestamp").coalesce(1)
    path = feed(spark, df, "event_time", "steps", 5)
    assert len(spark.read.text(path).inputFiles()) == 5 and spark.read.json(path).count() == 7
    files = [{r[0] for r in stored[-1].where(F.col("step") == i).select(F.input_file_name()).collect()} for i in range(5)]
    assert all(files) and all(not a & b for i, a in enumerate(files) for b in files[:i])


def test_join_match_meets_by_time_as_well_as_zone(spark, sf):
    p = replay(spark, feed(spark, _positions(spark, sf), "event_time", "pos", 2), POSITION)
    r = replay(spark, feed(spark, _asked(spark, sf), "event_time", "req", 2), REQUEST)
    plan = jobs.stream_match_join(p, r, views.zones(spark, sf))._jdf.queryExecution().analyzed().toString()
    assert re.search(r"slot#\d+L = p_slot#\d+L", plan)
