"""Streaming queries: the feed is written as JSON files cut by arrival time, replayed as a bounded
stream (``availableNow``) and the sink is read back."""

import datetime as dt

from pyspark.sql import functions as F

from fareline.plans import views
from fareline.plans.live_queries import MATCH, NEED, NORM, asked, normalized
from fareline.plans.ctes import hav, sql, zone_of
from fareline.plans.registry import query, rounded
from fareline.session import cut_lineage, scratch
from fareline.sources import readers
from fareline.streaming import jobs

ONCE = {"availableNow": True}
BATCHES = 6


def feed(spark, df, time, label, batches=BATCHES, close=None):
    """JSON lines in ``batches`` steps of arrival, one file each, listed in name order by the file
    source. Rows carry their arrival as record_time and, where there is one, their id as record_no.
    ``close`` adds a last file with a row of that many seconds after the last, which ends all windows."""
    path = scratch(spark, label)
    df = cut_lineage(df, label + "-in")
    ends = df.agg(F.min("arrival").alias("lo"), F.max("arrival").alias("hi"), F.max(time).alias("last")).head()
    micros = lambda t: int(t.timestamp() * 1_000_000)
    span = micros(ends.hi) - micros(ends.lo) + 1
    step = F.floor((F.unix_micros("arrival") - micros(ends.lo)) * batches / span).cast("int")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    cols = [iso(c).alias(c) if c == time else F.col(c) for c in df.columns if c not in ("arrival", "event_id")]
    more = [iso("arrival").alias("record_time"), *([F.col("event_id").cast("string").alias("record_no")] if "event_id" in df.columns else [])]
    body = df.select(step.alias("step"), F.to_json(F.struct(*cols, *more)).alias("value"))
    if close is not None:
        late = ends.last + dt.timedelta(seconds=close)
        body = body.unionByName(spark.createDataFrame([(batches, '{"%s":"%s"}' % (time, late.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")))], "step int, value string"))
    # A folder per step: the one task that writes a step's file reads that step alone.
    body = cut_lineage(body, label + "-rows", "step")
    for i in range(batches + (close is not None)):
        body.where(F.col("step") == i).select("value").coalesce(1).write.mode("append").text(path)
    return path


def replay(spark, path, schema):
    """The folder as a stream of typed rows, one file per micro-batch."""
    text = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(path)
    return text.select(F.from_json("value", schema).alias("e")).select("e.*")


def run(df, label, fmt="parquet", mode="append"):
    """Run a bounded stream to its end; returns the sink folder and the finished query."""
    spark = df.sparkSession
    path = scratch(spark, label)
    q = jobs.start(df, path, scratch(spark, label + "-ckpt"), fmt, ONCE, mode)
    q.awaitTermination()
    return path, q


def _positions(spark, sf):
    return normalized(spark, sf).select("zone_id", "taxi_id", "speed_kmh", "status", "event_time", "arrival")


def _asked(spark, sf):
    return asked(spark, sf).where("origin_zone <> 0").select(
        "trip_id", "rider_id", "origin_zone", "origin_lat", "origin_lon", "dest_lat", "dest_lon", "event_time", "arrival")


POSITION = "zone_id INT, taxi_id STRING, speed_kmh DOUBLE, status STRING, event_time TIMESTAMP"
REQUEST = "trip_id STRING, rider_id STRING, origin_zone INT, origin_lat DOUBLE, origin_lon DOUBLE, dest_lat DOUBLE, dest_lon DOUBLE, event_time TIMESTAMP"


@query("stream_source")
def stream_source(spark, sf):
    """JSON text in, decoded rows out."""
    p = views.pings(spark, sf).select("taxi_id", "event_time", "lat", "lon", "speed_kmh", "status", "cell", "snap_dist_m", "arrival")
    path = feed(spark, p, "event_time", "raw-gps")
    values = readers.read_events(spark, "text", path=path, maxFilesPerTrigger=1)
    out, _ = run(jobs.json_pings(values), "decoded")
    return spark.read.parquet(out).select("taxi_id", "event_time", "lat", "lon", "speed_kmh", "status")


@query("stream_sink")
def stream_sink(spark, sf):
    """Rows to JSON messages and back."""
    src = replay(spark, feed(spark, _positions(spark, sf), "event_time", "pos"), POSITION)
    out, _ = run(jobs.as_messages(src), "messages", fmt="text")
    return spark.read.text(out).select(F.from_json("value", POSITION).alias("e")).select("e.*")


def raw_gps(spark, sf):
    return views.pings(spark, sf).select("event_id", "taxi_id", "event_time", "lat", "lon", "speed_kmh", "status", "cell", "snap_dist_m", "arrival")


@query("stream_gps", sql("SELECT taxi_id, zone_id, event_time, round(lat, 6) AS lat, round(lon, 6) AS lon, round(speed_kmh, 6) AS speed_kmh, status FROM norm", *NEED, extra=NORM))
def stream_gps(spark, sf, batches=BATCHES):
    jobs.require_rocksdb(spark)
    values = readers.read_events(spark, "text", path=feed(spark, raw_gps(spark, sf), "event_time", "raw-gps", batches), maxFilesPerTrigger=1)
    out, _ = run(jobs.stream_pings(values, views.lookup(spark, sf), views.zones(spark, sf)), "gps")
    return rounded(spark.read.parquet(out).select("taxi_id", "zone_id", "event_time", "lat", "lon", "speed_kmh", "status"))


@query("stream_demand")
def stream_demand(spark, sf):
    p = replay(spark, feed(spark, _positions(spark, sf), "event_time", "pos"), POSITION)
    r = replay(spark, feed(spark, _asked(spark, sf), "event_time", "req"), REQUEST).withColumnRenamed("origin_zone", "zone_id")
    out, _ = run(jobs.stream_demand(p, r), "demand")
    return rounded(spark.read.parquet(out))


@query("stream_demand_closed", sql("""SELECT zone_id, window_start, unique_vehicles, pending_requests FROM (
    SELECT zone_id, time_bucket(INTERVAL 30 SECOND, event_time) AS window_start, count(DISTINCT taxi_id) AS unique_vehicles, CAST(sum(req) AS BIGINT) AS pending_requests FROM (
      SELECT zone_id, event_time, taxi_id, 0 AS req FROM norm UNION ALL SELECT zone_id, event_time, NULL, 1 FROM asked0 WHERE zone_id <> 0) GROUP BY 1, 2)""", *NEED, "zones", "requests", extra={
        **NORM, "asked0": f"SELECT r.event_time, coalesce({zone_of('origin_lat', 'origin_lon')}, 0) AS zone_id FROM requests r"}))
def stream_demand_closed(spark, sf, batches=BATCHES):
    """Feeds in time order, ended by a row far ahead: every window closes and none of its rows is late."""
    in_order = lambda df: df.withColumn("arrival", F.col("event_time"))
    p = replay(spark, feed(spark, in_order(_positions(spark, sf)), "event_time", "pos", batches, 3600), POSITION)
    r = replay(spark, feed(spark, in_order(_asked(spark, sf)), "event_time", "req", batches, 3600), REQUEST).withColumnRenamed("origin_zone", "zone_id")
    out, _ = run(jobs.stream_demand(p, r), "demand-closed")
    return spark.read.parquet(out).select("zone_id", "window_start", "unique_vehicles", "pending_requests")


@query("late_drop")
def late_drop(spark, sf, batches=24):
    """Rows dropped as late per micro-batch when the watermark is far tighter than the delays."""
    p = replay(spark, feed(spark, _positions(spark, sf), "event_time", "pos", batches), POSITION)
    r = replay(spark, feed(spark, _asked(spark, sf), "event_time", "req", batches), REQUEST).withColumnRenamed("origin_zone", "zone_id")
    seen = jobs.LateRows(spark, scratch(spark, "late-counts"))
    spark.streams.addListener(seen)
    try:
        run(jobs.stream_demand(p, r, delay="1 second"), "demand-late")
        seen.done.wait()
    finally:
        spark.streams.removeListener(seen)
    return spark.read.schema("batch_id long, dropped long").parquet(seen.path)


@query("stream_match")
def stream_match(spark, sf):
    jobs.require_rocksdb(spark)
    p = replay(spark, feed(spark, _positions(spark, sf), "event_time", "pos"), POSITION)
    r = replay(spark, feed(spark, _asked(spark, sf), "event_time", "req"), REQUEST)
    out, _ = run(jobs.stream_match(p, r, views.zones(spark, sf)), "match")
    return rounded(jobs.resolve_outcomes(spark.read.parquet(out)))


@query("stream_match_join", sql(f"""SELECT f.trip_id, any_value(b.taxi_id) AS taxi_id, any_value(b.zone_id) AS zone_id, round(any_value(b.score), 6) AS score,
    CASE WHEN any_value(b.score) IS NULL THEN 'no_vehicle' ELSE 'matched' END AS status FROM fan f LEFT JOIN firsts b ON b.trip_id = f.trip_id WHERE f.origin_zone <> 0 GROUP BY 1""", *NEED, extra={
        **MATCH, "steps": """SELECT zone_id, time_bucket(INTERVAL 10 SECOND, event_time) + INTERVAL 9999999 MICROSECOND AS t, arg_min(taxi_id, ((coalesce(speed_kmh, 0) < 5)::INT, taxi_id)) AS taxi_id,
          min((coalesce(speed_kmh, 0) < 5)::INT) AS idle FROM norm WHERE status NOT IN ('matched', 'offline') GROUP BY 1, 2""",
        "firsts": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY score, taxi_id, zone_id) AS rn FROM (
          SELECT f.trip_id, f.zone_id, s.taxi_id, 0.7e0 * {hav("origin_lat", "origin_lon", "centroid_lat", "centroid_lon")} + 0.3e0 * s.idle AS score
          FROM fan f JOIN zones z ON z.zone_id = f.zone_id JOIN steps s ON s.zone_id = f.zone_id AND s.t <= f.event_time AND s.t > f.event_time - INTERVAL 60 SECOND)) WHERE rn = 1"""}))
def stream_match_join(spark, sf, batches=BATCHES):
    """Feeds in time order, ended by a row far ahead, so that the last unmatched requests leave too."""
    in_order = lambda df: df.withColumn("arrival", F.col("event_time"))
    p = replay(spark, feed(spark, in_order(_positions(spark, sf)), "event_time", "pos", batches, 3600), POSITION)
    r = replay(spark, feed(spark, in_order(_asked(spark, sf)), "event_time", "req", batches, 3600), REQUEST)
    out, _ = run(jobs.stream_match_join(p, r, views.zones(spark, sf)), "match-join")
    return rounded(jobs.resolve_outcomes(spark.read.parquet(out)))


@query("stream_archive")
def stream_archive(spark, sf):
    src = replay(spark, feed(spark, _positions(spark, sf), "event_time", "pos"), POSITION)
    path = scratch(spark, "archive-stream")
    q = jobs.archive_stream(src, path, scratch(spark, "archive-ckpt"), trigger=ONCE)
    q.awaitTermination()
    back = spark.read.schema(POSITION + ", year STRING, month STRING, day STRING, hour STRING").json(path)
    return back.groupBy("year", "month", "day", "hour").agg(F.count("*").alias("n"))
