"""Structured Streaming jobs. The column rules are those of the batch operators.

A stalled source holds a union or join back; :func:`with_heartbeat` lets its watermark go on by the
clock.
"""

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from fareline import constants as K
from fareline.functions import geo, pricing
from fareline.operators import gps, matching
from fareline.session import small_side
from fareline.sources import readers, sinks
from fareline.sources.sinks import archive_columns
from fareline.streaming.processors import INCREASING_SCHEMA, OUTCOME_SCHEMA, StrictlyIncreasing, ZoneMatcher

PING_DELAY = "3 minutes"
EVENT_DELAY = "10 seconds"


def start(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: dict | None = None, mode: str = "append") -> StreamingQuery:
    """Exactly-once file output; offsets and state live in the checkpoint folder."""
    return (
        df.writeStream.format(fmt).outputMode(mode).option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"})).start()
    )


def start_topic(df: DataFrame, servers: str, topic: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """JSON messages, at least once. Needs the Kafka connector on the class path."""
    return (
        as_messages(df).writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()
    )


def as_messages(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def archive_stream(df: DataFrame, path: str, checkpoint: str, ts: str = "event_time", trigger: dict | None = None) -> StreamingQuery:
    """Raw events as JSON in local year/month/day/hour folders."""
    return (
        archive_columns(df, ts).writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
        .partitionBy("year", "month", "day", "hour").trigger(**(trigger or {"processingTime": "60 seconds"})).start()
    )


def serve_latest(df: DataFrame, path: str, keys: list[str], part: str, version: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Serving table with one row per key, the highest ``version`` winning; one bulk merge per batch."""
    def merge(batch: DataFrame, _batch_id: int) -> None:
        sinks.upsert(batch, path, keys, part, version)

    return df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def serve_first(df: DataFrame, path: str, keys: list[str], order: list[str], checkpoint: str, part: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Serving table where the first row of a key stays."""
    def add(batch: DataFrame, _batch_id: int) -> None:
        sinks.insert_absent(batch, path, keys, [F.col(c) for c in order], part)

    return df.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def json_pings(values: DataFrame) -> DataFrame:
    """Decoded positions; one without a readable time takes its record time."""
    return readers.decode_events(values, readers.PING_JSON, "gps", record_time="record_time")


def stream_pings(values: DataFrame, lookup: DataFrame, zones: DataFrame, forget: bool = False) -> DataFrame:
    """Normalised positions from JSON text: dedupe by keyed state, then the batch rules. The dedupe
    goes by arrival and drops nothing as late, so any cut of the input gives the batch result; the
    watermark is set behind it. State is one number per vehicle ever seen; ``forget`` drops silent
    vehicles by the clock, for streams without an end (Spark then keeps running empty batches)."""
    decoded = json_pings(values)
    body = F.to_json(F.struct("lat", "lon", "speed_kmh", "status", "cell", "snap_dist_m"))
    keyed = decoded.where("taxi_id <> 'unknown'").select("taxi_id", "event_time", "record_time", "record_no", body.alias("payload"))
    deduped = keyed.groupBy("taxi_id").transformWithStateInPandas(
        StrictlyIncreasing(forget), INCREASING_SCHEMA, outputMode="Append", timeMode="ProcessingTime" if forget else "None")
    parsed = F.from_json("payload", "lat DOUBLE, lon DOUBLE, speed_kmh DOUBLE, status STRING, cell BIGINT, snap_dist_m DOUBLE")
    rows = deduped.withWatermark("event_time", PING_DELAY).select("taxi_id", "event_time", parsed.alias("p")).select("taxi_id", "event_time", "p.*")
    return gps.anonymize(gps.valid_pings(rows), lookup, zones)


def with_heartbeat(feed: DataFrame, idle_s: int = 15, every_s: int = 1) -> DataFrame:
    """A live feed joined by clock ticks: rows of nulls whose event time is ``idle_s`` behind the clock.

    A watermark set on the result goes on while the feed is silent, so an idle source holds a union
    or a join back by ``idle_s`` at most. Rows later than that behind the clock may become late."""
    ticks = feed.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    beat = ticks.where(F.unix_timestamp("timestamp") % every_s == 0).select((F.col("timestamp") - F.expr(f"INTERVAL {idle_s} SECONDS")).alias("event_time"))
    return feed.unionByName(beat, allowMissingColumns=True)


def marked(feed: DataFrame, delay: str, key: str) -> DataFrame:
    """Watermark on ``event_time``, then without the rows that only carry time (null ``key``).

    The optimizer moves conditions on other columns below a watermark, where they would take those
    rows away unseen; it moves none below a random column, so one stands between."""
    beats = feed.withWatermark("event_time", delay).withColumn("_any", F.rand())
    return beats.where(F.col(key).isNotNull() & (F.col("_any") >= 0)).drop("_any")


def stream_demand(pings: DataFrame, requests: DataFrame, delay: str = EVENT_DELAY, seconds: int = K.DEMAND_WINDOW_S) -> DataFrame:
    """Zone demand per tumbling window over the union of both feeds. ``pings`` has zone_id, taxi_id,
    event_time; ``requests`` has zone_id, event_time. Vehicles are first made distinct per window,
    a state row each, spread over all tasks; the windows then only count. Rows with a null zone_id
    only move the watermark."""
    w = F.window("event_time", f"{seconds} seconds").alias("w")
    none = F.lit(0).cast("long")
    a = marked(pings, delay, "zone_id").select("zone_id", w, "taxi_id").dropDuplicates(["zone_id", "w", "taxi_id"]).select("zone_id", "w", F.when(F.col("taxi_id").isNotNull(), 1).otherwise(0).cast("long").alias("vehicle"), none.alias("req"))
    b = marked(requests, delay, "zone_id").select("zone_id", w, none.alias("vehicle"), F.lit(1).cast("long").alias("req"))
    g = a.unionByName(b).groupBy("zone_id", "w").agg(F.sum("vehicle").alias("unique_vehicles"), F.sum("req").alias("pending_requests"))
    return gps.shape_demand(g)


def stream_match(pings: DataFrame, requests: DataFrame, zones: DataFrame, delay: str = EVENT_DELAY) -> DataFrame:
    """Per-zone outcomes with exclusive vehicles inside a zone. A trip asked in several zones gives
    several outcomes; :func:`resolve_outcomes` turns them into one row per trip."""
    p = gps_available(pings).withWatermark("event_time", delay).select(
        "zone_id", matching.millis("event_time").alias("ms"), F.lit(0).alias("kind"), "taxi_id", F.lit("").alias("trip_id"),
        pricing.is_idle(F.col("speed_kmh")).alias("idle"), F.lit(0.0).alias("km"), "event_time")
    center = zones.select("zone_id", F.col("centroid_lat").alias("v_lat"), F.col("centroid_lon").alias("v_lon"))
    asked = matching.fan_out(requests.withWatermark("event_time", delay), zones).join(small_side(center), "zone_id")
    km = geo.haversine_km(F.col("origin_lat"), F.col("origin_lon"), F.col("v_lat"), F.col("v_lon"))
    r = asked.select(
        "zone_id", matching.millis("event_time").alias("ms"), F.lit(1).alias("kind"), F.lit("").alias("taxi_id"), "trip_id",
        F.lit(0).alias("idle"), km.alias("km"), "event_time")
    return p.unionByName(r).groupBy("zone_id").transformWithStateInPandas(
        ZoneMatcher(), OUTCOME_SCHEMA, outputMode="Append", timeMode="EventTime")


def gps_available(pings: DataFrame) -> DataFrame:
    return matching.available(pings)


def resolve_outcomes(outcomes: DataFrame) -> DataFrame:
    """One row per trip: the best matched zone, else ``no_vehicle``. An early miss in one zone never
    hides a match in another."""
    best = F.min(F.when(F.col("status") == "matched", F.struct("score", "taxi_id", "zone_id")))
    return outcomes.groupBy("trip_id").agg(best.alias("m")).select(
        "trip_id", F.col("m.taxi_id").alias("taxi_id"), F.col("m.zone_id").alias("zone_id"), F.col("m.score").alias("score"),
        F.when(F.col("m").isNotNull(), "matched").otherwise("no_vehicle").alias("status"))


def stream_match_join(pings: DataFrame, requests: DataFrame, zones: DataFrame, step_s: int = 10, delay: str = EVENT_DELAY) -> DataFrame:
    """Matching without custom state: the best vehicle of every (zone, step) is a streaming aggregate,
    and a request joins the at most ``60 / step`` closed steps before it. The join is an outer one: a
    request asked in a zone that had no vehicle comes out as ``no_vehicle`` when the watermark has
    passed it. A zone's steps are looked up by the vehicles' time to live: a step is listed in its own
    slot of that length and the next, a request asks in its own. Vehicles are not taken out of the
    pool, and a ping becomes visible when its step closes. Rows with a null taxi_id or trip_id only move the watermark."""
    pool = gps_available(marked(pings, delay, "taxi_id")).groupBy("zone_id", F.window("event_time", f"{step_s} seconds").alias("w")).agg(
        F.min(F.struct(pricing.is_idle(F.col("speed_kmh")).alias("idle"), F.col("taxi_id"))).alias("best"))
    slot = lambda c: F.floor(F.unix_timestamp(c) / K.VEHICLE_TTL_S)
    pool = pool.select(F.col("zone_id").alias("p_zone"), F.window_time("w").alias("p_time"), "best")
    pool = pool.select("*", F.explode(F.array(slot("p_time"), slot("p_time") + 1)).alias("p_slot"))
    center = zones.select("zone_id", F.col("centroid_lat").alias("v_lat"), F.col("centroid_lon").alias("v_lon"))
    asked = matching.fan_out(marked(requests, delay, "trip_id"), zones).join(small_side(center), "zone_id")
    km = geo.haversine_km(F.col("origin_lat"), F.col("origin_lon"), F.col("v_lat"), F.col("v_lon"))
    asked = asked.select("trip_id", "zone_id", "event_time", slot("event_time").alias("slot"), km.alias("km"))
    near = (F.col("zone_id") == F.col("p_zone")) & (F.col("slot") == F.col("p_slot")) & (F.col("p_time") <= F.col("event_time")) & (
        F.col("p_time") > F.col("event_time") - F.expr(f"INTERVAL {K.VEHICLE_TTL_S} SECONDS"))
    hit = F.col("best").isNotNull()
    return asked.join(pool, near, "left_outer").select(
        "trip_id", "zone_id", F.col("best.taxi_id").alias("taxi_id"), F.when(hit, pricing.match_score(F.col("km"), F.col("best.idle"))).alias("score"),
        F.when(hit, "matched").otherwise("no_vehicle").alias("status"), "event_time")


class LateRows(StreamingQueryListener):
    """Writes (batch_id, dropped) of every micro-batch of a query to a Parquet folder, however many
    there are; reports are written in groups and at the end."""

    def __init__(self, spark: SparkSession, path: str, group: int = 256):
        self.spark, self.path, self.group, self.held, self.done = spark, path, group, [], threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.held.append((int(p.batchId), sum(int(s.numRowsDroppedByWatermark) for s in p.stateOperators)))
        if len(self.held) >= self.group:
            self._write()

    def onQueryTerminated(self, event) -> None:
        self._write()
        self.done.set()

    def _write(self) -> None:
        if self.held:
            self.spark.createDataFrame(self.held, "batch_id long, dropped long").write.mode("append").parquet(self.path)
            self.held = []


def require_rocksdb(spark: SparkSession) -> None:
    """Keyed processors need the RocksDB state store."""
    from fareline.session import STATE_PROVIDER

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
