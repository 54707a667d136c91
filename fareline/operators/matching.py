"""Matching trip requests to vehicles.

A vehicle is available in a zone from a ping until its next ping in that zone or 60 s later. A
request asks for the best vehicle available at one instant. Pairing every request with every vehicle
of its zone would be quadratic in a busy zone, so both sides meet on an aligned time grid instead:

* an availability interval is tiled by a few aligned blocks per level, each level four times coarser;
* blocks are aggregated per (zone, level, block) to their best vehicle and their vehicle count, with
  map-side combine, so a busy zone collapses before the shuffle;
* a request looks up the one block per level that holds its instant and takes the best of them.

Each vehicle covers an instant with exactly one block, so the result is exact. Within a zone every
vehicle sits at the zone centre, so the score order is (idle, taxi id).
"""

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline import constants as K
from fareline.functions import geo, pricing
from fareline.operators.common import enrich

RADIX = 4


def levels(ttl_s: int) -> int:
    """Levels of time blocks for that lifetime: no availability holds a block of the level beyond."""
    n = 1
    while RADIX**n <= ttl_s * 1000:
        n += 1
    return n


def available(pings: DataFrame) -> DataFrame:
    """Pings that put a vehicle into the pool."""
    return pings.where(~F.coalesce("status", F.lit("")).isin(*K.UNAVAILABLE_STATUS)).where("taxi_id <> '' AND zone_id <> 0")


def fan_out(requests: DataFrame, zones: DataFrame) -> DataFrame:
    """One row per zone asked: the origin (hop 0) and its listed neighbours in order."""
    near = F.filter(F.transform(F.split("adjacent_zones", ","), lambda s: F.trim(s)), lambda s: s.rlike("^[0-9]+$"))
    dim = zones.select(F.col("zone_id").alias("origin_zone"), F.transform(near, lambda s: s.cast("int")).alias("near"))
    asked = F.array_union(F.array("origin_zone"), F.coalesce("near", F.array().cast("array<int>")))
    return (
        enrich(requests.where("origin_zone <> 0"), dim, "origin_zone")
        .select(*requests.columns, F.posexplode(asked).alias("hop", "zone_id"))
    )


def millis(ts: str) -> Column:
    return F.floor(F.unix_micros(ts) / 1000)


def intervals(pings: DataFrame, ttl_s: int = K.VEHICLE_TTL_S) -> DataFrame:
    """Availability [t0, t1) in ms per (zone, vehicle, ping).

    Pings of one vehicle at one instant are merged first (fastest wins: it is the better state).
    The next ping only matters within the lifetime, so the look-ahead is windowed per minute with
    each ping also shown to the minute before it; no window spans a vehicle's whole history.

    The session's number of shuffle partitions is asked for by name: a few dozen time blocks follow
    from each row, which adaptive coalescing does not see when it joins partitions by their bytes.
    """
    parts = int(pings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ttl = ttl_s * 1000
    merged = pings.groupBy("zone_id", "taxi_id", millis("event_time").alias("t0")).agg(F.max(F.coalesce("speed_kmh", F.lit(0.0))).alias("speed_kmh"))
    home = F.floor(F.col("t0") / ttl)
    shown = merged.withColumn("home", home).withColumn("cell", F.explode(F.array(home, home - 1))).repartition(parts, "zone_id", "taxi_id", "cell")
    nxt = F.lead("t0").over(Window.partitionBy("zone_id", "taxi_id", "cell").orderBy("t0"))
    return shown.withColumn("t1", F.least(F.coalesce(nxt, F.col("t0") + ttl), F.col("t0") + ttl)).where("cell = home").select(
        "zone_id", "taxi_id", "t0", "t1", pricing.is_idle(F.col("speed_kmh")).alias("idle"))


def aligned_blocks(t0: Column, t1: Column, ttl_s: int = K.VEHICLE_TTL_S) -> Column:
    """Aligned blocks (level, block) that tile [t0, t1). Each level takes the blocks left and right of
    the part that the next coarser level can tile, as in a segment tree of fan-out ``RADIX``."""
    parts = []
    for level in range(levels(ttl_s)):
        size = float(RADIX**level)
        lo, hi = F.ceil(t0 / size).cast("long"), F.floor(t1 / size).cast("long")
        left_end = F.least(F.ceil(lo / float(RADIX)).cast("long") * RADIX, hi)
        right_start = F.greatest(F.floor(hi / float(RADIX)).cast("long") * RADIX, left_end)
        for start, end in ((lo, left_end), (right_start, hi)):
            cells = F.when((lo < hi) & (start < end), F.sequence(start, end - 1)).otherwise(F.array().cast("array<bigint>"))
            parts.append(_at_level(cells, level))
    return F.concat(*parts)


def _at_level(cells: Column, level: int) -> Column:
    return F.transform(cells, lambda b: F.struct(F.lit(level).alias("level"), b.alias("block")))


def block_pool(live: DataFrame, ttl_s: int = K.VEHICLE_TTL_S) -> DataFrame:
    """Best vehicle and vehicle count per (zone, level, block). ``t0`` of the chosen availability
    rides along so that a match can name the ping it uses."""
    return (
        live.select("zone_id", "taxi_id", "idle", "t0", F.explode(aligned_blocks(F.col("t0"), F.col("t1"), ttl_s)).alias("b"))
        .groupBy("zone_id", F.col("b.level").alias("level"), F.col("b.block").alias("block"))
        .agg(F.min(F.struct("idle", "taxi_id", "t0")).alias("best"), F.count("*").alias("vehicles"))
    )


def best_in_zone(asked: DataFrame, pool: DataFrame, ttl_s: int = K.VEHICLE_TTL_S) -> DataFrame:
    """Per asked (trip, zone): vehicles available at the instant and the best one (null if none)."""
    t = millis("event_time")
    ancestors = F.transform(
        F.sequence(F.lit(0), F.lit(levels(ttl_s) - 1)),
        lambda l: F.struct(l.alias("level"), F.floor(t / F.pow(F.lit(float(RADIX)), l)).cast("long").alias("block")),
    )
    keys = ["trip_id", "zone_id"]
    look = asked.select(*keys, F.explode(ancestors).alias("a")).select(*keys, "a.level", "a.block")
    hit = look.join(pool, ["zone_id", "level", "block"]).groupBy(*keys).agg(F.min("best").alias("best"), F.sum("vehicles").alias("candidates"))
    return asked.join(hit, keys, "left").withColumn("candidates", F.coalesce("candidates", F.lit(0)))


def match_candidates(requests: DataFrame, pings: DataFrame, zones: DataFrame, ttl_s: int = K.VEHICLE_TTL_S) -> DataFrame:
    """Outcome per (trip, zone asked): available vehicles, best vehicle, distance and score. A ping
    makes its vehicle available for ``ttl_s`` seconds, or until the vehicle's next ping in the zone."""
    asked = fan_out(requests, zones)
    found = best_in_zone(asked, block_pool(intervals(available(pings), ttl_s), ttl_s), ttl_s)
    center = zones.select("zone_id", F.col("centroid_lat").alias("v_lat"), F.col("centroid_lon").alias("v_lon"))
    km = geo.haversine_km(F.col("origin_lat"), F.col("origin_lon"), F.col("v_lat"), F.col("v_lon"))
    return enrich(found, center, "zone_id").select(
        *asked.columns, "candidates", F.col("best.taxi_id").alias("taxi_id"), F.col("best.t0").alias("ping_ms"),
        F.when(F.col("best").isNotNull(), km).alias("pickup_km"),
        F.when(F.col("best").isNotNull(), pricing.match_score(km, F.col("best.idle"))).alias("score"),
        F.when(F.col("best").isNotNull(), "matched").otherwise("no_vehicle").alias("status"),
    )


def match_best(cands: DataFrame) -> DataFrame:
    """One row per trip: the best scored zone outcome (ties by vehicle id), or ``no_vehicle``."""
    picked = cands.groupBy("trip_id").agg(
        F.min(F.when(F.col("status") == "matched", F.struct("score", "taxi_id", "zone_id", "pickup_km"))).alias("m"),
        F.first("rider_id").alias("rider_id"), F.first("origin_zone").alias("origin_zone"),
        F.first("origin_lat").alias("a"), F.first("origin_lon").alias("b"), F.first("dest_lat").alias("c"), F.first("dest_lon").alias("d"))
    km = geo.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    ok = F.col("m").isNotNull()
    return picked.select(
        "trip_id", "rider_id", "origin_zone", F.col("m.taxi_id").alias("taxi_id"), F.col("m.zone_id").alias("match_zone"), F.col("m.score").alias("score"),
        F.when(ok, pricing.pickup_eta_s(F.col("m.pickup_km"))).alias("eta_seconds"), F.when(ok, pricing.live_fare(km)).alias("fare"),
        F.when(ok, "matched").otherwise("no_vehicle").alias("status"))


# --- exclusive assignment ---------------------------------------------------------------------

SLICE_SCHEMA = "slice long, seq long, trip_id string, zone_id int, taxi_id string, ping_ms long"


def _run_slice(pdf: pd.DataFrame) -> pd.DataFrame:
    """Replay one time slice in event order. Rows: kind 0 = carried-in use of a ping, 1 = ping,
    2 = request (one row per zone asked, in hop order).

    A zone's pings wait in a heap by (idle, taxi). What is expired, superseded or used stays so,
    hence it is dropped when it comes to the top: a request costs a logarithm, not its zone's pool."""
    ttl = K.VEHICLE_TTL_S * 1000
    order = np.lexsort((pdf["hop"], pdf["seq"], pdf["kind"], pdf["t"]))
    order = order[pdf["kind"].to_numpy()[order] > 0]
    old = pdf[pdf["kind"] == 0]
    carried = set(zip(old["zone_id"], old["taxi_id"], old["ping_ms"]))
    rows = zip(*(pdf[c].to_numpy()[order].tolist() for c in ("kind", "t", "seq", "trip_id", "zone_id", "taxi_id", "idle", "ping_ms")))
    latest: dict[tuple, int] = {}
    heaps: dict[int, list[tuple]] = {}
    done: set[str] = set()
    out = []
    for kind, t, seq, trip, zone, taxi, idle, ms in rows:
        heap = heaps.setdefault(zone, [])
        if kind == 1:
            latest[zone, taxi] = ms
            if (zone, taxi, ms) not in carried:
                heapq.heappush(heap, (idle, taxi, ms))
            continue
        if trip in done:
            continue
        while heap and (t - heap[0][2] >= ttl or latest[zone, heap[0][1]] != heap[0][2]):
            heapq.heappop(heap)
        if heap:
            _, best, at = heapq.heappop(heap)
            done.add(trip)
            out.append((seq, trip, zone, best, at))
    found = pd.DataFrame(out, columns=["seq", "trip_id", "zone_id", "taxi_id", "ping_ms"])
    found.insert(0, "slice", pdf["slice"].iloc[0])
    return found


def match_exclusive(requests: DataFrame, pings: DataFrame, zones: DataFrame, slice_s: int = 120) -> DataFrame:
    """Greedy assignment in event order: a ping serves one trip, a trip is served once, zones are
    asked in hop order.

    Order matters only inside the 60 s lifetime of pings, so time is cut into slices that run in
    parallel. A slice needs to know which pings of the minute before it are already used. That is
    solved by iteration: start from 'none used', run all slices, hand the uses over, and run again
    the slices whose hand-over changed, until nothing changes. Slice k is exact after at most k
    rounds, in practice after two or three, because a chain of effects across a border dies out.
    """
    from fareline.session import cut_lineage

    width = slice_s * 1000
    live = intervals(available(pings)).select("zone_id", "taxi_id", "idle", F.col("t0").alias("ping_ms"))
    home = F.floor(F.col("ping_ms") / width)
    border = F.floor((F.col("ping_ms") + K.VEHICLE_TTL_S * 1000 - 1) / width)
    rows_p = live.select(
        F.explode(F.sequence(home, border)).alias("slice"), F.lit(1).alias("kind"), F.col("ping_ms").alias("t"), F.lit(0).cast("long").alias("seq"),
        F.lit(0).alias("hop"), F.lit("").alias("trip_id"), "zone_id", "taxi_id", "idle", "ping_ms")
    t = millis("event_time")
    rows_r = fan_out(requests, zones).select(
        F.floor(t / width).alias("slice"), F.lit(2).alias("kind"), t.alias("t"), F.xxhash64("trip_id").alias("seq"), "hop", "trip_id", "zone_id",
        F.lit("").alias("taxi_id"), F.lit(0).alias("idle"), F.lit(0).cast("long").alias("ping_ms"))
    wanted = rows_r.select("slice").distinct()
    events = cut_lineage(rows_p.join(wanted, "slice", "left_semi").unionByName(rows_r), "match-events")

    result = cut_lineage(events.groupBy("slice").applyInPandas(_run_slice, SLICE_SCHEMA), "match-0")
    handed = events.limit(0).select("slice", "zone_id", "taxi_id", "ping_ms")
    while True:
        # a use is handed to the next slice if the ping is still alive there
        over = result.where((F.floor((F.col("ping_ms") + K.VEHICLE_TTL_S * 1000 - 1) / width)) > F.col("slice")).select(
            (F.col("slice") + 1).alias("slice"), "zone_id", "taxi_id", "ping_ms")
        over = cut_lineage(over.join(wanted, "slice", "left_semi"), "match-over")
        changed = over.exceptAll(handed).unionByName(handed.exceptAll(over)).select("slice").distinct()
        changed = cut_lineage(changed, "match-changed")
        if changed.isEmpty():
            break
        carried = over.select(
            "slice", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("t"), F.lit(0).cast("long").alias("seq"), F.lit(0).alias("hop"), F.lit("").alias("trip_id"),
            "zone_id", "taxi_id", F.lit(0).alias("idle"), "ping_ms")
        redo = events.unionByName(carried).join(changed, "slice", "left_semi").groupBy("slice").applyInPandas(_run_slice, SLICE_SCHEMA)
        result = cut_lineage(result.join(changed, "slice", "left_anti").unionByName(redo), "match-round")
        handed = over
    return result.select("trip_id", "zone_id", "taxi_id", "ping_ms")
