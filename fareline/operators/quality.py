"""Balance metrics and acceptance gates."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline import constants as K
from fareline.functions import geo
from fareline.operators import common
from fareline.operators.spatial import assign_box_zone


def gini(df: DataFrame, key: str) -> DataFrame:
    """Gini of rows per key (keys without rows do not take part), from value multiplicities:
    keys of equal size are one row, so the ordered sum runs over distinct sizes only."""
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("x"))
    mult = sizes.groupBy("x").agg(F.count("*").alias("m"))
    before = Window.partitionBy(F.lit(0)).orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    m, x = F.col("m"), F.col("x")
    seen = F.coalesce(F.sum(m).over(before), F.lit(0))
    # sum of ranks of the m equal values: m * seen + m (m + 1) / 2
    weighted = mult.withColumn("rank_sum", m * seen + m * (m + 1) / 2)
    return weighted.agg(F.sum(m).alias("n_keys"), F.sum(m * x).alias("total"), F.sum(F.col("rank_sum") * x).alias("ix")).select(
        "n_keys", "total",
        (2 * F.col("ix") / (F.col("n_keys") * F.col("total")) - (F.col("n_keys") + 1) / F.col("n_keys")).alias("gini"),
    )


def clamp_edges(df: DataFrame, lat: str, lon: str, eps: float = 0.001) -> DataFrame:
    """Points stuck to each edge of the target box."""
    y, x = F.col(lat), F.col(lon)
    out = df.agg(
        F.count("*").alias("n"),
        F.count_if(y <= K.TARGET_LAT[0] + eps).alias("south"), F.count_if(y >= K.TARGET_LAT[1] - eps).alias("north"),
        F.count_if(x <= K.TARGET_LON[0] + eps).alias("west"), F.count_if(x >= K.TARGET_LON[1] - eps).alias("east"),
    )
    return out.withColumn("clamped_pct", (F.col("south") + F.col("north") + F.col("west") + F.col("east")) / F.col("n") * 100)


def band_share(df: DataFrame, lat: str, bands=K.BANDS) -> DataFrame:
    """Rows per half-open latitude band with their share of all rows."""
    one = df.agg(F.count("*").alias("n"), F.array(*[F.count_if((F.col(lat) >= lo) & (F.col(lat) < hi)) for _, lo, hi in bands]).alias("k"))
    rows = F.array(*[F.struct(F.lit(name).alias("band"), F.col("k")[i].alias("trips")) for i, (name, _, _) in enumerate(bands)])
    return one.select("n", F.inline(rows)).select("band", "trips", (F.col("trips") / F.col("n") * 100).alias("pct"))


def quality_gate(df: DataFrame, zones: DataFrame, lat: str, lon: str, out_of_range: Column) -> DataFrame:
    """Acceptance row: outside and clamped percent, balance, zones covered, top-5 share, verdict."""
    zoned = assign_box_zone(df.withColumn("_clamped", out_of_range), zones, lat, lon)
    per = zoned.groupBy("zone").agg(F.count("*").alias("n"), F.count_if("_clamped").alias("c"))
    # per has one row per zone; everything below is zone-sized
    w = Window.partitionBy(F.lit(0))
    r = per.where("zone IS NOT NULL").withColumns({
        "i": F.row_number().over(w.orderBy("n", "zone")), "top": F.row_number().over(w.orderBy(F.desc("n"), "zone"))})
    bal = r.agg(
        F.count("*").alias("zones"), F.sum("n").alias("inside"), F.sum(F.col("i") * F.col("n")).alias("ix"),
        F.sum(F.when(F.col("top") <= 5, F.col("n"))).alias("top5"))
    tot = per.agg(F.sum("n").alias("samples"), F.sum("c").alias("clamped"))
    samples, clamped = tot.select("samples").scalar(), tot.select("clamped").scalar()
    out = bal.select(
        samples.alias("samples"), F.col("zones").alias("zones_covered"),
        ((samples - F.col("inside")) / samples * 100).alias("outside_pct"), (clamped / samples * 100).alias("clamped_pct"),
        (2 * F.col("ix") / (F.col("zones") * F.col("inside")) - (F.col("zones") + 1) / F.col("zones")).alias("gini"),
        (F.col("top5") / F.col("inside") * 100).alias("top5_pct"))
    ok = (
        (F.col("outside_pct") <= K.GATE_OUTSIDE_PCT) & (F.col("clamped_pct") <= K.GATE_CLAMPED_PCT)
        & (F.col("gini") <= K.GATE_GINI) & (F.col("zones_covered") >= K.GATE_MIN_ZONES))
    return out.withColumn("verdict", F.when(ok, "PASS").otherwise("FAIL"))


def node_coverage(points: DataFrame, zones: DataFrame) -> DataFrame:
    """Points per zone with a sufficiency flag; ``points`` carries ``zone_id``."""
    per = points.groupBy("zone_id").agg(F.count("*").alias("nodes"))
    n = F.col("nodes")
    return zones.select("zone_id", "zone_name").join(per, "zone_id", "left").fillna(0, ["nodes"]).withColumn(
        "flag", F.when(n >= 200, "OK").when(n >= 50, "LOW").otherwise("SPARSE"))


def calibrate_bands(df: DataFrame, value: str, lows, highs, b1s, b2s, b3s, target=(15.0, 23.0, 35.0, 22.0)) -> DataFrame:
    """Grid search over (source range, band borders), best score first.

    Rows are reduced to distinct values with counts once; each candidate is then a sum over that
    histogram. The data side is partially aggregated per candidate before the shuffle, so its size
    does not matter for the exchange.
    """
    hist = df.groupBy(F.col(value).alias("v")).agg(F.count("*").alias("c"))
    lo, hi = K.TARGET_LAT
    grid = [F.array(*[F.lit(float(x)) for x in xs]) for xs in (lows, highs, b1s, b2s, b3s)]
    cand = hist
    for name, arr in zip(("src_lo", "src_hi", "b1", "b2", "b3"), grid):
        cand = cand.withColumn(name, F.explode(arr))
    sim = geo_remap_cols(F.col("v"), F.col("src_lo"), F.col("src_hi"), lo, hi)
    c = F.col("c")
    edges = [F.lit(lo), F.col("b1"), F.col("b2"), F.col("b3"), F.lit(hi)]
    sums = [F.sum(F.when((F.col("sim") >= a) & (F.col("sim") < b), c).otherwise(0)).alias(f"n{i}") for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    per = cand.withColumn("sim", sim).groupBy("src_lo", "src_hi", "b1", "b2", "b3").agg(
        F.sum("c").alias("n"), F.sum(F.when((F.col("v") < F.col("src_lo")) | (F.col("v") > F.col("src_hi")), c).otherwise(0)).alias("out"), *sums)
    pct = [F.col(f"n{i}") / F.col("n") * 100 for i in range(4)]
    clamp = F.col("out") / F.col("n") * 100
    score = clamp * 2
    for p, t in zip(pct, target):
        score = score + (p - t) * (p - t)
    return per.select("src_lo", "src_hi", "b1", "b2", "b3", *[p.alias(f"pct{i}") for i, p in enumerate(pct)], clamp.alias("clamp_pct"), score.alias("score"))


def geo_remap_cols(v: Column, src_lo: Column, src_hi: Column, lo: float, hi: float) -> Column:
    r = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - src_lo) / (src_hi - src_lo)))
    return r * F.lit(hi - lo) + F.lit(lo)


def best_bands(scored: DataFrame, max_clamp: float = 15.0, min_band: float = 8.0) -> DataFrame:
    return scored.where(F.col("clamp_pct") <= max_clamp).where(
        F.least("pct0", "pct1", "pct2", "pct3") >= min_band
    ).orderBy("score", "src_lo", "src_hi", "b1", "b2", "b3").limit(1)


def sla_metrics(events: DataFrame, as_of: Column, ts: str = "event_time", seen: str = "arrival") -> DataFrame:
    """Age of the newest event, row count and P95 delivery delay (whole milliseconds)."""
    late = events.select("kind", ts, F.round((F.unix_micros(seen) - F.unix_micros(ts)) / 1000).cast("long").alias("_ms"))
    basic = late.groupBy("kind").agg(F.count("*").alias("n_rows"), F.max(ts).alias("newest")).withColumn("age_s", F.unix_timestamp(as_of) - F.unix_timestamp("newest"))
    p95 = common.percentiles(late, "_ms", [0.95], ["kind"]).select(F.col("kind").alias("_k"), F.col("value").alias("p95_delay_ms"))
    return basic.join(p95, F.col("kind").eqNullSafe(F.col("_k")), "left").select("kind", "n_rows", "newest", "p95_delay_ms", "age_s")


def match_rate(matches: DataFrame) -> DataFrame:
    return matches.agg(
        F.count("*").alias("requests"), F.count_if(F.col("status") == "matched").alias("matched"),
        F.count_if(F.col("status") == "no_vehicle").alias("no_vehicle"),
    ).withColumn("matched_pct", F.col("matched") / F.col("requests") * 100)


def outside_metro(lat: Column, lon: Column) -> Column:
    return ~geo.inside(lat, lon, K.METRO_LAT, K.METRO_LON)
