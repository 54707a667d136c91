"""Metered-trip queries: cleaning, demand, fingerprints."""

from pyspark.sql import functions as F

from fareline import constants as K
from fareline.operators import common, meter, synth
from fareline.plans import views
from fareline.plans.ctes import sql
from fareline.plans.registry import query, rounded

CLEAN_COLS = ["PULocationID", "DOLocationID", "passenger_count", "trip_distance", "fare_amount"]


@query("nyc_clean", sql("SELECT " + ", ".join(CLEAN_COLS) + ", tpep_pickup_datetime FROM clean", "clean"))
def nyc_clean(spark, sf):
    return meter.clean_trips(views.table(spark, sf, "meter")).select(*CLEAN_COLS, "tpep_pickup_datetime")


def _funnel_sql():
    steps, cond, prev = [], [], "TRUE"
    for i, (name, rule) in enumerate(meter.CLEAN_RULES, 1):
        cond.append(rule)
        now = " AND ".join(cond)
        steps.append(f"SELECT {i} AS step, '{name}' AS rule, count(*) FILTER (WHERE {now}) AS kept,"
                     f" count(*) FILTER (WHERE {prev}) - count(*) FILTER (WHERE {now}) AS removed FROM meter")
        prev = now
    return sql(" UNION ALL ".join(steps), "meter")


@query("nyc_clean_funnel", _funnel_sql())
def nyc_clean_funnel(spark, sf):
    return meter.clean_funnel(views.table(spark, sf, "meter"))


@query("nyc_realism", sql("SELECT PULocationID, DOLocationID, trip_distance, fare_amount, CAST(dur AS BIGINT) AS duration_s, hour, dow FROM real", "real"))
def nyc_realism(spark, sf):
    return views.realistic(spark, sf).select("PULocationID", "DOLocationID", "trip_distance", "fare_amount", "duration_s", "hour", "dow")


@query("nyc_features", sql("""SELECT PULocationID, tpep_pickup_datetime, pickup_hour, pickup_date, day_of_week, is_weekend, year_month, trip_duration_sec FROM mfeat""", "mfeat"))
def nyc_features(spark, sf):
    return views.clean_meter(spark, sf).select(
        "PULocationID", "tpep_pickup_datetime", "pickup_hour", "pickup_date", "day_of_week", "is_weekend", "year_month", "trip_duration_sec")


@query("nyc_demand", sql("""SELECT pickup_zone_id, pickup_hour, pickup_date, day_of_week, is_weekend, trip_count, round(avg_distance, 6) AS avg_distance,
    round(avg_fare, 6) AS avg_fare, round(avg_duration_sec, 6) AS avg_duration_sec, total_passengers FROM demand""", "demand"))
def nyc_demand(spark, sf):
    return rounded(views.demand(spark, sf))


@query("nyc_hourly_curve", sql("SELECT pickup_hour, round(avg(trip_count), 6) AS avg_trips_per_zone, CAST(sum(trip_count) AS BIGINT) AS total_trips FROM demand GROUP BY 1", "demand"))
def nyc_hourly_curve(spark, sf):
    return rounded(meter.hourly_curve(views.demand(spark, sf)))


@query("nyc_top_zones", sql("SELECT pickup_zone_id, CAST(sum(trip_count) AS BIGINT) AS total_trips FROM demand GROUP BY 1", "demand"))
def nyc_top_zones(spark, sf):
    return meter.top_zones(views.demand(spark, sf))


@query("nyc_top20", sql("""SELECT pickup_zone_id, CAST(sum(trip_count) AS BIGINT) AS total_trips,
    round(sum(trip_count)::DOUBLE / (SELECT sum(trip_count) FROM demand)::DOUBLE * 100, 6) AS share_pct FROM demand GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""", "demand"))
def nyc_top20(spark, sf):
    return rounded(meter.top_n_share(views.demand(spark, sf)))


@query("nyc_weekend_ratio", sql("""SELECT pickup_hour, round(avg(trip_count) FILTER (WHERE is_weekend = 0), 6) AS weekday_mean,
    round(avg(trip_count) FILTER (WHERE is_weekend = 1), 6) AS weekend_mean,
    round(avg(trip_count) FILTER (WHERE is_weekend = 1) / avg(trip_count) FILTER (WHERE is_weekend = 0), 6) AS ratio FROM demand GROUP BY 1""", "demand"))
def nyc_weekend_ratio(spark, sf):
    return rounded(meter.weekend_ratio(views.demand(spark, sf)))


@query("nyc_summary", sql("""SELECT count(*) AS n, round(avg(trip_distance), 6) AS avg_distance, round(avg(fare_amount), 6) AS avg_fare,
    round(avg(trip_duration_sec), 6) AS avg_duration_sec FROM mfeat""", "mfeat"))
def nyc_summary(spark, sf):
    return rounded(views.clean_meter(spark, sf).agg(
        F.count("*").alias("n"), F.avg("trip_distance").alias("avg_distance"), F.avg("fare_amount").alias("avg_fare"),
        F.avg("trip_duration_sec").alias("avg_duration_sec")))


NULLABLE = ["store_and_fwd_flag", "PULocationID", "fare_amount"]


@query("null_profile", sql(" UNION ALL ".join(
    f"SELECT '{n}' AS column_name, count(*) FILTER (WHERE {c}) AS nulls, round(count(*) FILTER (WHERE {c}) / count(*)::DOUBLE * 100, 6) AS pct FROM meter"
    for n, c in [*[(c, f"{c} IS NULL") for c in NULLABLE], ("(any)", " OR ".join(f"{c} IS NULL" for c in NULLABLE))]), "meter"))
def null_profile(spark, sf):
    return rounded(meter.null_profile(views.table(spark, sf, "meter"), NULLABLE))


@query("dist_clip", sql("""SELECT round(greatest(1.5e0, least(18e0, trip_distance * 1.609e0)), 6) AS dist_km, count(*) AS n FROM real GROUP BY 1""", "real"))
def dist_clip(spark, sf):
    return views.realistic(spark, sf).groupBy(F.round(synth.clipped_km(F.col("trip_distance")), 6).alias("dist_km")).agg(F.count("*").alias("n"))


@query("fare_per_mile", sql("SELECT 0.5e0 AS p, round(median(fare_amount / greatest(trip_distance, 0.2e0)), 6) AS value FROM real", "real"))
def fare_per_mile(spark, sf):
    df = views.realistic(spark, sf).select((F.col("fare_amount") / F.greatest("trip_distance", F.lit(0.2))).alias("per_mile"))
    return rounded(common.percentiles(df, "per_mile", [0.5]))


@query("describe", sql("""SELECT 'trip_distance' AS column_name, count(trip_distance) AS n, round(avg(trip_distance), 6) AS mean, round(stddev_samp(trip_distance), 6) AS std,
      round(min(trip_distance), 6) AS low, round(quantile_cont(trip_distance, 0.25), 6) AS q25, round(quantile_cont(trip_distance, 0.5), 6) AS q50, round(quantile_cont(trip_distance, 0.75), 6) AS q75, round(max(trip_distance), 6) AS high FROM real
    UNION ALL SELECT 'fare_amount', count(fare_amount), round(avg(fare_amount), 6), round(stddev_samp(fare_amount), 6),
      round(min(fare_amount), 6), round(quantile_cont(fare_amount, 0.25), 6), round(quantile_cont(fare_amount, 0.5), 6), round(quantile_cont(fare_amount, 0.75), 6), round(max(fare_amount), 6) FROM real
    UNION ALL SELECT 'duration_s', count(dur), round(avg(dur), 6), round(stddev_samp(dur), 6),
      min(dur)::DOUBLE, round(quantile_cont(dur, 0.25), 6), round(quantile_cont(dur, 0.5), 6), round(quantile_cont(dur, 0.75), 6), max(dur)::DOUBLE FROM real""", "real"))
def describe(spark, sf):
    return rounded(common.describe(views.realistic(spark, sf), ["trip_distance", "fare_amount", "duration_s"]))


# --- fingerprints of the source demand ---

@query("fingerprint_hour", sql("SELECT hour, count(*) AS n, round(count(*) / (SELECT count(*) FROM real)::DOUBLE, 9) AS p FROM real GROUP BY 1", "real"))
def fingerprint_hour(spark, sf):
    return rounded(synth.fingerprint(views.realistic(spark, sf), "hour"), 9)


@query("fingerprint_dow", sql("SELECT dow, count(*) AS n, round(count(*) / (SELECT count(*) FROM real)::DOUBLE, 9) AS p FROM real GROUP BY 1", "real"))
def fingerprint_dow(spark, sf):
    return rounded(synth.fingerprint(views.realistic(spark, sf), "dow"), 9)


@query("fingerprint_hour_dow", sql("SELECT hour, dow, count(*) AS n, round(count(*) / (SELECT count(*) FROM real)::DOUBLE, 9) AS p FROM real GROUP BY 1, 2", "real"))
def fingerprint_hour_dow(spark, sf):
    return rounded(synth.fingerprint(views.realistic(spark, sf), "hour", "dow"), 9)


@query("fingerprint_passengers", sql("SELECT passenger_count, count(*) AS n, round(count(*) / (SELECT count(*) FROM real)::DOUBLE, 9) AS p FROM real GROUP BY 1", "real"))
def fingerprint_passengers(spark, sf):
    return rounded(synth.fingerprint(views.realistic(spark, sf), "passenger_count"), 9)


HOURS_VALUES = ", ".join(f"({h}, {w}e0)" for h, w in enumerate(K.HOUR_WEIGHTS))
HOUR_GIVEN_DOW = {
    "local": f"SELECT col0 AS hour, col1 / (SELECT sum(col1) FROM (VALUES {HOURS_VALUES})) AS w FROM (VALUES {HOURS_VALUES})",
    "shift": "SELECT hour, sum((dow < 5)::INT) / (SELECT sum((dow < 5)::INT) FROM real)::DOUBLE AS wd, sum((dow >= 5)::INT) / (SELECT sum((dow >= 5)::INT) FROM real)::DOUBLE AS we FROM real GROUP BY 1",
    "mixed": """SELECT d.dow, l.hour, CASE WHEN d.dow >= 5 THEN 0.75e0 * l.w + 0.25e0 * coalesce(s.we, 0) ELSE 0.8e0 * l.w + 0.2e0 * coalesce(s.wd, 0) END AS p
        FROM local l CROSS JOIN (SELECT unnest(range(0, 7)) AS dow) d LEFT JOIN shift s ON s.hour = l.hour""",
    "hgd": "SELECT CAST(dow AS INT) AS dow, CAST(hour AS INT) AS hour, p / sum(p) OVER (PARTITION BY dow) AS p FROM mixed",
}


@query("hour_given_dow", sql("SELECT dow, hour, round(p, 9) AS p FROM hgd", "real", extra=HOUR_GIVEN_DOW))
def hour_given_dow(spark, sf):
    return rounded(synth.hour_given_dow(views.realistic(spark, sf).groupBy("hour", "dow").agg(F.count("*").alias("n"))), 9)


@query("zone_volume", sql("SELECT src_zone_id, volume FROM vol", "vol"))
def zone_volume(spark, sf):
    return synth.zone_volume(synth.zone_pairs(views.realistic(spark, sf)))


@query("volume_tiers", sql("SELECT src_zone_id, volume, tier FROM tiers", "tiers"))
def volume_tiers(spark, sf):
    return synth.volume_tiers(synth.zone_pairs(views.realistic(spark, sf))).select("src_zone_id", "volume", "tier")


@query("tier_summary", sql("SELECT tier, count(*) AS n_zones, CAST(sum(volume) AS BIGINT) AS total_volume FROM tiers GROUP BY 1", "tiers"))
def tier_summary(spark, sf):
    return synth.tier_summary(synth.zone_pairs(views.realistic(spark, sf)))


OD_TIER = {
    "odc": """SELECT o.tier AS o_tier, d.tier AS d_tier, count(*) AS n FROM real JOIN tiers o ON o.src_zone_id = PULocationID
        JOIN tiers d ON d.src_zone_id = DOLocationID GROUP BY 1, 2""",
    "odm": """SELECT a.t AS o_tier, b.t AS d_tier, coalesce(n, 0) AS n FROM (SELECT unnest(['A','B','C','D','E']) AS t) a
        CROSS JOIN (SELECT unnest(['A','B','C','D','E']) AS t) b LEFT JOIN odc ON o_tier = a.t AND d_tier = b.t""",
    "odp": """SELECT o_tier, d_tier, n, coalesce(n / nullif(sum(n) OVER (PARTITION BY o_tier), 0)::DOUBLE, 0) AS p,
        sum(n) OVER (PARTITION BY o_tier) / sum(n) OVER ()::DOUBLE AS origin_p FROM odm""",
}


@query("od_tier_matrix", sql("SELECT o_tier, d_tier, n, round(p, 9) AS p, round(origin_p, 9) AS origin_p FROM odp", "tiers", extra=OD_TIER))
def od_tier_matrix(spark, sf):
    return rounded(synth.tier_od(synth.zone_pairs(views.realistic(spark, sf))), 9)


@query("zone_bridge", sql("""SELECT src_zone_id, tier, zone_id, zone_name, round(population / sum(population) OVER (PARTITION BY src_zone_id)::DOUBLE, 9) AS weight
    FROM tiers JOIN zones ON ae_class = tier""", "tiers", "zones"))
def zone_bridge(spark, sf):
    return rounded(synth.zone_bridge(synth.volume_tiers(synth.zone_pairs(views.realistic(spark, sf))), views.zones(spark, sf)), 9)


@query("cdf_table", sql("""SELECT passenger_count, round(sum(n) OVER (ORDER BY passenger_count) / sum(n) OVER ()::DOUBLE, 9) AS cum_p
    FROM (SELECT passenger_count, count(*) AS n FROM real GROUP BY 1)""", "real"))
def cdf_table(spark, sf):
    fp = synth.fingerprint(views.realistic(spark, sf), "passenger_count")
    t = synth.cdf_table(fp, "passenger_count", "n")
    return rounded(t.select("passenger_count", "cum_p"), 9)
