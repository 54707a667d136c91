"""Indicator queries on curated trips."""

from pyspark.sql import functions as F

from fareline.functions import geo
from fareline.operators import common, kpi, trips
from fareline.plans import views
from fareline.plans.ctes import hav, sql
from fareline.plans.registry import query, rounded
from fareline.sources.tables import grid_sql


@query("kpi_trips_per_zone", sql("""SELECT origin_zone, origin_zone_name, count(*) AS trip_count, round(avg(trip_duration_sec), 6) AS avg_duration_sec,
    round(avg(trip_distance_km), 6) AS avg_distance_km, count(DISTINCT taxi_id) AS unique_taxis FROM cur GROUP BY 1, 2""", "cur"))
def kpi_trips_per_zone(spark, sf):
    return rounded(kpi.trips_per_zone(views.curated(spark, sf)))


@query("kpi_hourly", sql("SELECT hour_of_day, count(*) AS trip_count, round(avg(trip_duration_sec), 6) AS avg_duration_sec FROM cur GROUP BY 1", "cur"))
def kpi_hourly(spark, sf):
    return rounded(kpi.hourly(views.curated(spark, sf)))


@query("kpi_peak_hours", sql("""SELECT hour_of_day, count(*) AS trip_count, round(avg(trip_duration_sec), 6) AS avg_duration_sec FROM cur
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""", "cur"))
def kpi_peak_hours(spark, sf):
    return rounded(kpi.peak_hours(views.curated(spark, sf)))


@query("kpi_daily", sql("""SELECT day_of_week, is_weekend, count(*) AS trip_count, round(avg(trip_duration_sec), 6) AS avg_duration_sec
    FROM cur GROUP BY 1, 2""", "cur"))
def kpi_daily(spark, sf):
    return rounded(kpi.weekday_pattern(views.curated(spark, sf)))


@query("kpi_zone_hour", sql("SELECT origin_zone, origin_zone_name, hour_of_day, count(*) AS trip_count FROM cur GROUP BY 1, 2, 3", "cur"))
def kpi_zone_hour(spark, sf):
    return kpi.zone_hour(views.curated(spark, sf))


@query("kpi_zone_hour_rollup", sql("SELECT origin_zone, hour_of_day, count(*) AS trip_count FROM cur GROUP BY ROLLUP (origin_zone, hour_of_day)", "cur"))
def kpi_zone_hour_rollup(spark, sf):
    return kpi.zone_hour(views.curated(spark, sf), rollup=True)


GAP = """SELECT * FROM (SELECT origin_zone, origin_zone_name, hour_of_day, count(*) AS demand, count(DISTINCT taxi_id) AS supply,
    round(count(DISTINCT taxi_id) / count(*)::DOUBLE, 6) AS coverage_ratio FROM cur GROUP BY 1, 2, 3) WHERE {}"""


@query("kpi_coverage_gaps", sql(GAP.format("supply / demand::DOUBLE < 0.9e0"), "cur"))
def kpi_coverage_gaps(spark, sf):
    return rounded(kpi.coverage_gaps(views.curated(spark, sf), ratio_below=0.9))


@query("kpi_coverage_few_vehicles", sql(GAP.format("supply < 25"), "cur"))
def kpi_coverage_few_vehicles(spark, sf):
    return rounded(kpi.coverage_gaps(views.curated(spark, sf), vehicles_below=25))


@query("kpi_call_type", sql("""SELECT call_type, count(*) AS trip_count, round(avg(trip_duration_sec), 6) AS avg_duration_sec,
    round(avg(trip_distance_km), 6) AS avg_distance_km FROM cur GROUP BY 1""", "cur"))
def kpi_call_type(spark, sf):
    return rounded(kpi.call_types(views.curated(spark, sf)))


@query("share_by_key", sql("SELECT call_type, count(*) AS n, round(count(*) / (SELECT count(*) FROM trips)::DOUBLE, 6) AS share FROM trips GROUP BY 1", "trips"))
def share_by_key(spark, sf):
    return rounded(kpi.key_share(views.table(spark, sf, "trips"), "call_type"))


@query("share_in_group", sql("""SELECT origin_zone, call_type, count(*) AS n,
    round(count(*) / sum(count(*)) OVER (PARTITION BY origin_zone)::DOUBLE, 6) AS share FROM cur GROUP BY 1, 2""", "cur"))
def share_in_group(spark, sf):
    per = views.curated(spark, sf).groupBy("origin_zone", "call_type").agg(F.count("*").alias("n"))
    return rounded(common.share(per, "n", ["origin_zone"]))


_PIVOT = ", ".join(f"count(*) FILTER (WHERE hour_of_day = {h}) AS h{h:02d}" for h in range(24))


@query("hour_dow_pivot", sql(f"SELECT day_of_week, {_PIVOT} FROM cur GROUP BY 1", "cur"))
def hour_dow_pivot(spark, sf):
    return kpi.hour_dow_pivot(views.curated(spark, sf))


@query("od_crosstab", sql("""SELECT o.zone_id AS origin_zone, d.zone_id AS dest_zone, coalesce(n, 0) AS trips,
      round(coalesce(coalesce(n, 0) / nullif(sum(coalesce(n, 0)) OVER (PARTITION BY o.zone_id), 0)::DOUBLE, 0), 6) AS row_share
    FROM zones o CROSS JOIN zones d LEFT JOIN (SELECT origin_zone, dest_zone, count(*) AS n FROM cur GROUP BY 1, 2) c
      ON c.origin_zone = o.zone_id AND c.dest_zone = d.zone_id""", "cur"))
def od_crosstab(spark, sf):
    return rounded(kpi.od_matrix(views.curated(spark, sf), views.zones(spark, sf)))


@query("top_corridors", sql("SELECT origin_zone, dest_zone, count(*) AS trips FROM cur GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10", "cur"))
def top_corridors(spark, sf):
    return kpi.top_corridors(views.curated(spark, sf))


@query("peak_trough", sql("""SELECT (SELECT hour_of_day FROM cur GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS peak,
    (SELECT hour_of_day FROM cur GROUP BY 1 ORDER BY count(*), 1 LIMIT 1) AS trough""", "cur"))
def peak_trough(spark, sf):
    return kpi.peak_and_trough(views.curated(spark, sf))


@query("avg_per_day", sql("""SELECT hour_of_day, count(*) AS total_trips, round(count(*) / (SELECT count(DISTINCT trip_date) FROM cur)::DOUBLE, 6) AS avg_trips_per_day,
    round((SELECT count(DISTINCT trip_date) FROM cur) / 7e0, 6) AS n_weeks FROM cur GROUP BY 1""", "cur"))
def avg_per_day(spark, sf):
    return rounded(kpi.avg_per_day(views.curated(spark, sf)))


@query("taxi_activity", sql("""SELECT count(*) AS entities, max(n) AS max_trips, min(n) AS min_trips, round(avg(n), 6) AS mean_trips,
    median(n)::DOUBLE AS median_trips FROM (SELECT taxi_id, count(*) AS n FROM trips GROUP BY 1)""", "trips"))
def taxi_activity(spark, sf):
    return rounded(kpi.entity_activity(views.table(spark, sf, "trips")))


@query("monthly_trips", sql("SELECT strftime(event_time, '%Y-%m') AS year_month, count(*) AS trips FROM trips GROUP BY 1", "trips"))
def monthly_trips(spark, sf):
    return kpi.monthly(views.table(spark, sf, "trips"))


@query("top_stands", sql("SELECT stand, count(*) AS trips FROM trips WHERE call_type = 'B' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", "trips"))
def top_stands(spark, sf):
    return kpi.top_stands(views.table(spark, sf, "trips"))


@query("band_hour_share", sql("""SELECT round(avg((hour_of_day BETWEEN 7 AND 9)::INT), 6) AS morning_share, round(avg((hour_of_day BETWEEN 17 AND 19)::INT), 6) AS evening_share,
    round(avg((day_of_week < 5)::INT), 6) AS weekday_share, round(avg((day_of_week >= 5)::INT), 6) AS weekend_share FROM cur""", "cur"))
def band_hour_share(spark, sf):
    return rounded(kpi.band_hour_share(views.curated(spark, sf)))


@query("duration_hist", sql("""SELECT CAST(floor(least(duration_s / 60e0, 60e0) / 5e0) AS BIGINT) AS bin, count(*) AS n,
    floor(least(duration_s / 60e0, 60e0) / 5e0) * 5e0 AS bin_start FROM trips GROUP BY 1, 3""", "trips"))
def duration_hist(spark, sf):
    df = views.table(spark, sf, "trips").withColumn("minutes", F.col("duration_s") / 60)
    return kpi.histogram(df, "minutes", 5.0, 60.0)


@query("duration_cdf", sql("""SELECT value, n, round(sum(n) OVER (ORDER BY value) / (SELECT count(*) FROM trips)::DOUBLE, 6) AS cdf
    FROM (SELECT least(duration_s::DOUBLE, 3600e0) AS value, count(*) AS n FROM trips GROUP BY 1)""", "trips"))
def duration_cdf(spark, sf):
    return rounded(kpi.cdf(views.table(spark, sf, "trips"), "duration_s", 3600.0))


_P = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


@query("duration_percentiles", sql(" UNION ALL ".join(
    f"SELECT {p}::DOUBLE AS p, round(quantile_cont(duration_s, {p}), 6) AS value FROM trips" for p in _P), "trips"))
def duration_percentiles(spark, sf):
    return rounded(common.percentiles(views.table(spark, sf, "trips"), "duration_s", list(_P)))


@query("fare_percentiles_by_type", sql(" UNION ALL ".join(
    f"SELECT call_type, {p}::DOUBLE AS p, round(quantile_cont(fare, {p}), 8) AS value FROM trips GROUP BY 1" for p in _P), "trips"))
def fare_percentiles_by_type(spark, sf):
    return rounded(common.percentiles(views.table(spark, sf, "trips"), "fare", list(_P), ["call_type"]), 8)


@query("zone_in_out", sql("""SELECT zone_id, zone_name, ae_class, coalesce(p, 0) AS pickups, coalesce(d, 0) AS dropoffs, coalesce(p, 0) + coalesce(d, 0) AS total FROM zones
    LEFT JOIN (SELECT origin_zone, count(*) AS p FROM cur GROUP BY 1) a ON a.origin_zone = zone_id
    LEFT JOIN (SELECT dest_zone, count(*) AS d FROM cur GROUP BY 1) b ON b.dest_zone = zone_id""", "cur"))
def zone_in_out(spark, sf):
    return kpi.zone_in_out(views.curated(spark, sf), views.zones(spark, sf))


@query("same_zone_share", sql("SELECT origin_zone, count(*) AS trips, round(avg((origin_zone = dest_zone)::INT), 6) AS same_share FROM cur GROUP BY 1", "cur"))
def same_zone_share(spark, sf):
    return rounded(kpi.same_zone_share(views.curated(spark, sf)))


@query("per_capita", sql("""SELECT ae_class, count(*) AS n_zones, CAST(sum(population) AS BIGINT) AS population, CAST(coalesce(sum(n), 0) AS BIGINT) AS trips,
    round(coalesce(sum(n), 0)::DOUBLE / sum(population)::DOUBLE * 1000, 6) AS trips_per_1k
    FROM zones LEFT JOIN (SELECT origin_zone, count(*) AS n FROM cur GROUP BY 1) ON origin_zone = zone_id GROUP BY 1""", "cur"))
def per_capita(spark, sf):
    return rounded(kpi.per_capita(views.curated(spark, sf), views.zones(spark, sf)))


@query("relative_slice", sql("""SELECT trip_id, taxi_id, trip_date FROM
    (SELECT *, min(trip_date) OVER (PARTITION BY taxi_id) AS s FROM cur) WHERE trip_date < s + 7""", "cur"))
def relative_slice(spark, sf):
    return kpi.relative_slice(views.curated(spark, sf).select("trip_id", "taxi_id", "trip_date"), "taxi_id", "trip_date", 7)


@query("zones_seen", sql("SELECT DISTINCT origin_zone FROM cur", "cur"))
def zones_seen(spark, sf):
    return kpi.zones_seen(views.curated(spark, sf))


@query("cells_no_outbound", sql(f"""SELECT cell, zone_id FROM cellmap WHERE cell NOT IN (SELECT {grid_sql('lat', 'lon')} FROM requests)""", "cellmap", "requests"))
def cells_no_outbound(spark, sf):
    origins = views.requests(spark, sf).select(geo.grid_cell(F.col("origin_lat"), F.col("origin_lon")).alias("cell"))
    return common.missing_keys(views.lookup(spark, sf).select("cell", "zone_id"), origins, "cell")


@query("zones_no_outbound", sql("SELECT t.call_type, z.zone_id FROM (SELECT DISTINCT call_type FROM cur) t, zones z WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.call_type = t.call_type AND c.origin_zone = z.zone_id)", "cur", "zones"))
def zones_no_outbound(spark, sf):
    """Zones where no trip of a call type starts: every zone for each type seen, without the pairs that occur."""
    seen = views.curated(spark, sf).select("call_type", F.col("origin_zone").alias("zone_id")).distinct()
    kinds = seen.groupBy().agg(F.collect_set("call_type").alias("kinds"))  # three call types
    spine = views.zones(spark, sf).select("zone_id", F.explode(kinds.scalar()).alias("call_type"))
    return spine.join(seen, ["call_type", "zone_id"], "left_anti").select("call_type", "zone_id")


@query("etl_summary", sql("""SELECT count(*) AS n_trips, round(avg(trip_duration_sec), 6) AS avg_duration_sec, round(avg(trip_distance_km), 6) AS avg_distance_km,
    min(event_time) AS first_event, max(event_time) AS last_event, count(DISTINCT origin_zone) AS n_zones FROM cur""", "cur"))
def etl_summary(spark, sf):
    return rounded(trips.etl_summary(views.curated(spark, sf)))


@query("sample_by_hash", sql("""SELECT trip_id, taxi_id, call_type FROM trips
    ORDER BY ('0x' || substr(md5(concat('42|', trip_id)), 1, 8))::BIGINT, trip_id LIMIT 100""", "trips"))
def sample_by_hash(spark, sf):
    return kpi.sample_by_hash(views.table(spark, sf, "trips").select("trip_id", "taxi_id", "call_type"), "trip_id", 100, 42)


@query("trip_distance", sql("SELECT trip_id, round(trip_distance_km, 6) AS sphcos_km, round(" + hav("o_lat", "o_lon", "d_lat", "d_lon") + ", 6) AS hav_km, round(" + hav("o_lat", "o_lon", "d_lat", "d_lon") + ", 6) AS atan_km, round(sqrt(pow(o_lat - d_lat, 2) + pow(o_lon - d_lon, 2)) * 111, 6) AS flat_km FROM cur", "cur"))
def trip_distance(spark, sf):
    ends = [F.col(c) for c in ("o_lat", "o_lon", "d_lat", "d_lon")]
    return rounded(views.curated(spark, sf).select(
        "trip_id", F.col("trip_distance_km").alias("sphcos_km"), geo.haversine_km(*ends).alias("hav_km"),
        geo.haversine_atan_km(*ends).alias("atan_km"), geo.flat_km(*ends).alias("flat_km")))
