"""Sources and sinks, exercised end to end: derived rows are written to the shared scratch folder
and read back through the reader under test."""

from pyspark.sql import functions as F

from fareline import constants as K
from fareline.functions import timeparts
from fareline.operators import common, meter
from fareline.operators import zonefeatures as zf
from fareline.plans import views
from fareline.plans.ctes import sql
from fareline.plans.live_queries import NEED, NORM, normalized
from fareline.plans.registry import query, rounded
from fareline.plans.spatial_queries import POLY
from fareline.session import scratch
from fareline.sources import readers, sinks

CSV_COLS = ["TRIP_ID", "CALL_TYPE", "ORIGIN_CALL", "ORIGIN_STAND", "TAXI_ID", "TIMESTAMP", "DAY_TYPE", "MISSING_DATA", "POLYLINE"]


@query("src_trips_csv", sql("""SELECT TRIP_ID, CALL_TYPE, ORIGIN_CALL, ORIGIN_STAND, TAXI_ID, "TIMESTAMP", DAY_TYPE, trim(MISSING_DATA) AS MISSING_DATA, nullif(POLYLINE, '') AS POLYLINE FROM raw_trips""", "raw_trips"))
def src_trips_csv(spark, sf):
    path = scratch(spark, "trips-csv")
    sinks.write_csv(views.table(spark, sf, "raw_trips").select(*CSV_COLS), path)
    back = readers.read_trips_csv(spark, path)
    return back.withColumns({"MISSING_DATA": F.trim("MISSING_DATA"), "POLYLINE": F.nullif(F.col("POLYLINE"), F.lit(""))})


def _drifting(spark, sf) -> list[str]:
    """The metered trips as three files whose types and one column name differ."""
    m = views.table(spark, sf, "meter").withColumn("part", F.month("tpep_pickup_datetime") % 3)
    root = scratch(spark, "meter")
    shapes = [
        {"passenger_count": "double", "RatecodeID": "double"},
        {"VendorID": "int", "PULocationID": "int", "DOLocationID": "int"},
        {"VendorID": "int"},
    ]
    paths = []
    for i, casts in enumerate(shapes):
        df = m.where(F.col("part") == i).drop("part").withColumns({c: F.col(c).cast(t) for c, t in casts.items()})
        if i:
            df = df.withColumnRenamed("airport_fee", "Airport_fee")
        path = f"{root}/trips_part-{i}.parquet"
        df.write.parquet(path)
        paths.append(path)
    return paths


NUMS = [c for c, t in K.METER_COLUMNS if t]
ALL19 = ", ".join(f"round({c}, 6) AS {c}" if t == "double" else c for c, t in K.METER_COLUMNS)


@query("scan_drift_normalized", sql(f"SELECT {ALL19} FROM meter", "meter"))
def scan_drift_normalized(spark, sf):
    return rounded(readers.read_normalized(spark, _drifting(spark, sf)))


@query("nyc_union", sql("SELECT PULocationID, count(*) AS trips, CAST(sum(passenger_count) AS BIGINT) AS passengers FROM clean GROUP BY 1", "clean"))
def nyc_union(spark, sf):
    merged = common.union_all([readers.normalize(spark.read.parquet(p)) for p in _drifting(spark, sf)])
    return meter.clean_trips(merged).groupBy("PULocationID").agg(F.count("*").alias("trips"), F.sum("passenger_count").alias("passengers"))


@query("schema_drift_report", """SELECT * FROM (VALUES
    ('part-1', 'Airport_fee', 'extra', NULL, 'double'), ('part-1', 'airport_fee', 'missing', 'double', NULL), ('part-1', 'DOLocationID', 'type', 'bigint', 'int'),
    ('part-1', 'PULocationID', 'type', 'bigint', 'int'), ('part-1', 'RatecodeID', 'type', 'double', 'bigint'), ('part-1', 'VendorID', 'type', 'bigint', 'int'), ('part-1', 'passenger_count', 'type', 'double', 'bigint'),
    ('part-2', 'Airport_fee', 'extra', NULL, 'double'), ('part-2', 'airport_fee', 'missing', 'double', NULL),
    ('part-2', 'RatecodeID', 'type', 'double', 'bigint'), ('part-2', 'VendorID', 'type', 'bigint', 'int'), ('part-2', 'passenger_count', 'type', 'double', 'bigint')) t(file, column_name, change, first_type, this_type)""")
def schema_drift_report(spark, sf):
    frames = {f"part-{i}": spark.read.parquet(p) for i, p in enumerate(_drifting(spark, sf))}
    return readers.drift_report(frames)


@query("scan_tagged", sql("""SELECT concat('part-', CAST(month(tpep_pickup_datetime) % 3 AS VARCHAR)) AS source_tag, count(*) AS trips, round(avg(fare_amount), 6) AS avg_fare FROM meter GROUP BY 1""", "meter"))
def scan_tagged(spark, sf):
    tagged = common.union_all([
        readers.read_tagged(spark, p, ["trip_distance", "fare_amount"], r"trips_([^/]+)\.parquet/") for p in _drifting(spark, sf)])
    return rounded(tagged.groupBy("source_tag").agg(F.count("*").alias("trips"), F.avg("fare_amount").alias("avg_fare")))


def _month_table(spark, sf):
    path = scratch(spark, "curated")
    cur = views.curated(spark, sf).select("trip_id", "origin_zone", "dest_zone", "fare", timeparts.year_month(F.col("event_time")).alias("year_month"))
    sinks.write_partitioned(cur, path, "year_month", salt=8)
    return path


@query("sink_partitioned", sql("SELECT trip_id, origin_zone, dest_zone, round(fare, 6) AS fare, strftime(event_time, '%Y-%m') AS year_month FROM cur", "cur"))
def sink_partitioned(spark, sf):
    return rounded(readers.read_partitioned(spark, _month_table(spark, sf)).withColumn("year_month", F.col("year_month").cast("string")))


@query("scan_partitioned", sql("SELECT origin_zone, count(*) AS trips FROM cur WHERE strftime(event_time, '%Y-%m') = '2024-02' GROUP BY 1", "cur"))
def scan_partitioned(spark, sf):
    df = readers.read_partitioned(spark, _month_table(spark, sf))
    return df.where(F.col("year_month") == "2024-02").groupBy("origin_zone").agg(F.count("*").alias("trips"))


@query("sink_csv", sql("SELECT CAST(zone_id AS VARCHAR) AS zone_id, zone_name, adjacent_zones FROM zones", "zones"))
def sink_csv(spark, sf):
    path = scratch(spark, "zones-csv")
    sinks.write_csv(views.zones(spark, sf).select("zone_id", "zone_name", "adjacent_zones"), path)
    return spark.read.option("header", True).csv(path)


@query("dim_zones_csv", sql("""SELECT zone_id, zone_name, round(lat_min, 6) AS lat_min, round(lat_max, 6) AS lat_max, round(lon_min, 6) AS lon_min, round(lon_max, 6) AS lon_max,
    round(centroid_lat, 6) AS centroid_lat, round(centroid_lon, 6) AS centroid_lon, adjacent_zones FROM zones""", "zones"))
def dim_zones_csv(spark, sf):
    path = scratch(spark, "zones-v3")
    z = views.zones(spark, sf)
    named = z.select("zone_id", F.col("zone_name").alias("arrondissement_name"), *[F.col(c).alias(f"casa_{c}") for c in (
        "lat_min", "lat_max", "lon_min", "lon_max", "centroid_lat", "centroid_lon")], "adjacent_zones")
    sinks.write_csv(named, path)
    return rounded(readers.read_zones(spark, path))


@query("sink_json", sql("SELECT zone_id, lat_min AS south, lon_max AS east FROM zones", "zones"))
def sink_json(spark, sf):
    path = scratch(spark, "zones-json")
    z = views.zones(spark, sf).select("zone_id", F.struct("lat_min", "lat_max", "lon_min", "lon_max").alias("box"))
    sinks.write_json(z, path)
    back = spark.read.schema("zone_id INT, box STRUCT<lat_min: DOUBLE, lat_max: DOUBLE, lon_min: DOUBLE, lon_max: DOUBLE>").json(path)
    return back.select("zone_id", F.col("box.lat_min").alias("south"), F.col("box.lon_max").alias("east"))


@query("json_event_decode", sql("""SELECT taxi_id, event_time, lat, lon, CASE WHEN event_id % 89 = 0 THEN 0e0 ELSE speed_kmh END AS speed_kmh, status, 'gps' AS _type FROM pings WHERE event_id % 97 <> 0""", "pings"))
def json_event_decode(spark, sf):
    return readers.decode_events(_ping_json(spark, sf), readers.PING_JSON, "gps").select("taxi_id", "event_time", "lat", "lon", "speed_kmh", "status", "_type")


def _ping_json(spark, sf):
    p = views.pings(spark, sf)
    body = F.to_json(F.struct(
        "taxi_id", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"), "lat", "lon",
        F.when(F.col("event_id") % 89 != 0, F.col("speed_kmh")).alias("speed_kmh"), "status", "cell", "snap_dist_m"))
    return p.select(F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("{oops "), body)).otherwise(body).alias("value"))


@query("dim_cells", sql("SELECT cell, zone_id, zone_name FROM cellmap", "cellmap"))
def dim_cells(spark, sf):
    path = scratch(spark, "cells-json")
    pairs = F.collect_list(F.struct(F.col("cell").cast("string"), F.struct("zone_id", F.col("zone_name").alias("name"))))
    views.lookup(spark, sf).agg(F.to_json(F.map_from_entries(pairs)).alias("value")).coalesce(1).write.text(path)
    return readers.read_cells(spark, path)


@query("dim_polygons", sql("SELECT zone_id, zone_name, CAST(zone_id * 11 AS VARCHAR) AS osm_id, round(area_deg2, 9) AS area_deg2 FROM areas", "zones", extra=POLY))
def dim_polygons(spark, sf):
    from fareline.functions import geo

    path = scratch(spark, "zones-geojson")
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct("zone_id", F.col("zone_name").alias("name"), (F.col("zone_id") * 11).cast("string").alias("osm_id")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array("outline").alias("coordinates")).alias("geometry"))
    fc = zf.zone_polygons(views.zones(spark, sf)).agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features"))).alias("value"))
    fc.coalesce(1).write.text(path)
    polys = readers.read_geojson(spark, path)
    return rounded(polys.select("zone_id", "zone_name", "osm_id", geo.ring_area(F.col("outline")).alias("area_deg2")), 9)


def _indicators(spark, sf):
    from fareline.sources.tables import base

    ind = base(spark, sf, "nation").join(base(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.concat(F.lit(" Indicator "), "r_name").alias("title"),
        F.when(F.col("n_nationkey") % 2 == 0, "Ensemble").otherwise("Urbain").alias("Milieu"),
        F.when(F.col("n_nationkey") % 3 == 0, "Ensemble").otherwise("Masculin").alias("Sexe"),
        F.when(F.col("n_nationkey") % 7 == 0, "n.d.").otherwise((F.col("n_nationkey") * 1.5).cast("string")).alias("v"))
    root = scratch(spark, "indicators")
    part = F.col("n_nationkey") % 3
    files = [
        (ind.where(part == 0).withColumnRenamed("v", "Valeur"), "a"),
        (ind.where(part == 1).withColumnRenamed("v", "Valeurs"), "b"),
        (ind.where(part == 2).withColumnRenamed("v", "Valeur").drop("Sexe"), "c"),
    ]
    for df, name in files:
        sinks.write_csv(df, f"{root}/{name}")
    return readers.read_indicators(spark, [f"{root}/{n}" for _, n in files]).withColumn("order_no", F.col("n_nationkey").cast("int"))


IND = """SELECT n_nationkey AS order_no, concat('Indicator ', r_name) AS title, CASE WHEN n_nationkey % 2 = 0 THEN 'Ensemble' ELSE 'Urbain' END AS milieu,
    CASE WHEN n_nationkey % 3 = 2 THEN NULL WHEN n_nationkey % 3 = 0 THEN 'Ensemble' ELSE 'Masculin' END AS sexe, CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE n_nationkey * 1.5e0 END AS value
    FROM nation JOIN region ON n_regionkey = r_regionkey"""


@query("scan_indicators", IND)
def scan_indicators(spark, sf):
    return _indicators(spark, sf).select("order_no", F.trim("title").alias("title"), F.col("Milieu").alias("milieu"), F.col("Sexe").alias("sexe"), "value")


@query("indicator_pick", f"SELECT title, milieu, sexe, arg_min(value, order_no) AS value FROM ({IND}) WHERE value IS NOT NULL GROUP BY 1, 2, 3")
def indicator_pick(spark, sf):
    return readers.pick_indicators(_indicators(spark, sf).select("order_no", "title", F.col("Milieu").alias("milieu"), F.col("Sexe").alias("sexe"), "value"))


@query("serving_upsert", sql("""SELECT zone_id, taxi_id, event_time, event_id FROM (SELECT *, row_number() OVER (PARTITION BY zone_id, taxi_id ORDER BY event_time DESC, event_id DESC) AS rn FROM norm) WHERE rn = 1""", *NEED, extra=NORM))
def serving_upsert(spark, sf):
    """Latest position per (zone, taxi), merged in two batches split by arrival time."""
    path = scratch(spark, "positions")
    rows = normalized(spark, sf).select("zone_id", "taxi_id", "event_time", "event_id").withColumn("version", F.struct("event_time", "event_id"))
    half = F.col("event_time") < F.lit("2024-01-01 00:30:00").cast("timestamp")
    for batch in (rows.where(half), rows.where(~half)):
        sinks.upsert(batch, path, ["zone_id", "taxi_id"], "zone_id", "version")
    return spark.read.parquet(path).select("zone_id", "taxi_id", "event_time", "event_id")


@query("insert_if_absent", sql("SELECT taxi_id, arg_min(event_id, (event_time, event_id)) AS event_id FROM pings GROUP BY 1", "pings"))
def insert_if_absent(spark, sf):
    """First ping per taxi, inserted in two batches: later batches never replace a row."""
    path = scratch(spark, "first-seen")
    rows = views.pings(spark, sf).select("taxi_id", "event_time", "event_id")
    half = F.col("event_time") < F.lit("2024-01-01 00:30:00").cast("timestamp")
    for batch in (rows.where(half), rows.where(~half)):
        sinks.insert_absent(batch, path, ["taxi_id"], [F.col("event_time"), F.col("event_id")])
    return spark.read.parquet(path).select("taxi_id", "event_id")


@query("archive_partitions", sql("""SELECT strftime(t, '%Y') AS year, strftime(t, '%m') AS month, strftime(t, '%d') AS day, strftime(t, '%H') AS hour, count(*) AS n FROM (
    SELECT timezone('Africa/Casablanca', timezone('UTC', event_time)) AS t FROM feed) GROUP BY 1, 2, 3, 4""", "feed"))
def archive_partitions(spark, sf):
    path = scratch(spark, "archive")
    sinks.write_archive(views.table(spark, sf, "feed").select("event_id", "event_time", "kind"), path)
    back = spark.read.schema("event_id BIGINT, event_time TIMESTAMP, kind STRING, year STRING, month STRING, day STRING, hour STRING").json(path)
    return back.groupBy("year", "month", "day", "hour").agg(F.count("*").alias("n"))
