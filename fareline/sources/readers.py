"""Readers with explicit schemas and tolerance for column drift."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline import constants as K

TRIP_CSV = T.StructType([T.StructField(c, T.StringType()) for c in (
    "TRIP_ID", "CALL_TYPE", "ORIGIN_CALL", "ORIGIN_STAND", "TAXI_ID", "TIMESTAMP", "DAY_TYPE", "MISSING_DATA", "POLYLINE")])

PING_JSON = "taxi_id STRING, trip_id STRING, event_time STRING, lat DOUBLE, lon DOUBLE, speed_kmh DOUBLE, status STRING, cell BIGINT, zone_id INT, snap_dist_m DOUBLE, _type STRING"
REQUEST_JSON = "trip_id STRING, rider_id STRING, origin_zone INT, origin_lat DOUBLE, origin_lon DOUBLE, destination_zone INT, dest_lat DOUBLE, dest_lon DOUBLE, event_time STRING, call_type STRING, _type STRING"


def read_trips_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header row, quoted fields, doubled quotes; every column stays text until it is needed."""
    return spark.read.schema(TRIP_CSV).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone dimension from either column layout; missing variants are taken as null."""
    raw = spark.read.option("header", True).csv(path)

    def pick(kind, *names):
        have = [F.col(n) for n in names if n in raw.columns]
        return (F.coalesce(*have) if have else F.lit(None)).cast(kind)

    zid = pick("int", "zone_id")
    return raw.select(
        zid.alias("zone_id"),
        F.coalesce(pick("string", "name", "arrondissement_name"), F.concat(F.lit("Zone "), zid.cast("string"))).alias("zone_name"),
        *[pick("double", f"casa_{c}", c).alias(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max")],
        pick("double", "centroid_lat", "casa_centroid_lat").alias("centroid_lat"),
        pick("double", "centroid_lon", "casa_centroid_lon").alias("centroid_lon"),
        pick("string", "adjacent_zones").alias("adjacent_zones"),
    )


def normalize(df: DataFrame, spec=K.METER_COLUMNS) -> DataFrame:
    """Match columns without regard to case, cast to the widest type, keep the listed columns."""
    by_lower = {c.lower(): c for c in df.columns}
    out = []
    for name, kind in spec:
        col = F.col(f"`{by_lower[name.lower()]}`") if name.lower() in by_lower else F.lit(None)
        out.append((col.cast(kind) if kind else col).alias(name))
    return df.select(*out)


def read_normalized(spark: SparkSession, paths: list[str], spec=K.METER_COLUMNS) -> DataFrame:
    """Per-file read and normalisation, then one union: a single read would fail on type drift."""
    return reduce(DataFrame.unionByName, [normalize(spark.read.parquet(p), spec) for p in paths])


def drift_report(frames: dict[str, DataFrame]) -> DataFrame:
    """Schema differences of every file against the first one. Works on schemas alone."""
    names = list(frames)
    first = dict(frames[names[0]].dtypes)
    spark = frames[names[0]].sparkSession
    rows = []
    for name in names[1:]:
        other = dict(frames[name].dtypes)
        rows += [(name, c, "extra", None, other[c]) for c in sorted(other.keys() - first.keys())]
        rows += [(name, c, "missing", first[c], None) for c in sorted(first.keys() - other.keys())]
        rows += [(name, c, "type", first[c], other[c]) for c in sorted(first.keys() & other.keys()) if first[c] != other[c]]
    return spark.createDataFrame(rows, "file string, column_name string, change string, first_type string, this_type string")


def read_tagged(spark: SparkSession, path: str, cols: list[str], pattern: str = r"([^/]+)\.parquet$") -> DataFrame:
    """Column-pruned read with a tag cut out of each file's path."""
    return spark.read.parquet(path).select(*cols, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).alias("source_tag"))


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object ``{cell: {zone_id, name}}`` to rows."""
    text = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "map<string, struct<zone_id:int,name:string>>")
    return text.select(F.explode(parsed).alias("cell", "z")).select(
        F.col("cell").cast("long").alias("cell"), F.col("z.zone_id").alias("zone_id"), F.col("z.name").alias("zone_name"))


GEOJSON = ("type STRING, features ARRAY<STRUCT<type: STRING, properties: STRUCT<zone_id: INT, name: STRING, osm_id: STRING>,"
           " geometry: STRUCT<type: STRING, coordinates: ARRAY<ARRAY<ARRAY<DOUBLE>>>>>>")


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """FeatureCollection of polygons: one row per feature with its outer ring."""
    fc = spark.read.schema(GEOJSON).option("multiLine", True).json(path)
    return fc.select(F.explode("features").alias("f")).select(
        F.col("f.properties.zone_id").alias("zone_id"), F.col("f.properties.name").alias("zone_name"),
        F.col("f.properties.osm_id").alias("osm_id"), F.element_at("f.geometry.coordinates", 1).alias("outline"))


def read_indicators(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Indicator CSVs whose value column is spelled two ways and whose ``Sexe`` may be absent."""
    frames = []
    for p in paths:
        df = spark.read.option("header", True).csv(p)
        value = next(c for c in df.columns if c.startswith("Valeur"))
        frames.append(df.withColumn("value", F.col(value).try_cast("double")).drop(value))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def pick_indicators(df: DataFrame) -> DataFrame:
    """First known value per (title, milieu, sexe), trimmed titles; ``order_no`` fixes 'first'."""
    return (
        df.where("value IS NOT NULL")
        .groupBy(F.trim("title").alias("title"), "milieu", "sexe")
        .agg(F.min_by("value", "order_no").alias("value"))
    )


def decode_events(df: DataFrame, schema: str, kind: str, value: str = "value", record_time: str | None = None) -> DataFrame:
    """JSON text to columns. Unparsable rows are dropped, missing fields take their defaults, and rows
    without a type are positions. Rows without a readable event time are dropped, or take the broker's
    ``record_time`` where that column is named."""
    others = [c for c in df.columns if c != value]
    bad = "_bad"
    e = F.from_json(value, f"{schema}, {bad} STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    out = df.select(*others, e.alias("e")).where(f"e IS NOT NULL AND e.{bad} IS NULL").select(*others, "e.*").drop(bad)
    parsed = F.try_to_timestamp("event_time")
    out = out.withColumn("event_time", F.coalesce(parsed, F.col(record_time)) if record_time else parsed).where("event_time IS NOT NULL")
    if kind == "gps":
        return out.withColumns({
            "_type": F.coalesce("_type", F.lit("gps")),
            "speed_kmh": F.coalesce("speed_kmh", F.lit(0.0)),
            "taxi_id": F.coalesce("taxi_id", F.lit("unknown")),
            "status": F.coalesce("status", F.lit("unknown")),
            "zone_id": F.coalesce("zone_id", F.lit(0)),
        })
    return out.withColumns({
        "_type": F.lit("trip"),
        "origin_zone": F.coalesce("origin_zone", F.lit(0)),
        "destination_zone": F.coalesce("destination_zone", F.lit(0)),
        "rider_id": F.coalesce("rider_id", F.lit("unknown")),
    })


def read_events(spark: SparkSession, source: str, **options) -> DataFrame:
    """Streaming text events: ``value``, ``record_time`` and ``record_no``, the time and place of
    arrival. ``kafka`` needs its connector on the class path; ``text`` reads a folder of JSON lines,
    which carry fields of those names where arrival matters."""
    reader = spark.readStream.format(source)
    if source == "kafka":
        options = {"startingOffsets": "earliest", **options}
    for k, v in options.items():
        reader = reader.option(k, v)
    stream = reader.load()
    if source == "kafka":
        return stream.selectExpr("CAST(value AS STRING) AS value", "timestamp AS record_time", "lpad(CAST(offset AS STRING), 20, '0') AS record_no")
    return stream.select("value", F.try_to_timestamp(F.get_json_object("value", "$.record_time")).alias("record_time"), F.get_json_object("value", "$.record_no").alias("record_no"))
