"""Domain tables derived from the star-schema input.

The input tables are not mobility data, so each domain table is a projection of one of them by
integer arithmetic. Every projection is held once as SQL text with a few dialect holes: Spark runs
it here, and the comparison SQL reuses it as a CTE. The operators themselves are written twice,
independently. No row of an input table is left out.
"""

from pyspark.sql import DataFrame, SparkSession

from fareline.session import ensure_utc, spread

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

SPARK = {
    "us": lambda c: f"unix_micros(CAST({c} AS TIMESTAMP))",
    "ts": lambda us: f"timestamp_micros({us})",
    "date": lambda c: f"to_date({c})",
}
DUCK = {
    "us": lambda c: f"epoch_us({c})",
    "ts": lambda us: f"make_timestamp({us})",
    "date": lambda c: f"CAST({c} AS DATE)",
}

T0_US = 1704067200000000  # 2024-01-01T00:00:00Z


def _spread(key: str, mult: int, prime: int, low: str, span: str) -> str:
    """Pseudo-uniform position of a key in [low, low + span)."""
    return f"{low} + (({key} % {prime}) * {mult} % {prime}) / {prime}e0 * {span}"


def _lat(key: str, mult: int = 104729, prime: int = 10007) -> str:
    return _spread(key, mult, prime, "33.44e0", "0.25e0")


def _lon(key: str, mult: int = 1299709, prime: int = 10009) -> str:
    return _spread(key, mult, prime, "-7.73e0", "0.26e0")


def grid_sql(lat: str, lon: str, size: str = "0.005e0") -> str:
    return (
        f"CAST(floor(({lat} + 90e0) / {size}) AS BIGINT) * 1000000"
        f" + CAST(floor(({lon} + 180e0) / {size}) AS BIGINT)"
    )


def zones_sql(d) -> tuple[str, list[str]]:
    n = "n_nationkey"
    row = f"floor({n} / 5e0)"
    lat_min = f"33.45e0 + {row} * 0.046e0 + (CASE WHEN ({n} + 1) % 4 = 0 THEN 0.01e0 ELSE 0e0 END)"
    lat_max = f"33.45e0 + {row} * 0.046e0 + 0.052e0"
    lon_min = f"-7.72e0 + ({n} % 5) * 0.048e0"
    lon_max = f"-7.72e0 + ({n} % 5) * 0.048e0 + 0.054e0"
    near = ",".join(
        [
            f"CASE WHEN {n} >= 5 THEN CAST({n} - 4 AS STRING) END",
            f"CASE WHEN {n} % 5 > 0 THEN CAST({n} AS STRING) END",
            f"CASE WHEN {n} % 5 < 4 THEN CAST({n} + 2 AS STRING) END",
            f"CASE WHEN {n} < 20 THEN CAST({n} + 6 AS STRING) END",
            f"CASE WHEN {n} = 0 THEN '9' END",
        ]
    )
    return "nation", [
        f"{n} + 1 AS zone_id",
        "n_name AS zone_name",
        f"{lat_min} AS lat_min",
        f"{lat_max} AS lat_max",
        f"{lon_min} AS lon_min",
        f"{lon_max} AS lon_max",
        f"(({lat_min}) + ({lat_max})) / 2e0 AS centroid_lat",
        f"(({lon_min}) + ({lon_max})) / 2e0 AS centroid_lon",
        f"60000 + (({n} + 1) * 7919 % 500) * 1000 AS population",
        f"CASE WHEN {n} < 3 THEN 'A' WHEN {n} < 9 THEN 'B' WHEN {n} < 17 THEN 'C' WHEN {n} < 23 THEN 'D' ELSE 'E' END AS ae_class",
        f"concat_ws(',', {near}) AS adjacent_zones",
    ]


def trips_sql(d) -> tuple[str, list[str]]:
    k = "o_orderkey"
    day = f"CAST(floor(({d['us']('o_orderdate')} - 788918400000000) / 86400000000e0) AS BIGINT) % 60"
    us = f"{T0_US} + (({day}) * 86400 + ({k} % 86400) * 7919 % 86400) * 1000000"
    return "orders", [
        f"CAST({k} AS STRING) AS trip_id",
        f"{k} AS trip_key",
        f"concat('taxi_', lpad(CAST(({k} % 97) * 31 % 97 AS STRING), 4, '0')) AS taxi_id",
        "CAST(o_custkey AS STRING) AS rider_id",
        f"{d['ts'](us)} AS event_time",
        f"{_lat(k)} AS o_lat",
        f"{_lon(k)} AS o_lon",
        f"{_lat(k, 15485863, 10037)} AS d_lat",
        f"{_lon(k, 32452843, 10039)} AS d_lon",
        f"CAST(60 + ({k} % 3600) * 6151 % 3600 AS INT) AS duration_s",
        "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'A' WHEN '2' THEN 'B' WHEN '3' THEN 'B' ELSE 'C' END AS call_type",
        f"CAST({k} % 63 AS STRING) AS stand",
        "o_totalprice / 1000e0 AS fare",
    ]


def raw_trips_sql(d) -> tuple[str, list[str]]:
    """Trip rows as they come in a CSV: everything text. Every 50th trip is delivered twice."""
    k = "o_orderkey"
    n = f"({k} % 41)"
    lon = f"concat('-8.', CAST(8650 - ({k} * 31 + i) % 90 - 8000 AS STRING))"
    lat = f"concat('41.', lpad(CAST(90 + ({k} * 17 + i * 2) % 95 AS STRING), 3, '0'))"
    point = f"concat('[', {lon}, ', ', {lat}, ']')"
    if d is SPARK:
        body = f"array_join(transform(CASE WHEN {n} = 0 THEN CAST(array() AS ARRAY<BIGINT>) ELSE sequence(0L, {n} - 1) END, i -> {point}), ', ')"
        copies = f"explode(sequence(1, CASE WHEN {k} % 50 = 0 THEN 2 ELSE 1 END))"
    else:
        body = f"array_to_string(list_transform(range(0, {n}), lambda i: {point}), ', ')"
        copies = f"unnest(range(1, CASE WHEN {k} % 50 = 0 THEN 3 ELSE 2 END))"
    day = f"CAST(floor(({d['us']('o_orderdate')} - 788918400000000) / 86400000000e0) AS BIGINT) % 60"
    epoch = f"{T0_US // 1000000} + ({day}) * 86400 + ({k} % 86400) * 7919 % 86400"
    return "orders", [
        f"CAST({k} AS STRING) AS TRIP_ID",
        "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'A' WHEN '2' THEN 'B' WHEN '3' THEN 'B' ELSE 'C' END AS CALL_TYPE",
        "CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN CAST(o_custkey AS STRING) END AS ORIGIN_CALL",
        f"CASE WHEN substr(o_orderpriority, 1, 1) IN ('2', '3') THEN CAST({k} % 63 AS STRING) END AS ORIGIN_STAND",
        f"CAST(20000000 + ({k} % 97) * 31 % 97 AS STRING) AS TAXI_ID",
        f"CAST({epoch} AS STRING) AS TIMESTAMP",
        "'A' AS DAY_TYPE",
        f"CASE WHEN {k} % 23 = 0 THEN ' True' ELSE 'False' END AS MISSING_DATA",
        f"CASE WHEN {k} % 101 = 0 THEN '[[oops' WHEN {k} % 103 = 0 THEN '' ELSE concat('[', {body}, ']') END AS POLYLINE",
        f"{copies} AS delivery",
    ]


def meter_sql(d) -> tuple[str, list[str]]:
    pick = f"{d['us']('l_shipdate')} + ((l_orderkey % 86400) * 7919 + l_linenumber * 613) % 86400 * 1000000"
    drop = f"{pick} + (60 + (l_partkey % 3600) * 37 % 3600) * 1000000"
    return "lineitem", [
        "CAST(l_linenumber AS BIGINT) AS VendorID",
        f"{d['ts'](pick)} AS tpep_pickup_datetime",
        f"{d['ts'](drop)} AS tpep_dropoff_datetime",
        "CAST(l_linenumber % 7 AS BIGINT) AS passenger_count",
        "(l_quantity - 1e0) * 0.4e0 AS trip_distance",
        "CAST(l_linenumber % 6 + 1 AS BIGINT) AS RatecodeID",
        "CASE WHEN l_returnflag = 'R' THEN 'Y' WHEN l_returnflag = 'A' THEN 'N' END AS store_and_fwd_flag",
        "l_suppkey % 263 + 1 AS PULocationID",
        "l_partkey % 263 + 1 AS DOLocationID",
        "CAST(l_linenumber % 4 + 1 AS BIGINT) AS payment_type",
        "l_extendedprice / 200e0 AS fare_amount",
        "l_tax * 10e0 AS extra",
        "0.5e0 AS mta_tax",
        "l_discount * 50e0 AS tip_amount",
        "0e0 AS tolls_amount",
        "0.3e0 AS improvement_surcharge",
        "l_extendedprice / 200e0 + l_tax * 10e0 + l_discount * 50e0 + 0.8e0 AS total_amount",
        "2.5e0 AS congestion_surcharge",
        "CASE WHEN l_returnflag = 'R' THEN 1.25e0 ELSE 0e0 END AS airport_fee",
    ]


def _event_us(d) -> str:
    return f"{T0_US} + CAST(floor(({d['us']('ts')} - {T0_US}) / 720000e0) AS BIGINT) * 1000"


def events_sql(d) -> tuple[str, list[str]]:
    """One feed of vehicle positions and trip requests, told apart by ``kind``."""
    e = "event_id"
    us = _event_us(d)
    late = f"(CASE WHEN {e} * 37 % 20 = 0 THEN (60 + {e} % 120) * 1000000 ELSE 0 END)"
    return "events", [
        f"{e} AS event_id",
        "CASE WHEN event_type IN ('purchase', 'signup') THEN 'trip' ELSE 'gps' END AS kind",
        f"{d['ts'](us)} AS event_time",
        f"{d['ts'](f'{us} + {late}')} AS arrival",
        "concat('taxi_', lpad(CAST(user_id AS STRING), 4, '0')) AS taxi_id",
        f"CAST({e} AS STRING) AS trip_id",
        "concat('rider_', CAST(user_id AS STRING)) AS rider_id",
        f"{_lat(e)} AS lat",
        f"{_lon(e)} AS lon",
        f"{_lat(e, 15485863, 10037)} AS dest_lat",
        f"{_lon(e, 32452843, 10039)} AS dest_lon",
        "value AS speed_kmh",
        "CASE event_type WHEN 'error' THEN 'offline' WHEN 'click' THEN 'moving' ELSE 'pickup' END AS status",
        f"CAST(({e} % 400) * 37 % 400 AS DOUBLE) AS snap_dist_m",
        f"CASE WHEN {e} % 41 = 0 THEN NULL ELSE {grid_sql(_lat(e), _lon(e))} END AS cell",
    ]


def commerce_sql(d) -> tuple[str, list[str]]:
    k = "p_partkey"
    return "part", [
        f"{k} AS site_id",
        f"{_lat(k)} AS lat",
        f"{_lon(k)} AS lon",
        "p_size AS commerce_count",
        "p_retailprice / 100e0 AS commerce_weight",
        f"({k} % 1000) / 1000e0 AS opportunity",
        "concat(p_brand, '|', p_type) AS commerce_types",
    ]


def stops_sql(d) -> tuple[str, list[str]]:
    k = "s_suppkey"
    return "supplier", [
        f"{k} AS stop_id",
        f"{_lat(k)} AS lat",
        f"{_lon(k)} AS lon",
        f"CASE {k} % 5 WHEN 0 THEN 'tram' WHEN 1 THEN 'tram_stop' WHEN 2 THEN 'brt' WHEN 3 THEN 'brt_stop' ELSE 'other' END AS mode",
    ]


def nodes_sql(d) -> tuple[str, list[str]]:
    k = "c_custkey"
    return "customer", [f"{k} AS node_id", f"{_lat(k, 7919)} AS node_lat", f"{_lon(k, 6151)} AS node_lon"]


SPECS = {
    "zones": zones_sql,
    "trips": trips_sql,
    "raw_trips": raw_trips_sql,
    "meter": meter_sql,
    "feed": events_sql,
    "commerce": commerce_sql,
    "stops": stops_sql,
    "nodes": nodes_sql,
}


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain table as a DataFrame: one pruned scan and one projection."""
    source, exprs = SPECS[name](SPARK)
    rows = base(spark, sf_dir, source)
    if name == "raw_trips":  # building and parsing long text is worth all cores
        rows = spread(rows, "o_orderkey")
    return rows.selectExpr(*exprs)


def cte(name: str) -> str:
    """The same projection as comparison SQL."""
    source, exprs = SPECS[name](DUCK)
    return f"SELECT {', '.join(exprs)} FROM {source}"


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "feed").where("kind = 'gps'").select(
        "event_id", "event_time", "arrival", "taxi_id", "lat", "lon", "speed_kmh", "status", "snap_dist_m", "cell"
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "feed").where("kind = 'trip'").selectExpr(
        "event_id", "trip_id", "rider_id", "event_time", "arrival",
        "lat AS origin_lat", "lon AS origin_lon", "dest_lat", "dest_lon",
    )
