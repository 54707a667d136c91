"""Shared CTEs of the comparison SQL."""

from fareline.sources import tables

HAV = (
    "12742.0e0 * asin(sqrt(pow(sin(radians(({b}) - ({a})) / 2), 2)"
    " + cos(radians({a})) * cos(radians({b})) * pow(sin(radians(({d}) - ({c})) / 2), 2)))"
)


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return HAV.format(a=lat1, c=lon1, b=lat2, d=lon2)


def zone_of(lat: str, lon: str, agg: str = "min", cols: str = "zone_id") -> str:
    return (
        f"(SELECT {agg}(z.{cols}) FROM zones z WHERE {lat} BETWEEN z.lat_min AND z.lat_max"
        f" AND {lon} BETWEEN z.lon_min AND z.lon_max)"
    )


def remap_sql(v: str, src: tuple, dst: tuple) -> str:
    return (
        f"(greatest(0e0, least(1e0, ({v} - ({src[0]}e0)) / ({src[1] - src[0]!r}::DOUBLE))) * ({dst[1] - dst[0]!r}::DOUBLE) + ({dst[0]}e0))"
    )


def u32(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT)"


def uni(row: str, stream: str, seed: int) -> str:
    return f"({u32(f"concat('{seed}|{stream}|', CAST({row} AS VARCHAR))")} / 4294967296.0e0)"


def gauss(row: str, stream: str, seed: int) -> str:
    return (
        f"(sqrt(-2e0 * ln(1e0 - {uni(row, stream + '.a', seed)})) * cos(6.283185307179586e0 * {uni(row, stream + '.b', seed)}))"
    )


CTES: dict[str, tuple[str, tuple[str, ...]]] = {name: (tables.cte(name), ()) for name in tables.SPECS}

CTES["pings"] = ("SELECT * FROM feed WHERE kind = 'gps'", ("feed",))
CTES["requests"] = ("SELECT *, lat AS origin_lat, lon AS origin_lon FROM feed WHERE kind = 'trip'", ("feed",))
CTES["cur0"] = (
    f"SELECT t.*, {zone_of('o_lat', 'o_lon')} AS origin_zone, {zone_of('d_lat', 'd_lon')} AS dest_zone FROM trips t",
    ("zones", "trips"),
)
CTES["cur"] = (
    """SELECT c.*, zo.zone_name AS origin_zone_name, zd.zone_name AS dest_zone_name,
        duration_s AS trip_duration_sec,
        6371.0e0 * acos(least(1e0, sin(radians(o_lat)) * sin(radians(d_lat)) + cos(radians(o_lat)) * cos(radians(d_lat)) * cos(radians(d_lon) - radians(o_lon)))) AS trip_distance_km,
        CAST(hour(event_time) AS INT) AS hour_of_day, CAST(isodow(event_time) - 1 AS INT) AS day_of_week,
        CASE WHEN isodow(event_time) >= 6 THEN 1 ELSE 0 END AS is_weekend,
        CASE WHEN isodow(event_time) = 5 THEN 1 ELSE 0 END AS is_friday,
        CAST(event_time AS DATE) AS trip_date,
        CAST(hour(event_time) * 2 + CASE WHEN minute(event_time) >= 30 THEN 1 ELSE 0 END AS INT) AS slot_of_day
    FROM cur0 c JOIN zones zo ON zo.zone_id = origin_zone JOIN zones zd ON zd.zone_id = dest_zone""",
    ("zones", "cur0"),
)
CTES["slots"] = (
    """SELECT origin_zone, trip_date, slot_of_day, count(*) AS demand, count(DISTINCT taxi_id) AS supply,
        min(day_of_week) AS day_of_week, min(is_weekend) AS is_weekend, CAST(slot_of_day // 2 AS INT) AS hour_of_day
    FROM cur GROUP BY ALL""",
    ("cur",),
)
CTES["slots"] = (CTES["slots"][0].replace("GROUP BY ALL", "GROUP BY origin_zone, trip_date, slot_of_day"), ("cur",))
CTES["feats"] = (
    """SELECT *, CASE WHEN hour_of_day IN (8, 9, 13, 14, 17, 18) THEN 1 ELSE 0 END AS is_peak,
        CASE WHEN demand > 0 THEN supply::DOUBLE / demand ELSE 0e0 END AS supply_demand_ratio FROM (
      SELECT *, lag(demand, 1) OVER w AS demand_lag_1d, lag(demand, 7) OVER w AS demand_lag_7d,
        avg(demand) OVER (PARTITION BY origin_zone, slot_of_day ORDER BY trip_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_7d_mean
      FROM slots WINDOW w AS (PARTITION BY origin_zone, slot_of_day ORDER BY trip_date))
    WHERE demand_lag_1d IS NOT NULL AND demand_lag_7d IS NOT NULL AND rolling_7d_mean IS NOT NULL""",
    ("slots",),
)
CTES["clean"] = (
    """SELECT * FROM meter WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
        AND trip_distance > 0 AND trip_distance < 100 AND fare_amount > 0 AND fare_amount < 500
        AND passenger_count > 0 AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL""",
    ("meter",),
)
CTES["mfeat"] = (
    """SELECT *, CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour, CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
        CAST(dayofweek(tpep_pickup_datetime) + 1 AS INT) AS day_of_week,
        CASE WHEN dayofweek(tpep_pickup_datetime) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
        strftime(tpep_pickup_datetime, '%Y-%m') AS year_month,
        CAST(epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime) AS INT) AS trip_duration_sec
    FROM clean""",
    ("clean",),
)
CTES["demand"] = (
    """SELECT PULocationID AS pickup_zone_id, pickup_hour, pickup_date, day_of_week, is_weekend,
        count(*) AS trip_count, avg(trip_distance) AS avg_distance, avg(fare_amount) AS avg_fare,
        avg(trip_duration_sec) AS avg_duration_sec, CAST(sum(passenger_count) AS BIGINT) AS total_passengers
    FROM mfeat GROUP BY 1, 2, 3, 4, 5""",
    ("mfeat",),
)
CTES["real"] = (
    """SELECT * FROM (SELECT *, epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime) AS dur,
            CAST(hour(tpep_pickup_datetime) AS INT) AS hour, CAST(isodow(tpep_pickup_datetime) - 1 AS INT) AS dow FROM meter)
        WHERE trip_distance BETWEEN 0.2e0 AND 60 AND fare_amount BETWEEN 2.5e0 AND 250 AND passenger_count BETWEEN 1 AND 6
        AND dur BETWEEN 60 AND 10800 AND (CASE WHEN dur > 0 THEN trip_distance / (dur / 3600e0) ELSE 0 END) BETWEEN 3 AND 90
        AND PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263 AND year(tpep_pickup_datetime) = 1998""",
    ("meter",),
)
CTES["vol"] = (
    """SELECT loc AS src_zone_id, count(*) AS volume FROM
        (SELECT PULocationID AS loc FROM real UNION ALL SELECT DOLocationID FROM real) GROUP BY 1""",
    ("real",),
)
CTES["tiers"] = (
    """SELECT *, CASE WHEN q <= 0.08e0 THEN 'A' WHEN q <= 0.33e0 THEN 'B' WHEN q <= 0.66e0 THEN 'C' WHEN q <= 0.92e0 THEN 'D' ELSE 'E' END AS tier
    FROM (SELECT *, (row_number() OVER (ORDER BY volume DESC, src_zone_id) - 1) / (count(*) OVER () - 1)::DOUBLE AS q FROM vol)""",
    ("vol",),
)
CTES["pts"] = (
    """SELECT TRIP_ID, CALL_TYPE, ORIGIN_CALL, ORIGIN_STAND, TAXI_ID, CAST("TIMESTAMP" AS BIGINT) AS epoch, DAY_TYPE, MISSING_DATA,
        upper(trim(MISSING_DATA)) <> 'TRUE' AS complete, TRY_CAST(POLYLINE AS DOUBLE[][]) AS points, delivery FROM raw_trips""",
    ("raw_trips",),
)
CTES["pts1"] = ("SELECT * FROM pts WHERE delivery = 1", ("pts",))
CTES["good"] = ("SELECT * FROM pts1 WHERE complete AND len(points) >= 2", ("pts1",))
CTES["cellmap0"] = (
    f"""SELECT zone_id, zone_name, r * 1000000 + c AS cell, (r + 0.5e0) * 0.005e0 - 90e0 AS cell_lat, (c + 0.5e0) * 0.005e0 - 180e0 AS cell_lon FROM (
        SELECT *, unnest(range(CAST(floor((lon_min + 180e0) / 0.005e0) AS BIGINT), CAST(floor((lon_max + 180e0) / 0.005e0) AS BIGINT) + 1)) AS c FROM (
        SELECT *, unnest(range(CAST(floor((lat_min + 90e0) / 0.005e0) AS BIGINT), CAST(floor((lat_max + 90e0) / 0.005e0) AS BIGINT) + 1)) AS r FROM zones))
      WHERE (r + 0.5e0) * 0.005e0 - 90e0 BETWEEN lat_min AND lat_max AND (c + 0.5e0) * 0.005e0 - 180e0 BETWEEN lon_min AND lon_max""",
    ("zones",),
)
CTES["cellmap"] = (
    "SELECT cell, min(zone_id) AS zone_id, arg_min(zone_name, zone_id) AS zone_name FROM cellmap0 GROUP BY cell",
    ("cellmap0",),
)


def sql(select: str, *needs: str, extra: dict[str, str] | None = None) -> str:
    """``select`` preceded by the CTEs it needs, in dependency order."""
    order: list[str] = []

    def visit(name):
        if name in order:
            return
        for dep in CTES[name][1]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    parts = [f"{n} AS ({CTES[n][0]})" for n in order] + [f"{n} AS ({s})" for n, s in (extra or {}).items()]
    return ("WITH " + ", ".join(parts) + " " if parts else "") + select
