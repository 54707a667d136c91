"""Fixed domain values.

Everything in this file is a value that results depend on (boxes, limits, tariffs, weight
tables). They are stated plainly so that they can be checked by eye.
"""

# --- fixed values: boxes, (min, max) ---
TARGET_LAT = (33.450, 33.680)
TARGET_LON = (-7.720, -7.480)
SOURCE_LAT = (41.135, 41.174)
SOURCE_LON = (-8.650, -8.585)
METRO_LAT = (41.10, 41.25)
METRO_LON = (-8.72, -8.55)
URBAN_LAT = (41.08, 41.24)
URBAN_LON = (-8.73, -8.54)

# --- fixed values: physical and quality limits ---
EARTH_KM = 6371.0
KM_PER_DEG = 111.0
POINT_STEP_S = 15
MAX_SPEED_KMH = 150.0
REPLAY_MAX_SPEED_KMH = 120.0
SNAP_LIMIT_M = 333.0
SNAP_LIMIT_DEG = 0.003
TRIP_DURATION_S = (30, 10800)
CITY_REF_LAT = 33.57

# --- fixed values: matching and live fare ---
PICKUP_SPEED_KMH = 30.0
VEHICLE_TTL_S = 60
GPS_STATE_TTL_S = 300
SCORE_DISTANCE_WEIGHT = 0.7
SCORE_IDLE_WEIGHT = 0.3
IDLE_BELOW_KMH = 5
MIN_ETA_S = 60
LIVE_FARE_BASE = 10.0
LIVE_FARE_PER_KM = 3.0
UNAVAILABLE_STATUS = ("matched", "offline")
CITY = "casablanca"

# --- fixed values: time ---
DEMAND_WINDOW_S = 30
PEAK_HOURS = (8, 9, 13, 14, 17, 18)
POSITION_TTL_S = 86400
DEMAND_TTL_S = 604800
ARCHIVE_ZONE = "Africa/Casablanca"

# --- fixed values: quality gate ---
GATE_OUTSIDE_PCT = 10.0
GATE_CLAMPED_PCT = 12.0
GATE_GINI = 0.45
GATE_MIN_ZONES = 14

# --- fixed values: latitude bands (name, low, high), half-open ---
BANDS = (
    ("South", 33.45, 33.52),
    ("Mid-S", 33.52, 33.57),
    ("Center", 33.57, 33.62),
    ("North", 33.62, 33.68),
)

# --- fixed values: coast line control points (lat, westernmost land lon) ---
COAST = (
    (33.48, -7.715),
    (33.50, -7.700),
    (33.53, -7.680),
    (33.55, -7.670),
    (33.57, -7.665),
    (33.59, -7.670),
    (33.61, -7.680),
    (33.63, -7.685),
    (33.65, -7.690),
)
COAST_LON = -7.605
COAST_ALPHA = 0.3
CLAIM_SMOOTHING = 0.1
POLYGON_AREA_DEG2 = (0.0001, 0.010)

# --- fixed values: heuristic demand by hour, 0..23 ---
HEURISTIC_BASE = (15, 10, 8, 6, 5, 8, 20, 45, 70, 65, 50, 55, 60, 65, 70, 55, 50, 65, 70, 55, 45, 35, 25, 20)
HEURISTIC_WEEKEND = 0.85
HEURISTIC_BUSY = ((8, 9, 14), 1.3)
HEURISTIC_QUIET = ((1, 3, 16), 0.7)

# --- fixed values: request-rate multiplier by hour, 0..23; Friday 12-13 h factor ---
RATE_MULTIPLIER = (0.3, 0.2, 0.15, 0.1, 0.1, 0.2, 0.5, 3.0, 5.0, 4.0, 2.0, 1.5,
                   1.2, 1.0, 1.0, 1.5, 2.5, 4.5, 5.0, 3.5, 2.0, 1.5, 1.0, 0.5)
FRIDAY_NOON_FACTOR = 0.6

# --- fixed values: local hourly rhythm 0..23 and weekday weights Mon..Sun ---
HOUR_WEIGHTS = (0.020, 0.012, 0.008, 0.006, 0.008, 0.015, 0.035, 0.080, 0.090, 0.065, 0.050, 0.055,
                0.075, 0.080, 0.060, 0.050, 0.055, 0.075, 0.090, 0.085, 0.060, 0.040, 0.030, 0.022)
DOW_WEIGHTS = (1.00, 1.00, 1.00, 1.00, 1.10, 0.85, 0.80)

# --- fixed values: activity classes ---
CLASSES = ("A", "B", "C", "D", "E")
CLASS_MULTIPLIER = {"A": 1.8, "B": 1.3, "C": 1.0, "D": 0.7, "E": 0.5}
TIER_CUTS = (("A", 0.08), ("B", 0.33), ("C", 0.66), ("D", 0.92))
SCORE_WEIGHTS = {"commerce": 0.30, "density": 0.40, "diversity": 0.20, "transit": 0.10}
CLASS_ORIGIN_P = {"A": 0.35, "B": 0.30, "C": 0.20, "D": 0.10, "E": 0.05}
CLASS_DEST_P = {
    "A": {"A": 0.30, "B": 0.30, "C": 0.20, "D": 0.15, "E": 0.05},
    "B": {"A": 0.30, "B": 0.25, "C": 0.25, "D": 0.15, "E": 0.05},
    "C": {"A": 0.25, "B": 0.25, "C": 0.25, "D": 0.20, "E": 0.05},
    "D": {"A": 0.20, "B": 0.25, "C": 0.25, "D": 0.20, "E": 0.10},
    "E": {"A": 0.15, "B": 0.20, "C": 0.25, "D": 0.25, "E": 0.15},
}
ANCHOR_PULL = 0.80
ANCHOR_JITTER = 0.0015

# --- fixed values: prior density by zone id ---
ZONE_PRIOR = {1: 0.9, 2: 0.7, 3: 1.5, 4: 1.2, 5: 0.8, 6: 1.0, 7: 1.3, 8: 0.6,
              9: 0.9, 10: 1.4, 11: 1.5, 12: 0.7, 13: 1.1, 14: 1.3, 15: 0.8, 16: 0.6}

# --- fixed values: two-fleet tariff ---
SMALL_BASE, SMALL_KM_DAY, SMALL_KM_NIGHT, SMALL_MIN = 7.0, 1.80, 2.70, 10.0
LARGE_SEAT_BASE, LARGE_SEAT_KM, LARGE_MIN_SEATS, LARGE_MIN = 8.0, 1.35, 2, 25.0

# --- fixed values: synthetic demand ---
SMALL_P_NEAR, SMALL_P_FAR = 0.92, 0.58
SAME_ZONE_RESAMPLE_P = 0.55
SYNTH_SPEED_KMH = 22.0
SYNTH_DURATION_SIGMA = 0.12
SYNTH_DURATION_S = (90, 3600)
SYNTH_DIST_KM = (1.5, 18.0)
MILE_KM = 1.609
SYNTH_DAYS = 90
SYNTH_CALLS = (("app", 0.55), ("phone", 0.25), ("street", 0.20))
STREAM_CALLS = (("A", 0.12), ("B", 0.48), ("C", 0.40))
WEEKEND_BLEND, WEEKDAY_BLEND = 0.25, 0.20
NOISE_SIGMA = 0.0002
BLACKOUT_P = 0.05
BLACKOUT_S = (60, 180)
PING_STEP_S = 4

# --- fixed values: drift-tolerant trip files, (column, type or None) ---
METER_COLUMNS = (
    ("VendorID", "long"), ("tpep_pickup_datetime", None), ("tpep_dropoff_datetime", None),
    ("passenger_count", "long"), ("trip_distance", "double"), ("RatecodeID", "long"),
    ("store_and_fwd_flag", None), ("PULocationID", "long"), ("DOLocationID", "long"),
    ("payment_type", "long"), ("fare_amount", "double"), ("extra", "double"), ("mta_tax", "double"),
    ("tip_amount", "double"), ("tolls_amount", "double"), ("improvement_surcharge", "double"),
    ("total_amount", "double"), ("congestion_surcharge", "double"), ("airport_fee", "double"),
)

# --- fixed values: forecasting ---
MODEL_FEATURES = ("hour_of_day", "day_of_week", "is_weekend", "is_peak", "zone_idx", "slot_of_day",
                  "demand_lag_1d", "demand_lag_7d", "rolling_7d_mean")
LEAKY_FEATURE = "supply_demand_ratio"
