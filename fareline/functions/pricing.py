"""Fares and matching scores."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareline import constants as K


def live_fare(km: Column) -> Column:
    return F.round(F.lit(K.LIVE_FARE_BASE) + K.LIVE_FARE_PER_KM * F.greatest(F.lit(1.0), km), 2)


def pickup_eta_s(km: Column) -> Column:
    return F.greatest(F.lit(K.MIN_ETA_S), F.floor(km / K.PICKUP_SPEED_KMH * 3600).cast("int"))


def is_idle(speed: Column) -> Column:
    return F.when(F.coalesce(speed, F.lit(0.0)) < K.IDLE_BELOW_KMH, 1).otherwise(0)


def match_score(km: Column, idle: Column) -> Column:
    """Lower is better; standing still is a penalty."""
    return K.SCORE_DISTANCE_WEIGHT * km + K.SCORE_IDLE_WEIGHT * idle


def two_fleet_fare(km: Column, hour: Column, fleet: Column, passengers: Column) -> Column:
    night = (hour >= 21) | (hour < 6)
    per_km = F.when(night, K.SMALL_KM_NIGHT).otherwise(K.SMALL_KM_DAY)
    small = F.greatest(F.lit(K.SMALL_MIN), F.lit(K.SMALL_BASE) + per_km * km)
    seats = F.greatest(passengers, F.lit(K.LARGE_MIN_SEATS))
    large = F.greatest(F.lit(K.LARGE_MIN), (F.lit(K.LARGE_SEAT_BASE) + K.LARGE_SEAT_KM * km) * seats)
    return F.when(fleet == "petit", small).otherwise(large)
