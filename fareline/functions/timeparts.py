"""Time expressions. Weekdays exist in two numberings: ``weekday`` 0 = Monday and
``dayofweek`` 1 = Sunday; both are offered because both conventions occur in the data."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareline import constants as K


def slot_of_day(ts: Column) -> Column:
    return (F.hour(ts) * 2 + F.when(F.minute(ts) >= 30, 1).otherwise(0)).cast("int")


def slot_hour(slot: Column) -> Column:
    return F.floor(slot / 2).cast("int")


def flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def is_weekend(ts: Column) -> Column:
    return flag(F.weekday(ts) >= 5)


def is_friday(ts: Column) -> Column:
    return flag(F.weekday(ts) == 4)


def is_peak(hour: Column) -> Column:
    return flag(hour.isin(*K.PEAK_HOURS))


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_iso(text: Column) -> Column:
    """ISO-8601 with ``Z`` or an offset; unparsable text gives null."""
    return F.try_to_timestamp(text)


def rebase(ts: Column, src_start: Column, dst_start: Column, speed: float) -> Column:
    """Map source time onto a new start at ``speed`` times real time."""
    gap = F.unix_micros(ts) - F.unix_micros(src_start)
    return F.timestamp_micros(F.unix_micros(dst_start) + F.floor(gap / F.lit(float(speed))).cast("long"))


def demand_multiplier(ts: Column) -> Column:
    table = F.array(*[F.lit(float(x)) for x in K.RATE_MULTIPLIER])
    base = F.element_at(table, F.hour(ts) + 1)
    noon = (F.weekday(ts) == 4) & F.hour(ts).between(12, 13)
    return F.when(noon, base * K.FRIDAY_NOON_FACTOR).otherwise(base)


def heuristic_demand(zone: Column, ts: Column) -> Column:
    """Hour curve scaled by weekend and zone popularity, one decimal."""
    base = F.element_at(F.array(*[F.lit(float(x)) for x in K.HEURISTIC_BASE]), F.hour(ts) + 1)
    weekend = F.when(F.weekday(ts) >= 5, K.HEURISTIC_WEEKEND).otherwise(1.0)
    busy_ids, busy = K.HEURISTIC_BUSY
    quiet_ids, quiet = K.HEURISTIC_QUIET
    zoned = F.when(zone.isin(*busy_ids), busy).when(zone.isin(*quiet_ids), quiet).otherwise(1.0)
    return F.round(base * weekend * zoned, 1)
