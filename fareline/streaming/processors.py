"""Keyed state for the two operators Spark has no built-in form for.

Both keep small state per key, expire it, and read a micro-batch in chunks. The rows of one key in
one micro-batch are ordered before use; a trigger limit on the source
(``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) bounds how many that can be.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fareline import constants as K

INCREASING_SCHEMA = "taxi_id string, event_time timestamp, payload string"
OUTCOME_SCHEMA = "trip_id string, zone_id int, taxi_id string, ping_ms long, score double, status string, event_time timestamp"


def _ordered(rows: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    parts = [r for r in rows if len(r)]
    return pd.concat(parts, ignore_index=True).sort_values(by, kind="stable") if parts else pd.DataFrame()


class StrictlyIncreasing(StatefulProcessor):
    """Passes a row only if its event time is above all earlier arrivals of its key.

    Rows of a micro-batch are taken in order of arrival (record_time, record_no), as the batch form
    takes them, so the answer does not depend on how the input is cut. With ``forget``, which needs
    processing-time mode, a key that stays silent for the time to live is forgotten."""

    def __init__(self, forget: bool = False):
        self.forget = forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_us", "us long", K.GPS_STATE_TTL_S * 1000 if self.forget else None)

    def handleInputRows(self, key, rows, timerValues):
        batch = _ordered(rows, ["record_time", "record_no"])
        if batch.empty:
            return
        last = self.last.get()[0] if self.last.exists() else None
        us = batch["event_time"].astype("datetime64[us]").astype("int64")
        top = us.cummax().shift()
        if last is not None:
            top = top.fillna(last).clip(lower=last)
        keep = top.isna() | (us > top)
        newest = int(us.max()) if last is None else max(last, int(us.max()))
        self.last.update((newest,))
        yield batch[keep.to_numpy()][["taxi_id", "event_time", "payload"]]

    def close(self) -> None:
        pass


class ZoneMatcher(StatefulProcessor):
    """Vehicle pool of a zone: pings fill it, a match takes a vehicle out, 60 s of silence too."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pool = handle.getMapState("pool", "taxi_id string", "ms long, idle int")

    def handleInputRows(self, key, rows, timerValues):
        batch = _ordered(rows, ["ms", "kind", "trip_id", "taxi_id"])
        if batch.empty:
            return
        pool = {k[0]: (v[0], v[1]) for k, v in self.pool.iterator()}
        before = dict(pool)
        ttl = K.VEHICLE_TTL_S * 1000
        out = []
        for r in batch.itertuples():
            if r.kind == 0:
                if r.taxi_id not in pool or pool[r.taxi_id][0] <= r.ms:
                    pool[r.taxi_id] = (int(r.ms), int(r.idle))
                continue
            free = [(idle, taxi, ms) for taxi, (ms, idle) in pool.items() if 0 <= r.ms - ms < ttl]
            if free:
                idle, taxi, ms = min(free)
                del pool[taxi]
                score = K.SCORE_DISTANCE_WEIGHT * r.km + K.SCORE_IDLE_WEIGHT * idle
                out.append((r.trip_id, key[0], taxi, ms, score, "matched", r.event_time))
            else:
                out.append((r.trip_id, key[0], None, None, None, "no_vehicle", r.event_time))
        horizon = timerValues.getCurrentWatermarkInMs() - ttl
        pool = {k: v for k, v in pool.items() if v[0] > horizon}
        for taxi in before.keys() - pool.keys():
            self.pool.removeKey((taxi,))
        for taxi, v in pool.items():
            if before.get(taxi) != v:
                self.pool.updateValue((taxi,), v)
        if pool:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(max(v[0] for v in pool.values()) + ttl)
        yield _outcomes(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.pool.clear()
        yield _outcomes([])

    def close(self) -> None:
        pass


def _outcomes(rows: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=["trip_id", "zone_id", "taxi_id", "ping_ms", "score", "status", "event_time"])
    return df.astype({"zone_id": "int32", "ping_ms": "Int64", "score": "float64", "event_time": "datetime64[us]"})
