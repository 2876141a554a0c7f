"""Stateful closure status: counters, k and the mean are carried over micro-batches per segment.

Rows wait in state until the watermark has passed them, so a segment's rows are taken in time
order however they arrive within the allowed lateness. They wait in hours, one packed value each:
a batch of any size is put away frame by frame, and only one hour of a segment is in memory when
its turn comes. A segment that stays silent starts anew, and a timer drops its state.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from roadflow import config as cfg
from roadflow.session import ship_package

STATE_SCHEMA = (
    "mean double, k double, zeros int, low int, q_zeros double, q_low double, last_time timestamp"
)
OUTPUT_SCHEMA = (
    "segment_id string, time timestamp, fcd int, consecutive_zeros int, consecutive_low int, "
    "running_mean double, segment_closure_status string, late boolean"
)
#: Microseconds of the unit in which rows wait.
HOUR = 3_600_000_000
_VALUES = ["fcd", "fcd_mean_median", "max_consecutive_zeros_q95", "max_consecutive_zeros_or_ones_q95"]
_EPOCH = pd.Timestamp(0)


def _status(mean: float) -> str:
    if mean < cfg.OPEN_BELOW:
        return "open"
    return "closed" if mean > cfg.CLOSED_ABOVE else "undetermined"


def _next_mean(mean: float, fcd: float, usual: float | None, run: int, before: int, limit: float) -> float:
    if limit > cfg.MAX_PROFILE and run > limit:
        return mean
    if run == 0 and before < limit:
        p, w, x = limit, fcd, before / (2 * limit)
    elif run != 0:
        ratio = run / (2 * limit)
        p, w, x = limit, max(1.0, ratio * ratio), max(mean, min(1.0, ratio))
    elif usual is not None and usual - fcd > cfg.COVERAGE_DROP:
        p, w, x = cfg.MIN_PROFILE, cfg.DROP_WEIGHT, 1.0
    elif fcd > cfg.COVERAGE_HIGH:
        p, w, x = cfg.MIN_PROFILE, fcd, 0.0
    else:
        return mean
    return (p * mean + w * x) / (p + w)



def _number(value) -> float | None:
    return None if value is None or value != value else float(value)


class Closure:
    """What is known of one segment after its last row; ``last`` is in microseconds, None for a new one."""

    def __init__(self, stored: tuple | None = None) -> None:
        self.mean, self.k, self.zeros, self.low = cfg.INITIAL_MEAN, cfg.K_START, 0, 0
        self.q_zeros: float | None = None
        self.q_low: float | None = None
        self.last: int | None = None
        if stored is not None:
            self.mean, self.k, self.zeros, self.low, self.q_zeros, self.q_low, last = stored
            self.last = _micros(last)

    def stored(self) -> tuple:
        return (self.mean, self.k, self.zeros, self.low, self.q_zeros, self.q_low, _moment(self.last).to_pydatetime())

    def step(self, time: int, fcd: float | None, usual: float | None, q_zeros: float | None, q_low: float | None) -> tuple:
        """Take the next row; returns its output columns after the segment. A row not newer changes nothing."""
        shown = None if fcd is None else int(fcd)
        if self.last is not None and time <= self.last:
            return (time, shown, None, None, None, None, True)
        old_zeros, old_low = self.zeros, self.low
        self.zeros = self.zeros + 1 if fcd == 0 else 0
        self.low = self.low + 1 if fcd in (0, 1) else 0
        if self.last is not None and fcd is not None:
            by_zeros = usual is not None and usual < cfg.ZEROS_OR_ONES_BELOW
            run, before, limit = (self.zeros, old_zeros, self.q_zeros) if by_zeros else (self.low, old_low, self.q_low)
            limit = cfg.NULL_PROFILE if limit is None else max(limit, cfg.MIN_PROFILE)
            self.mean = _next_mean(self.mean, fcd, usual, run, before, limit)
            if fcd < cfg.COVERAGE_HIGH and usual is not None and usual - fcd <= cfg.COVERAGE_DROP:
                span = cfg.DECAY * max(self.q_low or cfg.MIN_PROFILE, cfg.MIN_PROFILE)
                if fcd == 0:
                    self.k = cfg.K_START
                elif self.low == 0 and old_low <= span:
                    self.k = min(cfg.K_MAX, 2 * self.k)
                self.mean *= math.exp(-self.k * max(0.0, (span - self.low) / span))
        self.q_zeros, self.q_low, self.last = q_zeros, q_low, time
        return (time, shown, self.zeros, self.low, self.mean, _status(self.mean), False)


def _micros(moment) -> int:
    return (pd.Timestamp(moment).tz_localize(None) - _EPOCH) // pd.Timedelta(microseconds=1)


def _moment(micros: int) -> pd.Timestamp:
    return _EPOCH + pd.Timedelta(microseconds=micros)


class ClosureProcessor(StatefulProcessor):
    """State of a segment: its ``Closure`` and the hours of rows that the watermark has not passed yet.

    Rows at a time already taken change nothing; they come out marked ``late``, for a repair run.
    Of rows with one time the first in the order of their values is taken. After ``retire``
    without a row a segment starts anew, whenever its state is dropped.
    """

    def __init__(self, retire_ms: int) -> None:
        self.retire_ms = retire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("closure", STATE_SCHEMA)
        self._waiting = handle.getMapState("waiting", "hour bigint", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            self._put_away(frame)
        yield from self._take(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._take(key, timerValues)

    def _put_away(self, frame: pd.DataFrame) -> None:
        packed = np.empty((len(frame), 1 + len(_VALUES)))
        # Microseconds of this century are exact in a double.
        packed[:, 0] = frame["time"].to_numpy("datetime64[us]").astype(np.int64)
        for i, name in enumerate(_VALUES):
            packed[:, i + 1] = frame[name].astype("float64")
        hours = packed[:, 0] // HOUR
        for hour in np.unique(hours):
            here = (int(hour),)
            held = bytes(self._waiting.getValue(here)[0]) if self._waiting.containsKey(here) else b""
            self._waiting.updateValue(here, (held + packed[hours == hour].tobytes(),))

    def _take(self, key, timer_values) -> Iterator[pd.DataFrame]:
        """The rows that the watermark has passed, in time order, an hour at a time."""
        passed = timer_values.getCurrentWatermarkInMs() * 1000
        hours = sorted(k[0] for k in self._waiting.keys())
        closure = Closure(self._state.get()) if self._state.exists() else Closure()
        moved, next_time = False, None
        for hour in hours:
            if hour * HOUR > passed:
                next_time = hour * HOUR if next_time is None else min(next_time, hour * HOUR)
                break
            rows = np.frombuffer(bytes(self._waiting.getValue((hour,))[0])).reshape(-1, 1 + len(_VALUES))
            due = rows[:, 0] <= passed
            if not due.all():
                next_time = int(rows[~due, 0].min())
                self._waiting.updateValue((hour,), (rows[~due].tobytes(),))
            else:
                self._waiting.removeKey((hour,))
            out = []
            ready = rows[due]
            for row in ready[np.lexsort(ready.T[::-1])]:
                time, *values = int(row[0]), *map(_number, row[1:])
                if closure.last is not None and time - closure.last > self.retire_ms * 1000:
                    closure = Closure()
                out.append((key[0], *closure.step(time, *values)))
                moved = True
            if out:
                yield _frame(out)
        if moved:
            self._state.update(closure.stored())
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
        if next_time is not None:
            self._handle.registerTimer(max(-(-next_time // 1000), passed // 1000 + 1))
        elif closure.last is not None:
            ends = closure.last // 1000 + self.retire_ms + 1
            if ends <= passed // 1000:
                self._state.clear()
            else:
                self._handle.registerTimer(ends)

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    columns = [c.strip().split(" ")[0] for c in OUTPUT_SCHEMA.split(",")]
    frame = pd.DataFrame(rows, columns=columns)
    frame["time"] = pd.to_datetime(frame["time"], unit="us")
    for c in ("fcd", "consecutive_zeros", "consecutive_low"):
        frame[c] = frame[c].astype("Int32")
    frame["running_mean"] = frame["running_mean"].astype("float64")
    return frame


def stream_closure(matched: DataFrame, late: str = "1 hour", retire_days: float = 30) -> DataFrame:
    """``segment_id, time, fcd`` and profile values to status rows, state kept per segment.

    A row comes out once the watermark, ``late`` behind the newest time, has passed it; rows older
    than the watermark are dropped by Spark and found again by ``jobs.too_late``. The session must
    use the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``); Spark refuses
    to start the query without it. Rows marked ``late`` changed no state.
    """
    ship_package(matched.sparkSession)
    return (
        matched.select("segment_id", "time", *_VALUES)
        .withWatermark("time", late)
        .groupBy("segment_id")
        .transformWithStateInPandas(
            statefulProcessor=ClosureProcessor(int(retire_days * 86_400_000)),
            outputStructType=OUTPUT_SCHEMA,
            outputMode="append",
            timeMode="EventTime",
        )
    )
