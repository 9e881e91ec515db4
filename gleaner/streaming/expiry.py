"""Keyed state that expires: gates, streaks, retries and inactivity as streams.

Each is a stateful processor over events with a watermark. State is dropped by event-time
timers, so what a key holds ends with its time to live and not with the stream. Rows of a key
are taken in order of time within a micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gleaner.runtime import ship

DAY_MS = 86_400_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _in_order(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(milliseconds, value) of a key's rows of a micro-batch by time."""
    frame = pd.concat(list(frames))
    frame = frame.sort_values(["ms", "tie"], kind="stable")
    return zip(frame["ms"].tolist(), frame["value"].tolist())


class _Keyed(StatefulProcessor):
    """One value a key: a time and a number; a timer for when it ends."""

    columns: tuple[str, ...] = ()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "at long, n long")

    def get(self) -> tuple[int, int] | None:
        return tuple(self.state.get()) if self.state.exists() else None

    def put(self, at: int, n: int, ends: int | None) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.state.update((at, n))
        if ends is not None:
            self.handle.registerTimer(ends)

    def rows(self, out: list[tuple]) -> Iterator[pd.DataFrame]:
        if out:
            yield pd.DataFrame(out, columns=["key", "ms", *self.columns])

    def close(self) -> None:
        pass


class Gate(_Keyed):
    """Lets a key through at most once in ``ttl`` days; with ``only``, just events of that value close it, and it stays shut from the first."""

    columns = ("passed",)

    def __init__(self, ttl_ms: int, only: str | None = None):
        self.ttl, self.only = ttl_ms, only

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, out = self.get(), []
        for at, value in _in_order(rows):
            shut = held is not None and at < held[0] + self.ttl
            if self.only is None:
                out.append((key[0], at, not shut))
                held = held if shut else (at, 0)
            elif value == self.only:
                held = (at, 0)
            else:
                out.append((key[0], at, not shut))
        if held is not None:
            self.put(*held, held[0] + self.ttl)
        return self.rows(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())


class Streak(_Keyed):
    """How often the value was the last one watched for in a row, and whether that is ``most`` or more."""

    columns = ("n", "alert")

    def __init__(self, watched: str, most: int):
        self.watched, self.most = watched, most

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        _, n = self.get() or (0, 0)
        out, at = [], 0
        for at, value in _in_order(rows):
            n = n + 1 if value == self.watched else 0
            out.append((key[0], at, n, n >= self.most))
        self.put(at, n, None)
        return self.rows(out)


class Retry(_Keyed):
    """A key's tries: it leaves the queue done at its first success, or dropped at ``most`` failures, and may come again."""

    columns = ("n", "outcome")

    def __init__(self, success: str, most: int, ttl_ms: int):
        self.success, self.most, self.ttl = success, most, ttl_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        _, n = self.get() or (0, 0)
        out, at = [], 0
        for at, value in _in_order(rows):
            n += value != self.success
            outcome = "done" if value == self.success else "dropped" if n >= self.most else "waiting"
            out.append((key[0], at, n, outcome))
            n = n if outcome == "waiting" else 0
        if n:
            self.put(at, n, at + self.ttl)
        elif self.state.exists():
            self.put(at, 0, None)
            self.state.clear()
        return self.rows(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())


class Inactivity(_Keyed):
    """A key that isn't seen: likely_closed after ``close`` days, archived after ``archive``; seen again it is active."""

    columns = ("status",)
    ACTIVE, CLOSED = 0, 1

    def __init__(self, close_ms: int, archive_ms: int):
        self.closing, self.archiving = close_ms, archive_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, out = self.get(), []
        for at, _ in _in_order(rows):
            last = held[0] if held else None
            if last is not None and at > last:
                # What timers of this time would have said, had they come before the event.
                if held[1] == self.ACTIVE and at - last >= self.closing:
                    out.append((key[0], last + self.closing, "likely_closed"))
                    held = (last, self.CLOSED)
                if at - last >= self.archiving:
                    out.append((key[0], last + self.archiving, "archived"))
                    held = None
            if held is None or held[1] == self.CLOSED:
                out.append((key[0], at, "active"))
            held = (max(at, held[0]) if held else at, self.ACTIVE)
        self.put(*held, held[0] + self.closing)
        return self.rows(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.get()
        if held is None:
            return iter(())
        last, status = held
        out = []
        if status == self.ACTIVE:
            out.append((key[0], last + self.closing, "likely_closed"))
        # The watermark may have passed both times at once, and no other batch comes for the second.
        if timerValues.getCurrentWatermarkInMs() >= last + self.archiving:
            out.append((key[0], last + self.archiving, "archived"))
            self.state.clear()
        else:
            self.put(last, self.CLOSED, last + self.archiving)
        return self.rows(out)


def stateful(events: DataFrame, processor: _Keyed, columns: str) -> DataFrame:
    """``processor`` over ``events(key string, ts, value string, tie long)``: rows (key, ms, its columns)."""
    spark = events.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = events.selectExpr("key", "ts", "unix_millis(ts) AS ms", "CAST(value AS STRING) AS value", "CAST(tie AS LONG) AS tie")
    return rows.groupBy("key").transformWithStateInPandas(
        processor, outputStructType=f"key string, ms long, {columns}", outputMode="Update", timeMode="EventTime")


def gated(events: DataFrame, days: float, only: str | None = None) -> DataFrame:
    """(key, ms, passed): a key passes at most once in ``days``; with ``only``, not for that long after an event of that value."""
    return stateful(events, Gate(int(days * DAY_MS), only), "passed boolean")


def streaked(events: DataFrame, watched: str, most: int = 2) -> DataFrame:
    """(key, ms, n, alert): values ``watched`` for, in a row."""
    return stateful(events, Streak(watched, most), "n long, alert boolean")


def retried(events: DataFrame, success: str, most: int = 3, days: float = 3650) -> DataFrame:
    """(key, ms, n, outcome): tries of each key until done or dropped."""
    return stateful(events, Retry(success, most, int(days * DAY_MS)), "n long, outcome string")


def idle(events: DataFrame, close: float = 7, archive: float = 21) -> DataFrame:
    """(key, ms, status): the transitions of each key by how long it isn't seen."""
    return stateful(events, Inactivity(int(close * DAY_MS), int(archive * DAY_MS)), "status string")
