"""Grace periods of unreferenced objects, as keyed state of a stream of listings."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

CANDIDATE = "path string, first_seen_ms long, last_seen_ms long, eligible boolean"
DAY_MS = 86_400_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _first_seen(frames: Iterator[pd.DataFrame], first: int | None) -> tuple[int | None, int]:
    """(since when a path is unreferenced, if it is; when it was listed last), after some rows. first: since when it was before them. A reference forgets all up to it."""
    used = unused = last = None
    later = []
    for rows in frames:
        u = rows.seen_ms[rows.referenced].max()
        used = used if pd.isna(u) else int(u) if used is None else max(used, int(u))
        last = int(rows.seen_ms.max()) if last is None else max(last, int(rows.seen_ms.max()))
        later.append(rows.seen_ms[~rows.referenced])
    for seen in later:
        m = seen[~(seen <= used)].min() if used is not None else seen.min()
        unused = unused if pd.isna(m) else int(m) if unused is None else min(unused, int(m))
    return (unused if first is None or used is not None else first), last


def _grace(days: float):
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """first_seen is kept while an object stays unreferenced; a reference forgets it."""
        first, last = _first_seen(frames, state.get[0] if state.exists else None)
        if first is None:
            if state.exists:
                state.remove()
            return
        state.update((first,))
        yield pd.DataFrame({"path": [key[0]], "first_seen_ms": [first], "last_seen_ms": [last], "eligible": [last - first >= days * DAY_MS]})

    return step


def grace_stream(listings: DataFrame, days: float = 7) -> DataFrame:
    """A stream of (path, seen_ms, referenced) listings to candidates, with the first time each path was seen unreferenced as keyed state. A path's candidate changes only when it is listed again; with timers: grace_timers()."""
    return listings.groupBy("path").applyInPandasWithState(_grace(days), CANDIDATE, "first long", "update", GroupStateTimeout.NoTimeout)


class GraceTimers(StatefulProcessor):
    """A timer at the end of each path's grace period. When it rings the path is eligible, although nothing was listed; a second one, `forget` later, drops the state of a path that was never listed again."""

    def __init__(self, days: float, forget_days: float):
        self.grace, self.forget = int(days * DAY_MS), int(forget_days * DAY_MS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", "first long, last long, told boolean")

    def _ring(self, at: int | None) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if at is not None:
            self.handle.registerTimer(at)

    def _row(self, key: tuple, first: int, last: int, eligible: bool) -> pd.DataFrame:
        return pd.DataFrame({"path": [key[0]], "first_seen_ms": [first], "last_seen_ms": [last], "eligible": [eligible]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get() if self.state.exists() else None
        first, last = _first_seen(rows, held[0] if held else None)
        if first is None:
            self.state.clear()
            self._ring(None)
            return
        last = max(last, held[1]) if held else last
        over = last - first >= self.grace
        self.state.update((first, last, over))
        self._ring(max(last, first + self.grace) + self.forget if over else first + self.grace)
        yield self._row(key, first, last, over)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        first, last, told = self.state.get()
        if told:
            self.state.clear()
            return
        self.state.update((first, last, True))
        self.handle.registerTimer(first + self.grace + self.forget)
        yield self._row(key, first, last, True)

    def close(self) -> None:
        pass


def grace_timers(listings: DataFrame, days: float = 7, forget_days: float = 30, late: str = "0 seconds") -> DataFrame:
    """As grace_stream, but a path turns eligible by itself once the stream's time has passed the end of its grace period, whether it is listed again or not.

    listings: path, seen (timestamp), referenced. The stream's time is that of the newest row less `late`; rows older than it may be dropped. Needs
    the RocksDB state store: spark.sql.streaming.stateStore.providerClass, set before the stream starts.
    """
    rows = listings.withWatermark("seen", late).select("path", "seen", F.unix_millis("seen").alias("seen_ms"), "referenced")
    return rows.groupBy("path").transformWithStateInPandas(GraceTimers(days, forget_days), CANDIDATE, "Update", "EventTime")
