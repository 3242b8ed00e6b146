"""Burst detection on a stream, with the waiting records of each key kept one by one."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyloom.operators.bursts import BURST_SIZE, END_GAP, START_GAP

# The state function travels with its code: workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Records in one row of state at most.
CHUNK = 1000


def _judge(recent: np.ndarray, times: np.ndarray, on: int, size: int, start_gap: int, end_gap: int):
    """For records in time order: the oldest record in reach, the gap, and the state before and after."""
    line = np.concatenate([recent, times])
    place = np.arange(len(recent), len(line)) - (size - 1)
    known = place >= 0
    oldest = np.where(known, line[np.maximum(place, 0)], 0)
    gap = times - oldest
    signal = np.where(known & (gap <= start_gap), 1, np.where(known & (gap >= end_gap), 0, -1))
    latest = np.maximum.accumulate(np.where(signal >= 0, np.arange(len(times)), -1))
    after = np.where(latest >= 0, signal[np.maximum(latest, 0)], on)
    before = np.concatenate([[on], after[:-1]])
    return oldest, gap, before, after


class BurstProcessor(StatefulProcessor):
    """Waiting records by stretch of time in rows of bounded size, judged when a stretch's timer expires.

    ``waiting`` maps (stretch, number) to at most ``CHUNK`` records; a batch adds
    rows and rewrites none. ``sizes`` maps a stretch to its number of rows.
    ``judged`` holds the newest ``size - 1`` times and where the event stands.
    """

    def __init__(self, key: str, tie_break: str, size: int, start_gap: int, end_gap: int, stretch: int) -> None:
        self.key, self.tie_break, self.size = key, tie_break, size
        self.start_gap, self.end_gap, self.stretch = start_gap, end_gap, stretch

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "stretch bigint, number int", "records binary")
        self.sizes = handle.getMapState("sizes", "stretch bigint", "number int")
        self.judged = handle.getValueState("judged", "recent binary, on_ int, event_no bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for some in rows:
            records = np.stack([some["us"].to_numpy(), some[self.tie_break].to_numpy()], axis=1).astype("int64")
            place = records[:, 0] // self.stretch
            order = np.argsort(place, kind="stable")
            records, place = records[order], place[order]
            starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(place)]):
                stretch = int(place[a])
                number = self.sizes.getValue((stretch,))[0] if self.sizes.containsKey((stretch,)) else 0
                if not number:
                    # It expires when the watermark has passed the whole stretch.
                    self.handle.registerTimer(-(-(stretch + 1) * self.stretch // 1000))
                for c in range(a, b, CHUNK):
                    self.waiting.updateValue((stretch, number), (records[c:min(c + CHUNK, b)].tobytes(),))
                    number += 1
                self.sizes.updateValue((stretch,), (number,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # Timers come in order of time, so the stretches of a key do.
        stretch = expiredTimerInfo.getExpiryTimeInMs() * 1000 // self.stretch - 1
        if not self.sizes.containsKey((stretch,)):
            return
        parts = []
        for number in range(self.sizes.getValue((stretch,))[0]):
            parts.append(np.frombuffer(bytes(self.waiting.getValue((stretch, number))[0]), dtype="int64").reshape(-1, 2))
            self.waiting.removeKey((stretch, number))
        self.sizes.removeKey((stretch,))
        records = np.concatenate(parts)
        records = records[np.lexsort((records[:, 1], records[:, 0]))]
        times, ids = records[:, 0], records[:, 1]
        recent, on, number = np.empty(0, dtype="int64"), 0, 0
        if self.judged.exists():
            kept, on, number = self.judged.get()
            recent = np.frombuffer(bytes(kept), dtype="int64")
        oldest, gap, before, after = _judge(recent, times, on, self.size, self.start_gap, self.end_gap)
        numbers = number + np.cumsum((before == 0) & (after == 1))
        line = np.concatenate([recent, times])
        recent = line[len(line) - min(len(line), self.size - 1):]
        self.judged.update((recent.tobytes(), int(after[-1]), int(numbers[-1])))
        change = before != after
        if change.any():
            yield pd.DataFrame({
                self.key: [key[0]] * int(change.sum()), "event_no": numbers[change],
                "kind": np.where(after[change] == 1, "START", "END"), "us": times[change],
                self.tie_break: ids[change], "oldest": oldest[change], "gap": gap[change],
            })


def burst_stream(records: DataFrame, key: str, time: str, tie_break: str, delay: str, size: int = BURST_SIZE,
                 start_gap: int = START_GAP, end_gap: int = END_GAP, stretch_seconds: int = 60) -> DataFrame:
    """key, event_no, kind, us, tie_break, oldest, gap: a row per START and END.

    ``time`` is a timestamp, ``tie_break`` a bigint. Records wait in stretches of
    ``stretch_seconds`` until the watermark (``delay`` behind the newest) has
    passed the stretch and are judged in time order, so neither files nor
    partitions that arrive out of order change the result. Rows later than the
    watermark are dropped. State is kept per stretch in rows of bounded size;
    a task holds one stretch of one key at a time. Start it inside
    ``session.state_by_record`` where the session's state store is not RocksDB.
    """
    kind_of = records.schema[key].dataType.simpleString()
    output = f"{key} {kind_of}, event_no bigint, kind string, us bigint, {tie_break} bigint, oldest bigint, gap bigint"
    tie = F.coalesce(tie_break, F.lit(0)).cast("bigint").alias(tie_break)
    timed = records.withWatermark(time, delay).select(key, time, tie, F.unix_micros(time).alias("us"))
    processor = BurstProcessor(key, tie_break, size, start_gap, end_gap, stretch_seconds * 1_000_000)
    return timed.groupBy(key).transformWithStateInPandas(processor, output, "append", "EventTime")
