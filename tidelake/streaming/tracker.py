"""Sequence tracking in event time: rows in order, state that ends."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

GAP = "source string, symbol string, kind string, last_seq bigint, next_seq bigint, missing_count bigint"
#: Width of a slot in which a stream's rows wait for the watermark, and how long a position outlives its last row.
SLOT_MS, IDLE_MS = 1_000, 3_600_000


class SequenceTracker(StatefulProcessor):
    """One stream's position, and its rows that the watermark has not passed yet.

    Rows wait in slots of ``slot_ms`` of event time.  A slot is taken, its rows in order,
    when the watermark has passed its end, so rows may come in any order within the delay,
    and no more than a slot is in memory at once.  A row that comes when its slot has been
    taken is a replay: it is not checked and moves nothing.  A position ends ``idle_ms``
    after its last row; what comes later starts anew, as after a reconnect.
    """

    def __init__(self, contiguous: bool = True, slot_ms: int = SLOT_MS, idle_ms: int = IDLE_MS) -> None:
        self.contiguous, self.slot_ms, self.idle_ms = contiguous, slot_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.position = handle.getValueState("position", "seq bigint, at bigint")
        self.slots = handle.getMapState("slots", "slot bigint, n bigint", "rows binary")
        self.pieces = handle.getValueState("pieces", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        n = self.pieces.get()[0] if self.pieces.exists() else 0
        for pdf in rows:  # an Arrow batch at a time goes to the state
            pdf = pdf[pdf["end_seq"].notna()]
            whole = np.stack([pdf[c].to_numpy(np.int64) for c in ("received_at", "arrival", "start_seq", "end_seq")]) if len(pdf) else np.zeros((4, 0), np.int64)
            slot = whole[0] // self.slot_ms
            for s in np.unique(slot[(slot + 1) * self.slot_ms > mark]).tolist():
                self.slots.updateValue((s, n), (np.ascontiguousarray(whole[:, slot == s]).tobytes(),))
                self.handle.registerTimer((s + 1) * self.slot_ms)
                n += 1
        self.pieces.update((n,))
        yield _gaps([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        held = list(self.slots.keys()) if self.slots.exists() else []
        due = sorted(k for k in held if (k[0] + 1) * self.slot_ms <= mark)
        seq, at = self.position.get() if self.position.exists() else (None, None)
        for s in sorted({k[0] for k in due}):
            own = [k for k in due if k[0] == s]
            whole = np.concatenate([np.frombuffer(self.slots.getValue(k)[0], np.int64).reshape(4, -1) for k in own], axis=1)
            for k in own:
                self.slots.removeKey(k)
            whole = whole[:, np.lexsort((whole[1], whole[0]))]
            found, seq = self._walk(seq, whole[2], whole[3])
            at = int(whole[0, -1])
            yield _gaps([(*key, *g) for g in found])
        if due:
            self.position.update((seq, at))
            self.handle.registerTimer(at + self.idle_ms)
        elif at is not None and at + self.idle_ms <= mark and not held:
            self.position.clear()
            self.pieces.clear()
        yield _gaps([])

    def _walk(self, seq: int | None, start: np.ndarray, end: np.ndarray) -> tuple[list[tuple], int]:
        """Gaps of a slot's rows after the position, and the position behind them."""
        past = np.concatenate([end[:1] if seq is None else [seq], end[:-1]])
        if self.contiguous:
            bad = np.flatnonzero(start > past + 1)
            bad = bad[bad > 0] if seq is None else bad
            return [(int(past[i]), int(start[i]), int(start[i] - past[i] - 1)) for i in bad], int(end[-1])
        top = np.maximum.accumulate(past)
        bad = np.flatnonzero(end <= top)
        bad = bad[bad > 0] if seq is None else bad
        return [(int(top[i]), int(end[i]), None) for i in bad], int(max(top[-1], end[-1]))

    def close(self) -> None:
        pass


def _gaps(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["source", "symbol", "kind", "last_seq", "next_seq", "missing_count"])
    return out.astype({"last_seq": "Int64", "next_seq": "Int64", "missing_count": "Int64"})


def stream_gaps(rows: DataFrame, contiguous: bool = True, delay: str = "10 seconds", slot_ms: int = SLOT_MS, idle_ms: int = IDLE_MS) -> DataFrame:
    """Gap records of a stream of rows: source, symbol, kind, start_seq, end_seq, received_at, arrival.

    What sequence_gaps (contiguous) and order_breaks find in a batch, for rows that come
    within ``delay`` of the newest one.  A gap is told once the watermark has passed its
    row.  Needs the RocksDB state store.
    """
    timed = rows.withColumn("event_time", F.timestamp_millis("received_at")).withWatermark("event_time", delay)
    return timed.groupBy("source", "symbol", "kind").transformWithStateInPandas(SequenceTracker(contiguous, slot_ms, idle_ms), GAP, "append", "eventTime")
