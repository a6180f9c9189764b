"""The leader scan as a keyed state operator: rows wait until the watermark has passed them, then lead in order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vecquery.streaming.runs import STATE_STORE, STATE_STORE_SETTING

SCANNED = "key string, ts_us bigint, id bigint, leader_id bigint, leader_ts_us bigint, is_leader boolean"
#: Rows of one key wait by slots of this width, and in chunks of so many rows.
SLOT_US = 60_000_000
CHUNK_ROWS = 4_096
#: A run of slots with few rows waits as one page of at most so many rows, under its first slot.
PAGE_ROWS = 6


class LeaderState(StatefulProcessor):
    """State per key: waiting rows in pages by time slot, and the leader with the first instant at which another may lead.

    A page holds one slot, or several in a row that have few rows together, so that a sparse key costs a page and not a slot
    per row. A timer goes off when the watermark has passed the end of the first slot that has a page: pages that begin in passed
    slots are read and cleared, their rows of passed slots are scanned in (time, id) order, and what is left waits as a page
    again; pages that begin later are not touched, and the first of them is waited for next. Arriving rows fill up their page's last chunk only. A leader is cleared once the
    watermark has passed the slot in which it stops leading, so a key without recent rows has no state. Neither the order of
    files nor the cut into micro-batches changes the result.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.leader = handle.getValueState("leader", "id bigint, ts_us bigint, free_us bigint")
        self.slots = handle.getMapState("slots", "slot bigint", "n bigint")
        self.chunks = handle.getMapState("chunks", "slot bigint, chunk bigint", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = {s[0] for s in self.slots.keys()}
        first = min(known, default=None)
        for part in rows:
            self._wait(part[["ts_us", "id", "free_us"]].to_numpy(np.int64), known)
        if known and (first is None or min(known) < first):
            self._wake((min(known) + 1) * SLOT_US, timerValues)
        return iter(())

    def _wait(self, rows: np.ndarray, known: set[int], fill: bool = True) -> None:
        """Cut rows into pages: a slot of many rows alone, others together with the slots behind them. ``known``: slots with a page."""
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        slot = rows[:, 0] // SLOT_US
        begins = np.flatnonzero(np.diff(slot, prepend=slot[0] - 1)) if len(rows) else np.zeros(0, dtype=np.int64)
        ends = np.append(begins[1:], len(rows))
        most, at = min(PAGE_ROWS, CHUNK_ROWS), 0
        while at < len(begins):
            last = max(at + 1, int(np.searchsorted(ends, begins[at] + most, side="right")))
            self._append(int(slot[begins[at]]), rows[begins[at] : ends[last - 1]], known, fill)
            at = last

    def _append(self, slot: int, rows: np.ndarray, known: set[int], fill: bool) -> None:
        """``fill``: the last chunk is filled up; else it is not read and the rows begin another one."""
        n = self.slots.getValue((slot,))[0] if slot in known else 0
        n = n if fill else -(-n // CHUNK_ROWS) * CHUNK_ROWS
        known.add(slot)
        self.slots.updateValue((slot,), (n + len(rows),))
        while len(rows):
            chunk, filled = divmod(n, CHUNK_ROWS)
            some, rows = rows[: CHUNK_ROWS - filled], rows[CHUNK_ROWS - filled :]
            held = self.chunks.getValue((slot, chunk))[0] if filled else b""
            self.chunks.updateValue((slot, chunk), (bytes(held) + some.tobytes(),))
            n += len(some)

    def _wake(self, at_us: int, timerValues) -> None:
        self.handle.registerTimer(max(-(-at_us // 1000), timerValues.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed_us = timerValues.getCurrentWatermarkInMs() * 1000
        parts, n = [], 0
        waiting = {s[0] for s in self.slots.keys()}
        passed = sorted(s for s in waiting if (s + 1) * SLOT_US <= passed_us)
        waiting.difference_update(passed)
        for slot in passed:
            if n >= CHUNK_ROWS:  # no page from here on has a row before this slot
                early, late = self._parted(parts, slot * SLOT_US)
                if len(early):
                    yield self._scan(key, early)
                parts, n = [late], len(late)
            parts.append(self._taken(slot))
            n += len(parts[-1])
        if parts:
            early, late = self._parted(parts, passed_us // SLOT_US * SLOT_US)
            yield self._scan(key, early)
            self._wait(late, waiting, fill=False)
        if waiting:
            self._wake((min(waiting) + 1) * SLOT_US, timerValues)
        known = self.leader.get() if self.leader.exists() else None
        if known is not None:
            closed_us = (known[2] // SLOT_US + 1) * SLOT_US  # no row that waits or still comes is before it
            if closed_us <= passed_us:
                self.leader.clear()
            else:
                self._wake(closed_us, timerValues)

    def _taken(self, slot: int) -> np.ndarray:
        n = self.slots.getValue((slot,))[0]
        chunks = range(-(-n // CHUNK_ROWS))
        rows = np.frombuffer(b"".join(bytes(self.chunks.getValue((slot, c))[0]) for c in chunks), dtype=np.int64).reshape(-1, 3)
        for c in chunks:
            self.chunks.removeKey((slot, c))
        self.slots.removeKey((slot,))
        return rows

    @staticmethod
    def _parted(parts: list[np.ndarray], end_us: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows before ``end_us`` in (time, id) order, and the others."""
        rows = np.concatenate(parts)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        cut = int(np.searchsorted(rows[:, 0], end_us))
        return rows[:cut], rows[cut:]

    def _scan(self, key, rows: np.ndarray) -> pd.DataFrame:
        ts, ids, free = rows.T
        known = self.leader.get() if self.leader.exists() else None
        leader_id, leader_ts = np.empty(len(ts), np.int64), np.empty(len(ts), np.int64)
        leads = np.zeros(len(ts), dtype=bool)
        at = 0
        if known is not None:
            at = int(np.searchsorted(ts, known[2]))
            leader_id[:at], leader_ts[:at] = known[0], known[1]
        while at < len(ts):  # one step per leader
            end = max(int(np.searchsorted(ts, free[at])), at + 1)
            leader_id[at:end], leader_ts[at:end], leads[at] = ids[at], ts[at], True
            known, at = (int(ids[at]), int(ts[at]), int(free[at])), end
        self.leader.update(tuple(known))
        return pd.DataFrame({
            "key": key[0], "ts_us": ts, "id": ids, "leader_id": leader_id, "leader_ts_us": leader_ts, "is_leader": leads,
        })

    def close(self) -> None:
        pass


def leader_stream(events: DataFrame, closed: bool, delay: str = "10 minutes") -> DataFrame:
    """Stream of key, ts (timestamp), id, span_us -> leader scan.

    A row is emitted once the watermark has passed its slot; rows later than ``delay`` are dropped. Raises unless the
    session keeps state in the RocksDB store, which this operator needs while it runs (``runs.keeping_state``).
    """
    given = events.sparkSession.conf.get(STATE_STORE_SETTING)
    if given != STATE_STORE:
        raise ValueError(f"a leader stream needs {STATE_STORE_SETTING}={STATE_STORE}, not {given}")
    ts_us = F.unix_micros("ts")
    timed = events.withWatermark("ts", delay).select(
        "key", "ts", ts_us.alias("ts_us"), "id", (ts_us + F.col("span_us") + (1 if closed else 0)).alias("free_us")
    )
    return timed.groupBy("key").transformWithStateInPandas(
        LeaderState(), outputStructType=SCANNED, outputMode="Append", timeMode="EventTime"
    )
