"""Grouping activity into sessions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.scan import join_ends, ordered_scan


class _Sessions:
    """Linear scan: holds the open session and the last event only."""

    def __init__(self, gap: int, dedup: bool):
        self.gap, self.dedup, self.open, self.last = gap, dedup, None, None

    def push(self, batch: pa.RecordBatch) -> pa.Table | None:
        user = batch.column(0).dictionary_encode()
        names, u, t = user.dictionary, user.indices.to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        same = np.empty(len(t), bool)
        same[1:] = u[1:] == u[:-1]
        first = names[int(u[0])].as_py()
        same[0] = self.open is not None and self.open[0] == first
        before = np.empty_like(t)
        before[1:] = t[:-1]
        before[0] = self.open[2] if self.open is not None else 0
        fresh = np.ones(len(t), np.int64)
        if self.dedup:
            e = batch.column(2).dictionary_encode()
            ids, values = e.indices.fill_null(-1).to_numpy(zero_copy_only=False), e.dictionary
            again = same & (t == before)
            again[1:] &= (ids[1:] == ids[:-1]) & (ids[1:] >= 0)
            again[0] &= ids[0] >= 0 and self.last is not None and values[int(ids[0])].as_py() == self.last
            fresh[again] = 0
            self.last = values[int(ids[-1])].as_py() if ids[-1] >= 0 else None
        starts = np.flatnonzero(~(same & (t - before <= self.gap)))
        if len(starts) == 0:  # all belongs to the open session
            self.open = (self.open[0], self.open[1], int(t[-1]), self.open[3] + int(fresh.sum()))
            return None
        ends = np.append(starts[1:], len(t)) - 1
        counts = np.add.reduceat(fresh, starts)
        done = []
        if self.open is not None:
            head = int(starts[0])
            done.append(self._table([self.open[0]], [self.open[1]], [int(t[head - 1]) if head else self.open[2]], [self.open[3] + int(fresh[:head].sum())]))
        if len(starts) > 1:
            done.append(self._table(names.take(pa.array(u[starts[:-1]])), t[starts[:-1]], t[ends[:-1]], counts[:-1]))
        k = int(starts[-1])
        self.open = (names[int(u[k])].as_py(), int(t[k]), int(t[-1]), int(counts[-1]))
        return pa.concat_tables(done) if done else None

    def close(self) -> pa.Table | None:
        return self._table(*([x] for x in self.open)) if self.open is not None else None

    @staticmethod
    def _table(user, start, end, n) -> pa.Table:
        return pa.table({"user": pa.array(user, pa.string()) if isinstance(user, list) else user.cast(pa.string()), "start_ms": pa.array(start, pa.int64()), "end_ms": pa.array(end, pa.int64()), "n_events": pa.array(n, pa.int64())})


def sessionize(events: DataFrame, user: str, time_ms: str, gap_ms: int = 1_800_000, event_id: str | None = None) -> DataFrame:
    """(user, start_ms, end_ms, duration_ms, n_events): a session ends where more than gap_ms pass without an event.

    Rows without user or time are left out. With event_id, an event that is stored
    again (same user, time and id) counts once; rows without id each count. Ties in time fall into one
    session. A session of one event has duration 0. An empty table gives no sessions.
    Other columns are ignored, so their names can't clash.

    Secondary sort by (user, time, id) over range partitions, then one linear scan
    (see scan.py): a user with a third of all events is spread over many tasks.
    """
    columns = [F.col(user).cast("string").alias("user"), F.col(time_ms).cast("long").alias("t")] + ([F.col(event_id).cast("string").alias("id")] if event_id else [])
    rows = events.select(columns).where(F.col("user").isNotNull() & F.col("t").isNotNull())
    order = ["user", "t"] + (["id"] if event_id else [])
    dedup = event_id is not None
    scanned = ordered_scan(rows, order, lambda: _Sessions(gap_ms, dedup), "user string, start_ms long, end_ms long, n_events long", "sessions")
    whole = join_ends(scanned, ["user"], [], gap_ms, ["n_events"])
    return whole.select(F.col("user").alias(user), "start_ms", "end_ms", (F.col("end_ms") - F.col("start_ms")).alias("duration_ms"), "n_events")
